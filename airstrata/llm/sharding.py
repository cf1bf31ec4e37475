"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.llm.common import unused
from airstrata.session import stored

SHARD_BYTES = 1 << 20
HASH_BITS = 60
# Bits of hash by which one pass over the narrow table deepens the directory.
STEP_BITS = 15


def row_hash() -> Column:
    """The first 60 bits of the MD5 of a document's id and text, as a long."""
    named = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit(" "),
        F.coalesce("text", F.lit("")),
    )
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth: Column | int) -> Column:
    shift = F.lit(HASH_BITS) - (depth if isinstance(depth, Column) else F.lit(depth))
    return F.call_function("shiftrightunsigned", F.col("hash"), shift.cast("int"))


def build_directory(sized: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(depth, prefix, shard_bytes, shard_docs)``: the buckets that partition ``sized``.

    ``sized`` has ``hash`` and ``n_bytes``. All rows start in one bucket; only a bucket over
    the limit is split on its next bit. A pass sums the cells of the next few bits, from which
    the sizes of all buckets of these depths follow; rows of cells that are too large even so
    go into the next pass. A bucket whose 60 bits are used up stays: it holds one document, or
    exact repeats of one.
    """
    leaves = None
    open_rows, depth = sized.select("hash", "n_bytes"), 0
    while True:
        deep = min(depth + STEP_BITS, HASH_BITS)
        cells = (
            open_rows.groupBy(_prefix(deep).alias("cell"))
            .agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_docs"))
        )
        # Every cell counts for the buckets of all depths above it, as far as the pass goes.
        # Cells at the outset depth are known to be too large, unless it is the very first.
        first = depth if depth == 0 else depth + 1
        nodes = (
            cells.select("*", F.explode(F.sequence(F.lit(first), F.lit(deep))).alias("depth"))
            .withColumn(
                "prefix", F.expr(f"shiftrightunsigned(cell, {deep} - depth)")
            )
            .groupBy("depth", "prefix")
            .agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_docs").alias("shard_docs"))
        )
        nodes = stored(nodes, "buckets")
        over = F.col("shard_bytes") > shard_bytes
        parents = nodes.filter(over).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        fits = ~over if deep < HASH_BITS else ~over | (F.col("depth") == HASH_BITS)
        fitting = nodes.filter(fits).withColumn("parent", F.shiftright("prefix", 1))
        below = fitting.join(parents, ["depth", "parent"], "left_semi").drop("parent")
        # The children of the buckets that the last pass left open, or the only bucket.
        tops = fitting.filter(F.col("depth") == first).drop("parent")
        found = below.unionByName(tops)
        leaves = found if leaves is None else leaves.unionByName(found)
        large = nodes.filter(over & (F.col("depth") == deep)).select(F.col("prefix").alias("cell"))
        if deep == HASH_BITS or large.isEmpty():
            return leaves
        open_rows = open_rows.join(large, _prefix(deep) == F.col("cell"), "left_semi")
        depth = deep


def assign_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, shard, depth, shard_bytes, shard_docs)`` for every row of ``docs``.

    ``shard`` is the bucket's hash prefix in bits, empty while one shard holds everything;
    a document's size is that of its text in UTF-8, NULL text having 0 bytes. Shards hold at
    most ``shard_bytes``, but for a single document that alone is larger and for exact repeats
    (same id, same text) that together are. Ids may be NULL, rows may repeat; an empty table
    gives no rows.
    """
    sized = docs.select("doc_id", row_hash().alias("hash"), _text_bytes().alias("n_bytes"))
    sized = stored(sized, "sized")
    directory = stored(build_directory(sized, shard_bytes), "directory")
    found = _find_buckets(sized, directory, ["doc_id", "n_bytes"])
    return found.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


def _text_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def _find_buckets(rows: DataFrame, directory: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with their bucket: a row looks for it at each depth that occurs (60 at most)."""
    depths = sorted(row["depth"] for row in directory.select("depth").distinct().collect())
    probes = [F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths or [0]]
    probed = rows.select(*columns, F.inline(F.array(*probes)))
    shard = F.expr("if(depth = 0, '', lpad(bin(prefix), depth, '0'))")
    return probed.join(directory, ["depth", "prefix"]).withColumn("shard", shard)


def write_shards(docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Write ``docs`` below ``path``, one folder ``shard=b<bits>`` for each shard.

    All columns are kept; if one of them is called ``shard``, the folders' name gets an
    underscore. NULL texts and ids, empty and repeated rows are sharded as ``assign_shards``
    says; an empty table writes no shard. The texts are shuffled twice: to meet their shard,
    and to be written with it.
    """
    hashes = docs.select(row_hash().alias("hash"), _text_bytes().alias("n_bytes"))
    hashes = stored(hashes, "sized")
    directory = stored(build_directory(hashes, shard_bytes), "directory")
    found = _find_buckets(hashes.select("hash").distinct(), directory, ["hash"])
    shard, hashed = unused(docs.columns, "shard", "hash")
    shard_of = found.select(F.col("hash").alias(hashed), F.concat(F.lit("b"), "shard").alias(shard))
    (
        docs.withColumn(hashed, row_hash())
        .join(shard_of, hashed)
        .drop(hashed)
        .repartition(shard)
        .write.partitionBy(shard)
        .parquet(path)
    )
