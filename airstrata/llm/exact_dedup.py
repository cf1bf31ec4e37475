"""Exact duplicates by an extendible-hash index on shared files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airstrata.operators.sizing import broadcast_if_small
from airstrata.operators.skew import heavy_keys, spread_join
from airstrata.session import ensure_checkpoint_dir, stored

# What a bucket may hold: a fixed part for each key, and the text that copies are compared by.
BUCKET_BYTES = 16 << 20
KEY_BYTES = 64
# Bits of the hash by which the directory can grow between two readings of the keys.
STEP_BITS = 16
HASH_BITS = 64


def text_hash(text: Column) -> Column:
    """64 bits that send a text to its bucket; equal hashes are no proof of equal texts."""
    return F.xxhash64(text)


def _prefix(depth: Column | int) -> Column:
    """The first ``depth`` bits of the hash; a shift by 64 would shift by nothing."""
    shift = (F.lit(HASH_BITS) - (F.lit(depth) if isinstance(depth, int) else depth)).cast("int")
    cut = F.call_function("shiftrightunsigned", F.col("hash"), shift)
    return F.when(shift == HASH_BITS, F.lit(0).cast("long")).otherwise(cut)


def directory_of(keys: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(depth, prefix)`` of the buckets that partition ``keys`` of ``(hash, n_bytes)``.

    The directory starts as one bucket of depth 0. While a bucket is overfull, it is split on
    the next bit, which doubles the part of the directory above it. One reading of the keys
    serves ``STEP_BITS`` doublings: it sums cells of that many bits, and the buckets of all
    depths between are sums of cells. Only keys below buckets that are overfull even then are
    read again. A bucket whose bits are used up holds one hash and stays.
    """
    buckets = None
    rows, depth = keys.select("hash", "n_bytes"), 0
    while True:
        deepest = min(depth + STEP_BITS, HASH_BITS)
        cells = stored(
            rows.groupBy(_prefix(deepest).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes")),
            "cells",
        )
        # A cell lies in one bucket of each depth; from the second reading on, the buckets of
        # the first depth are known to be overfull.
        first = depth if depth == 0 else depth + 1
        at = cells.select("cell", "n_bytes", F.explode(F.sequence(F.lit(first), F.lit(deepest))).alias("depth"))
        sizes = at.groupBy(
            "depth", F.expr(f"shiftrightunsigned(cell, {deepest} - depth)").alias("prefix")
        ).agg(F.sum("n_bytes").alias("n_bytes"))
        sizes = stored(sizes, "directory")
        overfull = F.col("n_bytes") > bucket_bytes
        if deepest == HASH_BITS:
            overfull = overfull & (F.col("depth") < HASH_BITS)
        split = sizes.filter(overfull).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        full = sizes.filter(~overfull).withColumn("parent", F.shiftrightunsigned("prefix", 1))
        # A bucket exists if the one above it was split, or if nothing lies above.
        made = full.join(split, ["depth", "parent"], "left_semi").unionByName(
            full.filter(F.col("depth") == first)
        )
        made = made.select("depth", "prefix")
        buckets = made if buckets is None else buckets.unionByName(made)
        open_cells = sizes.filter(overfull & (F.col("depth") == deepest)).select(
            F.col("prefix").alias("cell")
        )
        if deepest == HASH_BITS or open_cells.isEmpty():
            return buckets
        rows = rows.join(open_cells, _prefix(deepest) == F.col("cell"), "left_semi")
        depth = deepest


class HashIndex:
    """Groups of equal texts in bucket files below a folder that all executors reach.

    ``entries`` has a row for each distinct text of a hash: ``hash``, ``link`` (its place in
    the chain of that hash, from 1), ``n_links`` (the chain's length), ``keep_id``,
    ``n_docs``, and ``text`` where the chain has further links, since only then do its bytes
    tell the documents apart. Files lie below ``bucket=<depth>-<prefix>`` and are sorted by
    hash.
    """

    SCHEMA = "hash long, link int, n_links long, keep_id {}, n_docs long, text string, bucket string"

    def __init__(self, spark: SparkSession, folder: str, id_type: str):
        self.spark, self.folder = spark, folder
        self.schema = self.SCHEMA.format(id_type)

    def write(self, groups: DataFrame, directory: DataFrame) -> None:
        """Store ``(hash, text, keep_id, n_docs)``, one row a distinct text.

        An entry looks for its bucket at each depth that occurs, 65 at most. The task that owns a
        bucket gets its range of hashes whole, chains what shares a hash, and writes the file.
        """
        depths = sorted(row[0] for row in directory.select("depth").distinct().collect())
        probes = F.array(
            *[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths or [0]]
        )
        named = directory.withColumn(
            "bucket", F.concat("depth", F.lit("-"), F.hex("prefix"))
        )
        probed = groups.select("*", F.inline(probes))
        placed = probed.join(broadcast_if_small(named, settle=False), ["depth", "prefix"])
        chain = Window.partitionBy("bucket", "hash")
        linked = placed.repartition("bucket").select(
            "hash",
            F.row_number().over(chain.orderBy("text")).alias("link"),
            F.count(F.lit(1)).over(chain).alias("n_links"),
            "keep_id",
            "n_docs",
            "text",
            "bucket",
        )
        alone = F.col("n_links") == 1
        (
            linked.withColumn("text", F.when(~alone, F.col("text")))
            .sortWithinPartitions("bucket", "hash", "link")
            .write.partitionBy("bucket")
            .parquet(self.folder)
        )

    def entries(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder).drop("bucket")


def exact_duplicates(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hashed=text_hash
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Texts are equal if all their bytes are; NULL counts as empty. ``keep_id`` is the largest
    doc_id of the rows with that text, ``group_size`` their number, and ``kept`` holds for the
    row with that id. Rows that repeat it, id and text, are all kept; a row without a doc_id
    is kept only where no row of its text has one. Text of any length is one value. Other
    columns of ``docs``, whatever their names, play no part. An empty table gives no rows.

    The documents are hashed once into narrow rows. A hash that occurs once needs no more;
    texts with a hash that repeats are grouped by hash and bytes, which reduces copies before
    they are shuffled, and go into the index (``HashIndex``). Documents then take their group
    from the chain of their hash, and where it has several links, from the link with their
    bytes. A text in a third of all documents is one entry, and its documents meet it in
    pieces.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("hash", hashed(F.col("text")))
    narrow = stored(
        texts.select(
            "doc_id",
            "hash",
            F.octet_length("text").alias("n_bytes"),
            F.unhex(F.sha2("text", 256)).alias("sha"),
        ),
        "hashed",
    )
    # Copies have one length; where texts of several lengths share a hash, the longest counts.
    keys = narrow.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.max("n_bytes").alias("n_bytes"),
    )
    repeated = stored(
        keys.filter("n_docs > 1").select(
            "hash", (F.col("n_bytes") + F.lit(KEY_BYTES)).cast("long").alias("n_bytes")
        ),
        "repeated",
    )
    wanted = broadcast_if_small(repeated.select("hash"), settle=False)
    groups = (
        texts.join(wanted, "hash", "left_semi")
        .groupBy("hash", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_docs"))
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    index = HashIndex(spark, f"{ensure_checkpoint_dir(spark)}/hash-index-{uuid.uuid4().hex}", id_type)
    index.write(groups, directory_of(repeated, bucket_bytes))

    heads = index.entries().filter("link = 1").select(
        F.col("hash").alias("met"), "n_links", "keep_id", "n_docs"
    )
    heavy = heavy_keys(narrow, "hash")
    found = spread_join(narrow.drop("n_bytes"), heads, "hash", "met", heavy, "left")
    single = found.filter(F.coalesce(F.col("n_links") == 1, F.lit(True))).select(
        "doc_id",
        F.when(F.col("met").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n_docs", F.lit(1)).alias("group_size"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    result = single.unionByName(_chained(texts, index))
    return result.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _chained(texts: DataFrame, index: HashIndex) -> DataFrame:
    """Groups of the documents whose hash has several texts, by comparing their bytes."""
    links = index.entries().filter("n_links > 1")
    clashing = links.select("hash").distinct()
    chosen = texts.join(broadcast_if_small(clashing), "hash", "left_semi")
    links = links.select(
        F.col("hash").alias("met"), F.col("text").alias("bytes"), "keep_id", "n_docs"
    )
    same = (F.col("hash") == F.col("met")) & (F.col("text") == F.col("bytes"))
    return chosen.join(links, same).select(
        "doc_id",
        "keep_id",
        F.col("n_docs").alias("group_size"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep, all columns as they are.

    Rows that repeat a kept id and text stay, since they are the same document.
    """
    found = exact_duplicates(docs, bucket_bytes).filter("kept")
    kept = found.select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")
    ).distinct()
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (sha == kept["_kept_sha"])
    return docs.join(kept, same, "left_semi")
