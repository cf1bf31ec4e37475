"""SimHash near-duplicates, linked through BK-trees of fingerprint shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.llm.common import text_bytes
from airstrata.llm.components import connected_components
from airstrata.operators.sizing import broadcast_if_small
from airstrata.operators.skew import heavy_keys, spread_join
from airstrata.session import stored

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# Hashes expanded to bits at a time, and fingerprints in one shard of a hot key.
HASH_BLOCK = 1 << 15
SHARD_ROWS = 2048


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text: a bit is set if over half of the shingle hashes have it.

    A-Z is lower-cased; words are runs without ASCII blanks. Fewer words than a shingle make
    one shingle; no word gives 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(words) - shingle_words + 1)
    lasts = ends[min(shingle_words, len(words)) - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, HASH_BLOCK):
        spans = zip(starts[at : min(at + HASH_BLOCK, count)].tolist(), lasts[at:].tolist())
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def with_fingerprint(
    docs: DataFrame, column: str = "fingerprint", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long; NULL text has fingerprint 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = [fingerprint(text, shingle_words) for text in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return docs.withColumn(column, of(text_bytes()))


class BKTree:
    """Metric tree over fingerprints: a child hangs on the edge of its distance to its parent.

    By the triangle inequality, all values within ``radius`` of a query lie below edges within
    ``radius`` of the query's distance to the node. Values can be taken out; a subtree without
    values left isn't entered.
    """

    def __init__(self, values: list[int]):
        self.values = values
        self.parent = [-1] * len(values)
        self.edges: list[dict[int, int]] = [{} for _ in values]
        self.alive = [True] * len(values)
        self.left = [1] * len(values)
        for i in range(1, len(values)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        value, node = self.values[i], 0
        while True:
            self.left[node] += 1
            distance = (self.values[node] ^ value).bit_count()
            child = self.edges[node].get(distance)
            if child is None:
                self.edges[node][distance] = i
                self.parent[i] = node
                return
            node = child

    def remove(self, i: int) -> None:
        self.alive[i] = False
        while i >= 0:
            self.left[i] -= 1
            i = self.parent[i]

    def within(self, query: int, radius: int) -> list[int]:
        """Indices of the values left within ``radius`` bits of ``query``."""
        found, todo = [], [0]
        values, left, alive = self.values, self.left, self.alive
        while todo:
            node = todo.pop()
            if not left[node]:
                continue
            distance = (values[node] ^ query).bit_count()
            if distance <= radius and alive[node]:
                found.append(node)
            low, high = distance - radius, distance + radius
            for edge, child in self.edges[node].items():
                if low <= edge <= high:
                    todo.append(child)
        return found


def spanning_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what all links within ``radius`` connect, one for each value reached.

    A value found is taken out of the tree before it is searched from, so a dense group costs
    a few searches and not a link for each of its pairs.
    """
    if len(values) == 2:
        a, b = values
        return [(a, b)] if (a ^ b).bit_count() <= radius else []
    tree, links = BKTree(values), []
    for i in range(len(values)):
        if not tree.alive[i]:
            continue
        tree.remove(i)
        todo = [i]
        while todo:
            at = todo.pop()
            for j in tree.within(values[at], radius):
                tree.remove(j)
                links.append((values[at], values[j]))
                todo.append(j)
    return links


def shard_keys(fingerprint: str, radius: int) -> str:
    """SQL for the keys of which two fingerprints within ``radius`` bits share one at least.

    The 64 bits are cut into ``radius + 3`` blocks; at most ``radius`` of them differ, so three
    agree, and two of these lie in the same half of the blocks. A key is a pair of blocks of
    one half: for radius 4 nine keys of about 18 bits.
    """
    count = radius + 3
    cuts = [64 * i // count for i in range(count + 1)]
    blocks = [
        f"(shiftrightunsigned({fingerprint}, {low}) & {(1 << (high - low)) - 1}L)"
        for low, high in zip(cuts, cuts[1:])
    ]
    half = (count + 1) // 2
    pairs = [
        (i, j) for i in range(count) for j in range(i + 1, count) if (i < half) == (j < half)
    ]
    keys = [
        f"(shiftleft({n}L, 48) | shiftleft({blocks[i]}, 24) | {blocks[j]})"
        for n, (i, j) in enumerate(pairs)
    ]
    return f"array({', '.join(keys)})"


def link_fingerprints(
    fingerprints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``(a, b)``: links within ``radius`` bits that connect the distinct longs of ``fp``.

    Fingerprints meet in the shards of their keys (``shard_keys``); each shard's tree is built
    in a task from at most about ``2 * shard_rows`` values. A key with more values is dealt
    into shards by hash, and every two of its shards meet, so no task holds a hot key whole.
    """
    keyed = fingerprints.select(F.explode(F.expr(shard_keys("fp", radius))).alias("key"), "fp")
    crowds = (
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > shard_rows)
        .select("key", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))
    )
    met = (
        keyed.join(broadcast_if_small(crowds), "key", "left")
        .withColumn("own", F.expr("cast(pmod(xxhash64(fp), coalesce(shards, 1)) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, coalesce(shards, 1) - 1)")))
        .selectExpr("key", "least(own, other) as low", "greatest(own, other) as high", "fp")
    )
    groups = met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")

    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, values, links = None, [], []
        for frame in frames:
            rows = zip(frame["key"], frame["low"], frame["high"], frame["fp"])
            for k, low, high, fp in rows:
                if (k, low, high) != key:
                    if len(values) > 1:
                        links += spanning_links(values, radius)
                    key, values = (k, low, high), []
                values.append(fp & 0xFFFFFFFFFFFFFFFF)
            if links:
                yield _frame(links)
                links = []
        if len(values) > 1:
            yield _frame(spanning_links(values, radius))

    return groups.mapInPandas(linked, "a long, b long")


def _frame(links: list[tuple[int, int]]) -> pd.DataFrame:
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(doc_id, fp, component_id, root)`` for every row of ``docs`` (``doc_id``, ``text``).

    Documents whose fingerprints differ in at most ``radius`` bits are linked, and
    ``component_id`` is the smallest doc_id reachable by links, itself included. Copies are
    reduced to their fingerprint before anything is linked; ``root`` is a fingerprint that names
    the component. NULL or blank text has fingerprint
    0 and links like any other. Rows may repeat; a NULL doc_id keeps its row, never names a
    component, and has a NULL component_id if all of its component is so. An empty table gives
    no rows.
    """
    fps = with_fingerprint(docs.select("doc_id", "text"), "fp", shingle_words)
    fps = stored(fps.select("doc_id", "fp"), "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    links = link_fingerprints(first.select("fp"), radius, shard_rows)
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "fp")
    named = roots.join(first, "fp").groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = roots.join(named, "root").select("fp", "component_id", "root")
    labels = first.join(linked, "fp", "left").select(
        F.col("fp").alias("label_fp"),
        F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("root", "fp").alias("root"),
    )
    # Copies share a fingerprint, so one may be that of many documents.
    named = spread_join(fps, labels, "fp", "label_fp", heavy_keys(fps, "fp"))
    return named.select("doc_id", "fp", "component_id", "root")


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id.

    Where that doc_id repeats within the component, or all its ids are NULL, the row with the
    smallest hash of its columns stays. Ids that stand once are kept by a semi-join; only rows
    whose id repeats or is NULL are fingerprinted again, to tell their components apart. Other
    columns stay as they are, whatever their names.
    """
    found = stored(near_duplicates(docs, shingle_words, radius), "components")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(first).alias("first"))
    single = (F.col("n") == 1) & F.col("doc_id").isNotNull()
    named = ids.filter(F.col("first") & single).select("doc_id")
    plain = docs.join(named, "doc_id", "left_semi").select(docs.columns)
    unclear = ids.filter(F.col("first") & ~single).select(F.col("doc_id").alias("_id"))
    groups = found.filter(first).select(F.col("doc_id").alias("_id"), "fp", "root").distinct()
    same_id = F.col("doc_id").eqNullSafe(F.col("_id"))
    # Rows are packed, so that no name of theirs meets one used here.
    packed = docs.select(
        "doc_id", F.struct(*docs.columns).alias("_row"), F.xxhash64(*docs.columns).alias("_hash")
    )
    again = packed.join(unclear, same_id, "left_semi").withColumn("text", F.col("_row.text"))
    rows = with_fingerprint(again, "_fp", shingle_words).select("doc_id", "_row", "_fp", "_hash")
    chosen = (
        rows.join(groups, same_id & (F.col("_fp") == F.col("fp")))
        .groupBy("root")
        .agg(F.min_by("_row", "_hash").alias("_row"))
    )
    return plain.unionByName(chosen.select("_row.*"))
