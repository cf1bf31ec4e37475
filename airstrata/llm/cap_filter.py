"""Near-duplicate vectors by spherical-cap filters with random product codes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.llm.components import connected_components
from airstrata.operators.sizing import broadcast_if_small
from airstrata.session import stored

MIN_COSINE = 0.95
# Independent product codes, the filters a vector passes in each on average, and the vectors
# of one filter. Recall is measured in the tests.
CODES = 4
FILTERS = 10
FILTER_ROWS = 150
SHARD_ROWS = 1024
SEED = 11


class Codes:
    """Random product codes for vectors of one width.

    A code rotates the space and cuts it into two halves; a filter's direction is a pair of
    codewords, one from each half, so ``words ** 2`` filters need ``2 * words`` inner products.
    """

    def __init__(self, width: int, words: int, filters: float):
        rng = np.random.default_rng([SEED, width, words])
        self.words = words
        half = width // 2
        self.codes = []
        for _ in range(CODES):
            turned, _ = np.linalg.qr(rng.normal(size=(width, width)))
            books = rng.normal(size=(2, words, half))
            books /= np.linalg.norm(books, axis=2, keepdims=True) * math.sqrt(2)
            self.codes.append((turned[:, :half] @ books[0].T, turned[:, half:] @ books[1].T))
        self.reach = cap_height(width, filters / words**2)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each row, all filters of which its inner product reaches the cap's height.

        The inner product is a sum of one term from each half. The codewords of the second half
        are taken in order of their term, so that those that suffice are a prefix.
        """
        found: list[list[np.ndarray]] = [[] for _ in unit]
        for code, (first, second) in enumerate(self.codes):
            lefts, rights = unit @ first, unit @ second
            orders = np.argsort(-rights, axis=1)
            ranked = -np.take_along_axis(rights, orders, axis=1)
            for row in range(len(unit)):
                fit = np.searchsorted(ranked[row], lefts[row] - self.reach, side="right")
                some = np.flatnonzero(fit)
                taken = fit[some]
                places = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
                numbers = np.repeat(some, taken) * self.words + orders[row][places]
                found[row].append(numbers + code * self.words**2)
        return [np.sort(np.concatenate(parts)) for parts in found]


def cap_height(width: int, share: float) -> float:
    """The inner product with a fixed direction that ``share`` of all unit vectors exceed."""
    grid = np.linspace(-1, 1, 200_001)
    density = np.clip(1 - grid**2, 0, None) ** ((width - 3) / 2)
    above = np.cumsum(density[::-1])[::-1] / density.sum()
    return float(grid[np.searchsorted(-above, -share)])


@lru_cache(maxsize=4)
def _codes(width: int, words: int, filters: float) -> Codes:
    return Codes(width, words, filters)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares of extreme components stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _filtered(incoming, words, filters) -> Iterator[pa.RecordBatch]:
    """Filters of each vector, tagged with its width: only vectors of one width are compared."""
    for batch in incoming:
        column = batch.column("embedding")
        lengths = np.array([len(v) for v in column.to_pylist()])
        ends = np.cumsum(lengths)
        flat = column.flatten().to_numpy(zero_copy_only=False)
        out: list = [None] * len(lengths)
        vectors: list = [None] * len(lengths)
        for width in np.unique(lengths):
            members = np.flatnonzero(lengths == width)
            rows = flat[(ends[members] - width)[:, None] + np.arange(width)]
            unit = unit_rows(rows)
            even = max(8, width + width % 2)
            padded = np.pad(unit, ((0, 0), (0, even - width)))
            tag = int(width) << 48
            for i, row, numbers in zip(members, unit, _codes(even, words, filters).decode(padded)):
                out[i] = numbers + tag
                vectors[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                batch.column("copies"),
                pa.array(vectors, pa.binary()),
                pa.array([numbers.tobytes() for numbers in out], pa.binary()),
                pa.array(out, pa.list_(pa.int64())),
            ],
            names=["node", "copies", "unit", "passed", "filters"],
        )


def _block_links(rows: list[tuple], filter_id: int, cross: bool, cosine: float) -> list[tuple]:
    """``(node, links, root)`` for the members of a block that no earlier filter linked.

    A link is counted by the first filter its two vectors share. Of a block of two shards only
    links between the shards count. ``root`` is the smallest node of the block that the new
    links reach.
    """
    unit = np.array([np.frombuffer(row[2]) for row in rows])
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if cross:
        own = np.array([row[4] for row in rows])
        linked &= own[:, None] != own[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return []
    linked = linked[np.ix_(some, some)]
    earlier = [np.frombuffer(rows[i][3], np.int64) for i in some]
    earlier = [numbers[numbers < filter_id] for numbers in earlier]
    known = np.unique(np.concatenate(earlier))
    held = np.zeros((len(some), len(known)), np.float32)
    for line, numbers in zip(held, earlier):
        line[np.searchsorted(known, numbers)] = 1
    linked &= held @ held.T == 0
    nodes = np.array([rows[i][0] for i in some])
    copies = np.array([rows[i][1] for i in some])
    counts = linked @ copies
    roots, free = nodes.copy(), linked.any(axis=1)
    for i in np.argsort(nodes):
        if free[i]:
            reached = np.zeros(len(some), bool)
            edge = reached.copy()
            edge[i] = True
            while edge.any():
                reached |= edge
                edge = linked[edge].any(axis=0) & ~reached
            roots[reached] = nodes[i]
            free &= ~reached
    return [x for x in zip(nodes.tolist(), counts.tolist(), roots.tolist()) if x[1]]


def _linked(incoming: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    key, rows = None, []

    def frame(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in found], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "root"])

    for batch in incoming:
        names = ("filter", "low", "high", "node", "copies", "unit", "passed", "own")
        out = []
        for k, low, high, *rest in zip(*[batch.column(c).to_pylist() for c in names]):
            if (k, low, high) != key:
                if len(rows) > 1:
                    out += _block_links(rows, key[0], key[1] != key[2], cosine)
                key, rows = (k, low, high), []
            rows.append((rest[0], rest[1], rest[2], rest[3], rest[4]))
        if out:
            yield frame(out)
    if len(rows) > 1:
        yield frame(_block_links(rows, key[0], key[1] != key[2], cosine))


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = MIN_COSINE,
    filters: int = FILTERS,
    filter_rows: int = FILTER_ROWS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows (``vec_id``, ``embedding``) are linked if their cosine, in double precision, is at
    least ``cosine``; ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable. Vectors that are NULL, zero or hold NULL or non-finite
    components link with nothing, nor do vectors of different length. A repeated row counts as
    another row. A NULL vec_id names no component. An empty table gives no rows.

    Equal vectors are one node with a number of copies. The number of filters follows the
    number of nodes, so that a filter holds about ``filter_rows`` of them at any size; a filter
    with more than ``shard_rows`` is dealt into shards that meet in pairs. Blocks hand on a
    count and a root for each member, never their pairs.
    """
    good = F.expr(
        "embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null "
        "and not isnan(x) and abs(x) < double('inf')) and exists(embedding, x -> x != 0)"
    )
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    nodes = (
        rows.filter(good)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stored(nodes, "vectors")
    words = max(8, math.ceil(math.sqrt(nodes.count() * filters / filter_rows)))
    passed = nodes.mapInArrow(
        partial(_filtered, words=words, filters=filters),
        "node long, copies long, unit binary, passed binary, filters array<long>",
    )
    passed = stored(passed, "filters")
    crowds = (
        passed.select(F.explode("filters").alias("filter"))
        .groupBy("filter")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > shard_rows)
        .select("filter", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))
    )
    placed = (
        passed.select(F.explode("filters").alias("filter"), "node", "copies", "unit", "passed")
        .join(broadcast_if_small(crowds), "filter", "left")
        .withColumn("own", F.expr("cast(pmod(xxhash64(node), coalesce(shards, 1)) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, coalesce(shards, 1) - 1)")))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("shards", "other")
    )
    blocks = placed.repartition("filter", "low", "high").sortWithinPartitions(
        "filter", "low", "high", "node"
    )
    found = blocks.mapInArrow(partial(_linked, cosine=cosine), "node long, links long, root long")
    found = stored(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "root")
    named = roots.join(nodes.select("node", "first_id"), "node")
    named = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(named, "root").select("node", "component_id")
    labels = (
        nodes.join(links, "node", "left")
        .join(named, "node", "left")
        .select(
            "embedding",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(labels, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
