"""Exact top-k search by inner product, in three phases under a uniform threshold."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airstrata.session import ensure_checkpoint_dir

TOP_K = 20
SCALE = 64
# Local score lists of a vector: one for each half of its components.
LISTS = 2
# Queries of one block, whose vectors are sent to all tasks; rows scored at a time.
BLOCK_QUERIES = 4096
BLOCK_ROWS = 1024
# Pairs of a query and a row whose missing scores are resolved one by one; beyond this share of
# all pairs of a block, one product of matrices is cheaper.
PAIRS, PAIR_SHARE = 1 << 17, 1 / 8
# Stands for no score.
NONE = np.iinfo(np.int64).min // 4


def scaled(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``floor(scale * x)`` as integers, short vectors padded by 0, and which count.

    NULL vectors and such with NULL or non-finite components don't. The integers are exact:
    a product with a power of two and its floor are numbers of their own in double precision.
    """
    lengths = np.array([len(v) if v is not None else 0 for v in column.to_pylist()])
    valid = np.array(column.is_valid())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = int(lengths.max(initial=0))
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = flat
    valid &= np.isfinite(rows).all(axis=1)
    rows[~valid] = 0
    return np.floor(scale * rows), valid


def _largest(vectors: np.ndarray) -> np.ndarray:
    return np.abs(vectors).max(axis=1, initial=0)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products that fit a long; floats carry them exactly below 2**53."""
    bound = _largest(queries).max(initial=0) * _largest(rows).max(initial=0) * queries.shape[1]
    if bound < 2**53:
        return queries @ rows.T
    return queries.astype(np.int64) @ rows.astype(np.int64).T


def _pair_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """As ``_scores``, of the first query and the first row, the second ones, and so on."""
    bound = _largest(queries).max(initial=0) * _largest(rows).max(initial=0) * queries.shape[1]
    if bound >= 2**53:
        queries, rows = queries.astype(np.int64), rows.astype(np.int64)
    return np.einsum("ij,ij->i", queries, rows)


def _wide_score(query: np.ndarray, row: np.ndarray) -> int:
    """A product whose terms may be beyond a long, in whole numbers of any size."""
    found = sum(int(a) * int(b) for a, b in zip(query, row) if a and b)
    if not -(2**63) <= found < 2**63:
        raise OverflowError("an inner product of scaled vectors does not fit a long")
    return found


class QueryBlock:
    """Queries of one block, scored against the rows of a task in the phases of the search.

    A vector's components make two local lists, its first half and the rest. ``resolved``
    counts the pairs whose second list was looked at in the last phase.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.half = vectors.shape[1] // LISTS
        self.largest = _largest(vectors).max(initial=0)
        self.rest_norms = np.linalg.norm(vectors[:, self.half :], axis=1)
        self.resolved = 0

    def split(self, rows: np.ndarray) -> np.ndarray:
        """Which rows are so large that a product with a query may not fit a long."""
        return _largest(rows) * self.largest * max(1, rows.shape[1]) >= 2**62

    def wide(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of large rows, the query's own row being out."""
        found = np.full((len(self.ids), len(ids)), NONE, np.int64)
        for at, query in enumerate(self.vectors):
            for row in np.flatnonzero(ids != self.ids[at]):
                found[at, row] = _wide_score(query, rows[row])
        return found

    def local_lists(self, ids: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Scores by each list, the query's own row being out."""
        own = self.ids[:, None] == ids[None, :]
        parts = slice(0, self.half), slice(self.half, None)
        return [np.where(own, NONE, _scores(self.vectors[:, p], rows[:, p])) for p in parts]

    def gathered(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Phase one: the sums of rows that the heads of the local lists name, k a query.

        The k best entries of every local list are gathered, and of their rows the k best sums.
        """
        large = self.split(rows)
        sums = [self.wide(ids[large], rows[large])] if large.any() else []
        lists, k = self.local_lists(ids[~large], rows[~large]), self.k
        total = sum(lists)
        if total.shape[1] > k:
            heads = [np.argpartition(entries, -k, axis=1)[:, -k:] for entries in lists]
            chosen = np.zeros(total.shape, bool)
            for best in heads:
                np.put_along_axis(chosen, best, True, axis=1)
            total = np.where(chosen, total, NONE)
        gap = np.full((len(total), k), NONE)
        sums = np.concatenate([*sums, total.astype(np.int64), gap], axis=1)
        return np.partition(sums, -k, axis=1)[:, -k:].astype(np.int64)

    def survivors(
        self, ids: np.ndarray, rows: np.ndarray, cutoff: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phases two and three: query number, row id and score of what reaches the cutoff.

        A sum reaches the cutoff only if one of its two entries reaches the uniform threshold,
        the cutoff divided by the number of lists. Entries of the first list that do are
        collected. Those of the second list are not known yet; no entry is above the product of
        the norms of both rests. So a pair whose second entry cannot reach the threshold, or
        cannot lift the sum to the cutoff, is left with one list; the other pairs' missing
        scores are resolved exactly.
        """
        large = self.split(rows)
        wide = self.wide(ids[large], rows[large])
        at_wide, row_wide = np.nonzero(wide >= np.maximum(cutoff, NONE + 1)[:, None])
        found = [(at_wide, ids[large][row_wide], wide[at_wide, row_wide])]
        ids, rows = ids[~large], rows[~large]

        first = _scores(self.vectors[:, : self.half], rows[:, : self.half])
        room = self.rest_norms[:, None] * np.linalg.norm(rows[:, self.half :], axis=1)
        # Norms and sums are rounded; whatever is close counts as reaching.
        room = room * (1 + 1e-9) + np.abs(first) * 1e-9 + 1
        threshold = -(-cutoff // LISTS)[:, None]
        sufficient = (first >= threshold) | (room >= threshold)
        sufficient &= (first + room >= cutoff[:, None]) & (self.ids[:, None] != ids)
        at, row = np.nonzero(sufficient)
        self.resolved += len(at)
        if len(at) > PAIR_SHARE * sufficient.size:
            rest = _scores(self.vectors[:, self.half :], rows[:, self.half :])[at, row]
        else:
            parts = [slice(n, n + PAIRS) for n in range(0, len(at), PAIRS)]
            rest = [
                _pair_scores(self.vectors[at[p], self.half :], rows[row[p], self.half :]) for p in parts
            ]
            rest = np.concatenate(rest) if rest else np.zeros(0)
        score = first[at, row].astype(np.int64) + rest.astype(np.int64)
        keep = score >= cutoff[at]
        found.append((at[keep], ids[row[keep]], score[keep]))
        return tuple(np.concatenate(column) for column in zip(*found))


def _blocks(incoming: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple]:
    for batch in incoming:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            rows, valid = scaled(part.column("embedding"), scale)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            if valid.any():
                yield ids[valid], rows[valid]


def _fitted(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))[:, :width]


def _gathered_rows(incoming, block, scale) -> Iterator[pa.RecordBatch]:
    """The k best gathered sums of a task for each query."""
    block, best = block.value, None
    for ids, rows in _blocks(incoming, scale):
        found = block.gathered(ids, _fitted(rows, block.vectors.shape[1]))
        if best is not None:
            found = np.partition(np.concatenate((best, found), axis=1), -block.k, axis=1)
        best = found[:, -block.k :]
    if best is not None:
        query, _ = np.nonzero(best > NONE)
        arrays = [pa.array(query.astype(np.int32)), pa.array(best[best > NONE])]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "gathered"])


def _survivor_rows(incoming, block, cutoff, scale) -> Iterator[pa.RecordBatch]:
    block = block.value
    for ids, rows in _blocks(incoming, scale):
        at, row, score = block.survivors(ids, _fitted(rows, block.vectors.shape[1]), cutoff)
        arrays = [pa.array(block.ids[at]), pa.array(row), pa.array(score)]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = TOP_K,
    scale: int = SCALE,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest scores of each query.

    Both tables have ``vec_id`` and ``embedding``. The score is the integer inner product of
    ``floor(scale * x)``; ties go to the smaller vec_id. Rows with the query's own vec_id are
    no candidates. Rows without vec_id or with an unusable vector (``scaled``) take no part; of
    vectors that differ in length, missing components count 0. A repeated query is answered
    once (by its smallest vector), a repeated row is a candidate each time. Empty tables give
    no rows. Scores are exact for components of any size; one that does not fit a long, of any
    query and candidate, fails the job with an OverflowError.

    Queries are taken in blocks of bounded size, each of which scans the vectors twice: for
    the cutoffs (k numbers a query and task), and for the rows that reach them.
    The blocks' results are appended to a table in the shared folder, so memory does not
    depend on the number of queries.
    """
    spark = vectors.sparkSession
    vectors = vectors.filter("vec_id is not null").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    queries = queries.filter("vec_id is not null").groupBy(F.col("vec_id").cast("long")).agg(
        F.min(F.col("embedding").cast("array<double>")).alias("embedding")
    )
    n_blocks = -(-queries.count() // block_queries)
    folder = f"{ensure_checkpoint_dir(spark)}/top-k-{uuid.uuid4().hex}"
    schema = "query_id long, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for number in range(n_blocks):
        part = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == number)
        found = part.toArrow().combine_chunks()
        rows, valid = scaled(found.column("embedding").combine_chunks(), scale)
        ids = found.column("vec_id").to_numpy()[valid]
        if not len(ids):
            continue
        block = spark.sparkContext.broadcast(QueryBlock(ids, rows[valid], k))
        first = vectors.mapInArrow(
            partial(_gathered_rows, block=block, scale=scale), "query int, gathered long"
        )
        # The k-th best of all gathered sums: k rows reach it, so it is safe.
        best = Window.partitionBy("query").orderBy(F.desc("gathered"))
        kth = first.withColumn("at", F.row_number().over(best)).filter(F.col("at") == k)
        cutoff = np.full(len(ids), NONE, np.int64)
        for row in kth.select("query", "gathered").collect():
            cutoff[row["query"]] = row["gathered"]
        vectors.mapInArrow(
            partial(_survivor_rows, block=block, cutoff=cutoff, scale=scale), schema
        ).write.mode("append").parquet(folder)
        block.unpersist()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(folder)
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
