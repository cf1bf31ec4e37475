"""Ranked lexical search with bit-sliced Bloom signatures.

Each document has a Bloom filter of its terms and of how often they occur at least. Filters of
up to a few thousand documents of a similar size make a block, stored by bit: a slice is the
bitmap of the documents that have that bit set. The slices of a query's term, combined by AND,
are the documents that may hold it so often; their weighted sums bound every document's score
from above. A few documents with the highest bounds are scored from their texts, which gives
each query a score that its last result reaches at least; then every document whose bound is
not below that score is scored from its text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airstrata.operators.sizing import broadcast_if_small
from airstrata.session import stored

K = 10
# Documents with the highest bounds that are scored first, for each result wanted.
SEEDS = 4
# A signature tells whether a term occurs at least this often; the last step is open-ended.
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 32, 64)
# Bits a signature has for each term and step at least, those it sets, and its largest size.
BITS_PER_ENTRY, PROBES, MOST_BITS = 8, 3, 1 << 21
# Bits of a block before packing, texts handled at once, and numbers in a table of bounds.
BLOCK_BITS, SLICE_BYTES, CELLS = 1 << 24, 8 << 20, 1 << 21
# Queries that are answered together: rows and bytes of their texts.
QUERY_ROWS, QUERY_BYTES = 512, 8 << 20

# The bytes that terms are made of, A-Z as a-z; all others end a term. Bytes from 0x80 on are
# parts of code points beyond ASCII, which all belong to terms.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)


@dataclass
class Counts:
    """Terms of some documents: entry i says that ``doc[i]`` holds ``terms[term[i]]`` ``tf[i]`` times."""

    n_terms: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    terms: pa.StringArray


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.StringArray]]:
    """Parts of a column with the row they begin at, each small or a single text; NULL is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        data = memoryview(texts.buffers()[2] or b"")[offsets[start] : offsets[end]]
        bounds = (offsets[start : end + 1] - offsets[start]).astype(np.int64)
        lowered = pa.py_buffer(bytes(data).translate(TERM_BYTES))
        yield start, pa.LargeStringArray.from_buffers(end - start, pa.py_buffer(bounds.tobytes()), lowered)
        start = end


def count_terms(lowered: pa.Array) -> Counts:
    """``Counts`` of texts in which only bytes of terms and blanks are left (``slices``)."""
    split = pc.ascii_split_whitespace(lowered)
    terms, docs = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.not_equal(terms, "")
    coded = terms.filter(real).dictionary_encode()
    docs = docs.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    entries, tf = np.unique(docs * size + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    n_terms = np.bincount(docs, minlength=len(lowered))
    return Counts(n_terms, entries // size, entries % size, tf, coded.dictionary)


def term_hashes(terms: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in terms], np.uint64)


def probes(hashes: np.ndarray, step: np.ndarray, bits: int) -> np.ndarray:
    """The bits that a term of that hash sets if it reaches that step, as rows of ``PROBES``."""
    mixed = hashes + (step.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    shifts = np.arange(PROBES, dtype=np.uint64) * np.uint64(21)
    return ((mixed[..., None] >> shifts) & np.uint64(bits - 1)).astype(np.int64)


def _blocks(counts: Counts) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
    """``(bits, documents, highest tf, slices)`` of documents whose signatures have one size."""
    steps = np.searchsorted(STEPS, counts.tf, "right")
    owner = np.repeat(np.arange(len(counts.tf)), steps)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)
    hashes = term_hashes(counts.terms.to_pylist())
    n_docs = len(counts.n_terms)
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, counts.doc, counts.tf)
    entries = np.bincount(counts.doc, weights=steps, minlength=n_docs)
    wanted = np.maximum(64, entries * BITS_PER_ENTRY)
    sizes = np.minimum(MOST_BITS, 1 << np.ceil(np.log2(wanted)).astype(np.int64))
    sizes[counts.n_terms == 0] = 0
    for bits in sorted(set(sizes.tolist()) - {0}):
        width = max(8, BLOCK_BITS // bits)
        members = np.flatnonzero(sizes == bits)
        for at in range(0, len(members), width):
            docs = members[at : at + width]
            place = np.full(n_docs, -1)
            place[docs] = np.arange(len(docs))
            here = np.flatnonzero(place[counts.doc[owner]] >= 0)
            found = probes(hashes[counts.term[owner[here]]], step[here], bits)
            table = np.zeros((bits, len(docs)), bool)
            table[found, place[counts.doc[owner[here]]][:, None]] = True
            yield bits, docs, top[docs], np.packbits(table, axis=1).tobytes()


def build_signatures(docs: DataFrame) -> DataFrame:
    """Blocks of signatures: ``(bits, doc_ids, n_terms, top_tf, slices)``, stored.

    Documents without a term are in no block. A block's documents come from one batch and have
    signatures of one size, at least ``BITS_PER_ENTRY`` bits for each term and step, so a long
    document fills its own as much as a short one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, texts in slices(batch.column("text")):
                counts = count_terms(texts)
                for bits, members, top, data in _blocks(counts):
                    rows = [
                        pa.array([bits], pa.int32()),
                        pa.array([ids.take(pa.array(members + start)).to_pylist()], pa.list_(ids.type)),
                        pa.array([counts.n_terms[members]], pa.list_(pa.int64())),
                        pa.array([top], pa.list_(pa.int64())),
                        pa.array([data], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(rows, ["bits", "doc_ids", "n_terms", "top_tf", "slices"])

    schema = f"bits int, doc_ids array<{kind}>, n_terms array<long>, top_tf array<long>, slices binary"
    return stored(docs.select("doc_id", "text").mapInArrow(signed, schema), "signatures")


@dataclass
class Queries:
    """Some items with their distinct terms, and what scoring needs of the corpus."""

    ids: list
    terms: list[str]
    # The terms of item i are term[start[i]] to term[start[i + 1] - 1]; every item has one.
    term: np.ndarray
    start: np.ndarray
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    def lengths(self, n_terms: np.ndarray) -> np.ndarray:
        """What a document's number of terms adds to the divisor of a term's score."""
        return 8 * (100 - 90 + (90 * n_terms.astype(np.int64) * self.n_docs) // self.n_terms)

    def per_item(self, values: np.ndarray) -> np.ndarray:
        """Sums over the terms of each item, of values by distinct term."""
        return np.add.reduceat(values[self.term], self.start[:-1], axis=0)


def saturated(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + length)


def read_queries(items: DataFrame) -> Iterator[Queries]:
    """The items that have a term, a bounded number of rows and bytes at a time."""

    def made(rows: list) -> Queries | None:
        # A text is a slice of its own if it is long, so its terms are put together by row.
        found: dict[str, int] = {}
        terms: list[list[int]] = [[] for _ in rows]
        for start, texts in slices(pa.array([r["text"] for r in rows], pa.string())):
            counts = count_terms(texts)
            words = counts.terms.to_pylist()
            for doc, term in zip(counts.doc.tolist(), counts.term.tolist()):
                terms[start + doc].append(found.setdefault(words[term], len(found)))
        kept = [i for i, t in enumerate(terms) if t]
        if not kept:
            return None
        sizes = [0, *(len(terms[i]) for i in kept)]
        flat = np.array([t for i in kept for t in terms[i]], np.int64)
        return Queries([rows[i]["item_id"] for i in kept], list(found), flat, np.cumsum(sizes))

    rows, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        rows.append(row)
        size += len(row["text"] or "")
        if len(rows) == QUERY_ROWS or size >= QUERY_BYTES:
            if queries := made(rows):
                yield queries
            rows, size = [], 0
    if rows and (queries := made(rows)):
        yield queries


def document_frequencies(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """How many documents hold each of the terms, by one pass over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(terms), np.int64)
        wanted = pa.array(terms, pa.large_string())
        for batch in batches:
            for _, texts in slices(batch.column("text")):
                counts = count_terms(texts)
                number = pc.fill_null(pc.index_in(counts.terms, wanted), -1).to_numpy()[counts.term]
                found += np.bincount(number[number >= 0], minlength=len(terms))
        here = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(found[here])], ["term", "df"])

    counts = docs.select("text").mapInArrow(counted, "term long, df long")
    total = np.zeros(len(terms), np.int64)
    # One row a term at most, and the terms of a query block are bounded.
    for row in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        total[row["term"]] = row["df"]
    return total


def upper_bounds(
    queries: Queries, bits: int, n_terms: np.ndarray, top_tf: np.ndarray, data: bytes
) -> Iterator[tuple[int, np.ndarray]]:
    """``(first document, bounds by item and document)`` for parts of a block."""
    table = np.frombuffer(data, np.uint8).reshape(bits, -1)
    hashes = term_hashes(queries.terms)
    n_steps = len(STEPS)
    places = probes(hashes[:, None], np.arange(n_steps)[None, :], bits)
    # A term that reaches c steps occurs at most this often.
    most = [np.minimum(step - 1, top_tf) for step in STEPS] + [top_tf]
    factors = saturated(np.array(most), queries.lengths(n_terms))
    width = max(1, CELLS // (8 * max(len(hashes), len(queries.ids))))
    for at in range(0, table.shape[1], width):
        part = table[:, at : at + width]
        first, last = 8 * at, min(8 * (at + part.shape[1]), len(n_terms))
        reached = np.zeros((len(hashes), last - first), np.int8)
        alive, held = np.arange(len(hashes)), None
        for step in range(n_steps):
            now = np.bitwise_and.reduce(part[places[alive, step]], axis=1)
            held = now if held is None else held & now
            some = held.any(axis=1)
            alive, held = alive[some], held[some]
            reached[alive] += np.unpackbits(held, axis=1, count=last - first).view(np.int8)
        values = factors[reached, np.arange(first, last)] * queries.weights[:, None]
        yield first, queries.per_item(values)


def _bounded(queries: Queries, choose: Callable) -> Callable:
    """A task over blocks: ``choose`` takes ids and bounds by item and gives batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picked = choose()
        for batch in batches:
            for row in range(batch.num_rows):
                bits, ids, n_terms, top_tf, data = (batch.column(c)[row] for c in range(5))
                n_terms = np.asarray(n_terms.values)
                parts = upper_bounds(
                    queries, bits.as_py(), n_terms, np.asarray(top_tf.values), data.as_buffer()
                )
                for first, bounds in parts:
                    yield from picked.take(ids.values.slice(first, bounds.shape[1]), bounds)
        yield from picked.rest()

    return run


def _pairs(item: np.ndarray, ids: pa.Array, bound: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(item.astype(np.int32)), ids, pa.array(bound.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "bound"])


class Highest:
    """Of all documents of a task, those with an item's highest bounds."""

    def __init__(self, n: int):
        self.n = n
        self.held: dict[int, tuple[np.ndarray, pa.Array]] = {}

    def take(self, ids: pa.Array, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for item, values in enumerate(bounds):
            before, named = self.held.get(item, (np.zeros(0, np.int64), ids.slice(0, 0)))
            least = before.min() if len(before) == self.n else 0
            here = np.flatnonzero(values > least)
            if len(here):
                values = np.concatenate([before, values[here]])
                named = pa.concat_arrays([named, ids.take(pa.array(here))])
                best = np.argsort(-values, kind="stable")[: self.n]
                self.held[item] = values[best], named.take(pa.array(best))
        yield from ()

    def rest(self) -> Iterator[pa.RecordBatch]:
        for item, (values, ids) in self.held.items():
            yield _pairs(np.full(len(values), item), ids, values)


class NotBelow:
    """Of all documents, those whose bound is not below the item's cutoff."""

    def __init__(self, cutoffs: np.ndarray):
        self.cutoffs = cutoffs

    def take(self, ids: pa.Array, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        item, doc = np.nonzero(bounds >= self.cutoffs[:, None])
        if len(item):
            yield _pairs(item, ids.take(pa.array(doc)), bounds[item, doc])

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from ()


def exact_scores(docs: DataFrame, pairs: DataFrame, queries: Queries) -> DataFrame:
    """``(item, doc_id, score)`` from the texts of the documents in ``pairs``; scores above 0."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = pairs.groupBy(F.col("doc_id").alias("wanted_id")).agg(F.collect_set("item").alias("items"))
    wanted = broadcast_if_small(wanted)
    chosen = docs.select("doc_id", "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))
    ).drop("wanted_id")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(queries.terms, pa.large_string())
        for batch in batches:
            ids, items = batch.column("doc_id"), batch.column("items")
            for start, texts in slices(batch.column("text")):
                counts = count_terms(texts)
                number = pc.fill_null(pc.index_in(counts.terms, known), -1).to_numpy()[counts.term]
                hit = number >= 0
                number, doc, tf = number[hit], counts.doc[hit], counts.tf[hit]
                edges = np.searchsorted(doc, np.arange(len(texts) + 1))
                values = queries.weights[number] * saturated(tf, queries.lengths(counts.n_terms)[doc])
                rows, found, scores = [], [], []
                for row in range(len(texts)):
                    dense = np.zeros(len(queries.terms), np.int64)
                    here = slice(edges[row], edges[row + 1])
                    dense[number[here]] = values[here]
                    asked = np.asarray(items[start + row].values)
                    score = queries.per_item(dense)[asked]
                    rows.append(np.full((score > 0).sum(), start + row))
                    found.append(asked[score > 0])
                    scores.append(score[score > 0])
                rows = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), ids.take(rows), pa.array(np.concatenate(scores))],
                    ["item", "doc_id", "score"],
                )

    return chosen.mapInArrow(scored, f"item int, doc_id {kind}, score long")


def _best(scores: DataFrame, value: str, n: int) -> DataFrame:
    order: list[Column] = [F.desc(value), F.asc_nulls_last("doc_id")]
    ranked = scores.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def search(items: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents of each item.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased, in
    the whole text. A term's weight is w = floor(1000 * ln((2N + 2) / (2 df + 1))), where N
    documents have a term and df hold this one. A document of n terms, where all have L, has
    m = 10 + 90 n N div L and scores the sum of w * (10^9 tf div (1000 tf + 8 m)) over the item's
    distinct terms. Only scores above 0 are listed; equal scores go by ascending doc_id, NULL
    ids last.

    NULL and empty texts have no terms: such items get no rows, such documents are in no list
    and count for nothing. Each row of either table stands for itself, also where ids or whole
    rows repeat; other columns play no part. Empty tables give no rows. Items are answered in
    blocks of ``QUERY_ROWS``, each against all documents.
    """
    spark = docs.sparkSession
    signatures = build_signatures(docs)
    size = signatures.agg(
        F.sum(F.size("doc_ids")).alias("n_docs"),
        F.sum(F.aggregate("n_terms", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n_terms"),
    ).first()
    kinds = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    results = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    if not size["n_docs"]:
        return results
    chosen = f"item int, doc_id {kinds[1]}, bound long"
    for queries in read_queries(items):
        queries.n_docs, queries.n_terms = size["n_docs"], size["n_terms"]
        df = document_frequencies(docs, queries.terms).tolist()
        queries.weights = np.array(
            [math.floor(1000 * math.log((2 * queries.n_docs + 2) / (2 * n + 1))) for n in df], np.int64
        )
        seeds = signatures.mapInArrow(_bounded(queries, lambda: Highest(SEEDS * k)), chosen)
        first = exact_scores(docs, stored(_best(seeds, "bound", SEEDS * k), "seeds"), queries)
        reached = _best(first, "score", k).groupBy("item").agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("least")
        )
        # One row an item of this block.
        cutoffs = np.ones(len(queries.ids), np.int64)
        for row in reached.filter(F.col("n") == k).collect():
            cutoffs[row["item"]] = row["least"]
        left = signatures.mapInArrow(_bounded(queries, lambda: NotBelow(cutoffs)), chosen)
        scores = exact_scores(docs, stored(left, "candidates"), queries)
        named = spark.createDataFrame(list(enumerate(queries.ids)), f"item int, item_id {kinds[0]}")
        best = _best(scores, "score", k).join(F.broadcast(named), "item")
        results = results.unionByName(
            stored(best.select("item_id", "rank", "doc_id", "score"), "ranked")
        )
    return results
