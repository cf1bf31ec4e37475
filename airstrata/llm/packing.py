"""Packing of tokenized documents into sequences along a space-filling curve."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airstrata.llm.bpe import ChunkCache, byte_letters, unsure
from airstrata.llm.common import batches
from airstrata.session import stored

SEQUENCE_TOKENS = 2048
END_ID = 1
# Document vectors: hashed token buckets, projected to a few axes of so many bits each.
BUCKETS = 512
AXES = 4
AXIS_BITS = 10
SEED = 7

# The split pattern of byte-level vocabularies, a fixed value of their format.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A space before a letter always begins a piece, so texts may be cut there.
CUT = re.compile(r" (?=\S)")


class ByteBpe:
    """Ids of a byte-level tokenizer file.

    A text is cut at its single spaces and each chunk's ids are kept in a bounded cache. A
    chunk is encoded by the merges of the file; where it holds letters younger than Python's
    tables, by the tokenizers library itself, whose tables then decide.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        ranks = {
            bytes(byte_of[letter] for letter in token): number
            for token, number in spec["model"]["vocab"].items()
        }
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.special = list(special)
        self.library = Tokenizer.from_file(path)
        self.merges = tiktoken.Encoding(
            "file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.chunks = ChunkCache(self._encode_chunk)

    def _encode_chunk(self, chunk: str) -> bytes | None:
        """Ids of a chunk and the space before it; None for what is no chunk."""
        if not chunk or chunk[0].isspace():
            return None
        return self._ids(f" {chunk}")

    def _ids(self, text: str) -> bytes:
        if text.isascii() or not unsure(text):
            special = any(mark in text for mark in self.special)
            ids = self.merges.encode(text, allowed_special="all") if special else (
                self.merges.encode_ordinary(text)
            )
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        first, *rest = text.split(" ")
        try:
            found = b"".join(map(self.chunks.__getitem__, rest))
        except TypeError:  # some space stands before another or at the end
            first, *rest = CUT.split(text)
            found = b"".join(map(self.chunks.__getitem__, rest))
        return self._ids(first) + found


@lru_cache(maxsize=2)
def load_byte_bpe(path: str) -> ByteBpe:
    """The tokenizer of a file, once for each worker."""
    return ByteBpe(path)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer points, one row each, of ``bits`` an axis.

    The curve's cells are turned back level by level (inverse undo of the excess work), then
    the Gray code is taken off and the axes' bits are interleaved.
    """
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turned ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turned
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def document_points(encoded: list[np.ndarray]) -> np.ndarray:
    """Grid points of documents, given by their ids: hashed counts, projected to a few axes."""
    projection = np.random.default_rng(SEED).normal(size=(BUCKETS, AXES))
    counts = np.array([np.bincount(hashed(ids), minlength=BUCKETS) for ids in encoded])
    vectors = np.log1p(counts.reshape(-1, BUCKETS))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    placed = vectors / np.where(norms == 0, 1, norms) @ projection
    side = 1 << AXIS_BITS
    return np.clip(((placed + 4) / 8 * side).astype(np.int64), 0, side - 1)


def hashed(ids: np.ndarray) -> np.ndarray:
    """A bucket for each id, by multiplication."""
    return (ids.astype(np.uint32) * np.uint32(2654435769) >> np.uint32(32 - 9)).astype(np.int64)


def tokenize(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, curve, doc_tokens, ids)``: packed ids with the end id, place on the curve."""

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_byte_bpe(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in incoming:
            rows = zip(batch.column("doc_id"), batch.column("text"))
            sized = (((i, t), len(t.as_py())) for i, t in rows)
            for held in batches(sized, 4 << 20):
                coded = [tokenizer.encode(text.as_py()) + end for _, text in held]
                ids = [np.frombuffer(code, "<u4") for code in coded]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i.as_py() for i, _ in held], batch.schema.field("doc_id").type),
                        pa.array(hilbert_keys(document_points(ids), AXIS_BITS)),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([packed(x) for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "curve", "doc_tokens", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {kind}, curve long, doc_tokens long, ids binary"
    )


def pack_documents(
    docs: DataFrame, path: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all ``docs`` (``doc_id``, ``text``), packed into full sequences.

    The documents' tokens, end ids included, are laid end to end in the order of the Hilbert
    curve through their hashed vectors and cut every ``sequence_tokens``; only the very last
    sequence is not full. Columns: ``doc_id``, ``start`` (ids of the document before the
    piece), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset``.

    The tokenized rows are stored once with a row number; places on the curve are found on
    narrow columns (range sort by curve and row, so that many equal documents spread over
    ranges; running sums within a range; one total for each range) and meet the ids in one
    join on the row number. NULL text is empty and has its end id only. Rows may repeat, ids
    may be NULL: every row is packed. An empty table gives no pieces.
    """
    tokens = tokenize(docs, path, end_id).withColumn("row", F.monotonically_increasing_id())
    tokens = stored(tokens, "tokens")
    ordered = (
        tokens.select("row", "curve", "doc_tokens")
        .repartitionByRange("curve", "row")
        .sortWithinPartitions("curve", "row")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("range", F.shiftrightunsigned("place", 33))
    )
    ordered = stored(ordered.select("row", "doc_tokens", "place", "range"), "curve")
    totals = ordered.groupBy("range").agg(F.sum("doc_tokens").alias("tokens"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, so at most as many as there are partitions.
    totals = totals.select("range", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    within = (
        Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = (
        ordered.withColumn("inner", F.coalesce(F.sum("doc_tokens").over(within), F.lit(0)))
        .join(totals, "range")
        .select("row", (F.col("base") + F.col("inner")).alias("begin"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return tokens.join(begins, "row").select("doc_id", "doc_tokens", "ids", "begin").mapInArrow(
        partial(_cut, size=sequence_tokens),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long",
    )


def _cut(incoming: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pieces of documents, cut where a sequence ends."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    for batch in incoming:
        begin = batch.column("begin").to_numpy()
        total = batch.column("doc_tokens").to_numpy()
        first, last = begin // size, (begin + total - 1) // size
        pieces = last - first + 1
        row = np.repeat(np.arange(len(begin)), pieces)
        sequence = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + first[row]
        low = np.maximum(begin[row], sequence * size)
        high = np.minimum(begin[row] + total[row], (sequence + 1) * size)
        start, length = low - begin[row], high - low
        codes = batch.column("ids").to_pylist()
        for at in range(0, len(row), 4096):
            part = slice(at, at + 4096)
            ids = [
                unpacked(codes[i], n)[s : s + k].tobytes()
                for i, n, s, k in zip(
                    row[part], total[row[part]], start[part].tolist(), length[part].tolist()
                )
            ]
            where = pa.array(row[part])
            columns = [start[part], length[part], sequence[part], low[part] - sequence[part] * size]
            start_, length_, sequence_, offset_ = map(pa.array, columns)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(where),
                    start_,
                    length_,
                    pa.array(ids, pa.binary()),
                    batch.column("doc_tokens").take(where),
                    sequence_,
                    offset_,
                ],
                names,
            )


def packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each, if all of them fit, else in four."""
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else ids.tobytes()


def unpacked(code: bytes, count: int) -> np.ndarray:
    return np.frombuffer(code, f"<u{len(code) // count}").astype("<u4")
