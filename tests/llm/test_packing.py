from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from airstrata.llm import packing
from airstrata.llm.queries import op9_curve_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_hilbert_curve_visits_every_cell_once_and_moves_one_step():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = packing.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check_layout(rows, texts, size):
    library = Tokenizer.from_file(PATH)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    spans = {}
    for row in rows:
        piece = ids[row.doc_id][row.start : row.start + row.length]
        assert len(piece) == row.length > 0
        assert row.doc_tokens == len(ids[row.doc_id])
        assert row.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        spans.setdefault(row.doc_id, []).append((row.start, row.length))
    for doc, found in spans.items():
        ends = list(itertools.accumulate(length for _, length in sorted(found)))
        assert [start for start, _ in sorted(found)] == [0, *ends[:-1]] and ends[-1] == len(ids[doc])
    assert set(spans) == set(texts)
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for number, pieces in by_sequence.items():
        pieces.sort()
        ends = list(itertools.accumulate(length for _, length in pieces))
        assert [offset for offset, _ in pieces] == [0, *ends[:-1]]
        assert ends[-1] == size or number == max(by_sequence) and ends[-1] < size


def test_query_lays_out_every_id_once(spark):
    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    check_layout(op9_curve_packing(spark, small).collect(), texts, 2048)


@pytest.mark.parametrize("size", [1, 7, 2048])
def test_small_and_odd_rows(spark, size):
    texts = {1: None, 2: "", 3: "same words", 4: "same words", 5: "z " * 3000, 6: "é 日本\n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.selectExpr("*", "0 as row", "1 as curve")
    found = packing.pack_documents(docs, PATH, size).selectExpr("*", "crc32(ids) as ids_crc32")
    check_layout(found.collect(), texts, size)


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "a"), (1, "a")], "doc_id int, text string")
    found = packing.pack_documents(docs, PATH, 4).collect()
    assert sum(r.length for r in found) == 6
    assert sum(r.length for r in found if r.doc_id is None) == 2
    assert packing.pack_documents(docs.limit(0), PATH).collect() == []


def test_neighbours_on_the_curve_are_alike(spark):
    rows = [(i, ("red green blue " if i % 2 else "un deux trois ") * 20) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = packing.pack_documents(docs, PATH, 64).collect()
    order = [r.doc_id % 2 for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 1


def test_ids_beyond_two_bytes_keep_their_width():
    wide = np.array([1, 70_000], "<u4")
    assert packing.unpacked(packing.packed(wide), 2).tolist() == [1, 70_000]
    assert len(packing.packed(np.array([1, 65_535], "<u4"))) == 4
