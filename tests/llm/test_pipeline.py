"""The pipeline's stages against a brute-force version of all of them."""

from __future__ import annotations

import zlib

from test_language import plain_identify
from test_line_dedup import plain as plain_lines
from test_packing import check_layout
from test_simhash import components, plain_fingerprint

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_force(rows):
    """What is left for packing: id and text."""
    learned = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    found = plain_identify([(r[1], r[2]) for r in learned], [r[1] for r in rows], 300)
    kept = [r for r, (lang, score) in zip(rows, found) if lang != "und" and score >= 0.25]
    kept = plain_lines([(r[0], r[1]) for r in kept])
    fps = [plain_fingerprint(text.encode()) for _, text, _, _ in kept]
    groups = components(fps, [doc for doc, *_ in kept], 4)
    return {(doc, text) for (doc, text, _, _), group in zip(kept, groups) if doc == group}


def test_pipeline_matches_brute_force(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()]
    check_layout(corpus_pipeline.run(spark, small).collect(), dict(brute_force(rows)), 2048)


def test_stages_bear_rows_of_any_shape(spark):
    shared = "a line that is long enough stands here"
    rows = [
        (1, f"the cat sat\n{shared}", "en", "s", 5), (2, f"the dog ran\n{shared}", "en", "s", 5),
        (3, f"the cow ate\n{shared}", "en", None, None), (3, f"the cow ate\n{shared}", "en", None, None),
        (4, None, "en", "s", 0), (5, "123 456", "en", "s", 7), (None, "the sun is not named", None, "s", 2),
        (6, "the cat sat", "en", "s", 11), (7, "", None, None, 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = brute_force(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = docs.collect()
    assert (None, "the sun is not named") in left
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(left, key=str)
    assert {r.n_chars for r in got if r.doc_id in (1, 2)} == {11}
    packed = corpus_pipeline.pack(spark, docs, "").collect()
    assert sum(r.length for r in packed if r.start == 0) > 0


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []
