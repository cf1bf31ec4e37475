"""Columns of documents that bear a name an operator uses itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from airstrata.llm import class_lm, langid, line_dedup, sharding, simhash, url_filter

NAMES = (
    "score", "Lang_Pred", "_language", "language", "n_lines", "N_dropped", "_kept", "kept", "_dropped", "dropped",
    "_dropped_id", "dropped_id", "_id", "_fp", "fp", "root", "_row", "_hash", "row", "shard", "hash", "n_tokens",
    "token", "batch", "line_hash",
)
SHARED = "a line that is long enough stands here"
ROWS = [
    (1, f"the cat sat on it\n{SHARED}", "en"), (2, f"the dog ran to it\n{SHARED}", "en"),
    (3, f"the cow ate of it\n{SHARED}", "en"), (3, f"the cow ate of it\n{SHARED}", "en"), (None, "the sun", "en"),
    (None, None, None), (4, "", "en"),
]


@pytest.fixture
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    own = [F.concat(F.lit(f"{name} of "), F.coalesce("text", F.lit("none"))).alias(name) for name in NAMES]
    return plain.select("*", *own)


def untouched(df, originals, but=()):
    """Every row's own columns still say their name and a text that was given."""
    names = [n for n in NAMES if n.lower() not in {b.lower() for b in but}]
    texts = {r.text if r.text is not None else "none" for r in originals.collect()}
    rows = df.collect()
    for row in rows:
        values = {row[name].removeprefix(f"{name} of ") for name in names}
        assert len(values) == 1 and values <= texts
    return rows


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_leave_other_columns_alone(spark, docs, stage):
    left = stage[1](spark, docs, "")
    assert left.columns == docs.columns
    assert len(untouched(left, docs)) > 2


def test_new_columns_replace_those_of_their_name(spark, docs):
    found = langid.identify(docs, docs)
    assert found.columns[-2:] == ["lang_pred", "score"] and len(found.columns) == len(docs.columns)
    assert {r.lang_pred for r in untouched(found, docs, ("lang_pred", "score"))} == {"en", "und"}
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns[-2:] == ["n_lines", "n_dropped"] and len(kept.columns) == len(docs.columns)
    assert sum(r.n_dropped for r in untouched(kept, docs, ("n_lines", "n_dropped"))) == 2
    scored = class_lm.score_documents(docs, docs)
    assert scored.columns[-5:] == list(class_lm.SCORES)
    assert {r.train_tokens for r in untouched(scored, docs, class_lm.SCORES)} == {
        sum(len((t or "").split()) + 1 for _, t, _ in ROWS)
    }


def test_one_row_of_each_group_keeps_its_columns(spark, docs):
    rows = untouched(simhash.keep_one(docs), docs)
    assert sorted((r.doc_id for r in rows), key=str) == [1, 2, 3, 4, None]


def test_shards_hold_all_columns(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "shards"), 100)
    found = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(found.columns) == sorted([*docs.columns, "shard_"])
    rows = untouched(found, docs)
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(((i, t) for i, t, _ in ROWS), key=str)
    sharding.write_shards(docs.limit(0), str(tmp_path / "none"), 100)
    assert spark.read.schema(docs.schema).parquet(str(tmp_path / "none")).count() == 0


def test_rules_without_a_verdict_are_left_out(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string").selectExpr("*", "'p' as verdict")
    rules = spark.createDataFrame(
        [(None, "org", "/"), ("block", "org", None), ("block", None, "/"), ("block", "a.org", "/y")],
        "verdict string, host string, path string",
    )
    assert [tuple(r) for r in url_filter.judge_urls(pages, rules).collect()] == [(1, "a.org", "/x", None, "allow")]
