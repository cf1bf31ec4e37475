from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from airstrata.llm import sharding


def plain(rows, limit):
    """Shard of each row: the shortest prefix whose rows fit."""
    sized = []
    for doc, text in rows:
        digest = hashlib.md5(f"{'' if doc is None else doc} {text or ''}".encode()).hexdigest()
        sized.append((doc, len((text or "").encode()), format(int(digest[:15], 16), "060b")))
    totals = defaultdict(int)
    for _, size, bits in sized:
        for depth in range(61):
            totals[bits[:depth]] += size
    out = []
    for doc, size, bits in sized:
        depth = next(d for d in range(61) if totals[bits[:d]] <= limit or d == 60)
        out.append((doc, size, bits[:depth], depth, totals[bits[:depth]]))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [1, 40, 300, 10**6])
@pytest.mark.parametrize("step", [3, 15])
def test_shards_match_brute_force(spark, monkeypatch, limit, step):
    monkeypatch.setattr(sharding, "STEP_BITS", step)
    rows = [(i, "x" * (i % 23)) for i in range(120)]
    rows += [(5, None), (None, "é"), (None, ""), (7, "same " * 20), (7, "same " * 20), (9, "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as hash")
    found = sharding.assign_shards(docs, limit)
    got = [(r.doc_id, r.n_bytes, r.shard, r.depth, r.shard_bytes) for r in found.collect()]
    assert sorted(got, key=str) == plain(rows, limit)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(docs).collect() == []


def test_written_shards_hold_their_rows(spark, tmp_path):
    rows = [(i, "word " * (i % 9)) for i in range(100)] + [(3, "word " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, 200)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted(rows)
    sizes = back.groupBy("shard").agg({"text": "count"}).count()
    assert sizes == sharding.assign_shards(docs, 200).select("shard").distinct().count()
