from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airstrata.llm import exact_dedup


def plain(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text in rows:
        members = groups[text or ""]
        ids = [i for i in members if i is not None]
        keep = max(ids) if ids else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc, keep, len(members), doc == keep, sha))
    return sorted(out, key=str)


LONG = "word " * 200_000
ROWS = [
    (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "a "), (7, LONG), (8, LONG), (9, LONG + "."),
    (10, "é"), (11, "é"), (12, "é"), (12, "é"), (None, "a"), (None, "only nameless"),
    (None, "only nameless"), (13, "one"), (14, "two"), (15, "six"), (16, "two"), (17, "one"),
    (-3, "one"), (18, "\x00"), (19, "\x00\x00"), (20, "\x00"),
] + [(100 + i, "hot copy") for i in range(300)] + [(1000 + i, f"text {i % 90}") for i in range(100)]

HASHES = {
    "xxhash64": exact_dedup.text_hash,
    "by length": lambda text: F.octet_length(text).cast("long"),
    "all alike": lambda text: F.lit(-1).cast("long"),
}


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("hashed", HASHES.values(), ids=HASHES)
@pytest.mark.parametrize("bucket_bytes", [200, 1 << 24])
def test_groups_match_brute_force(spark, hashed, bucket_bytes):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("*", "1 as hash", "2 as keep_id", "3 as n_links", "4 as bucket", "5 as met")
    found = exact_dedup.exact_duplicates(docs, bucket_bytes, hashed)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collected(found) == plain(ROWS)


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_string_ids(spark):
    rows = [("a", "x"), ("b", "x"), ("c", "y")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert collected(exact_dedup.exact_duplicates(docs)) == plain(rows)


def test_directory_partitions_the_hashes(spark, monkeypatch):
    """Also where two readings are needed: all hashes share their first 20 bits but a few."""
    monkeypatch.setattr(exact_dedup, "STEP_BITS", 5)
    hashes = [i << 20 for i in range(64)] + [-1, -2, 1 << 62]
    keys = spark.createDataFrame([(h, 10) for h in hashes], "hash long, n_bytes long")
    buckets = [(r.depth, r.prefix) for r in exact_dedup.directory_of(keys, 40).collect()]
    bits = {h: format(h % (1 << 64), "064b") for h in hashes}
    names = [format(prefix, f"0{depth}b") if depth else "" for depth, prefix in buckets]
    members = {n: [h for h in hashes if bits[h].startswith(n)] for n in names}
    assert sorted(h for m in members.values() for h in m) == sorted(hashes)
    assert all(0 < len(m) <= 4 for m in members.values())
    # No split without need: the parent of every bucket is overfull.
    parents = [sum(bits[h].startswith(n[:-1]) for h in hashes) for n in names if n]
    assert min(parents) > 4


def test_one_row_of_each_text_stays(spark):
    docs = spark.createDataFrame([(i, t, i % 7) for i, t in ROWS if i], "doc_id long, text string, kept int")
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    expected = {(doc, sha) for doc, _, _, kept, sha in plain([(i, t) for i, t in ROWS if i]) if kept}
    got = {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in left.collect()}
    assert got == expected


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(ROWS[:30], "doc_id long, text string")
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))
