"""Top-k search and near-duplicates of vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from airstrata.llm import cap_filter, topk_search

SCHEMA = "vec_id long, embedding array<double>"
ODD = [
    (900, None), (901, []), (902, [float("nan")] * 8), (903, [1.0, None] * 4), (904, [float("inf")] * 8),
    (905, [0.0] * 8), (906, [1e300] * 8), (907, [0.5] * 3), (None, [0.25] * 8),
]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_top(queries, rows, k):
    def ints(v):
        return [math.floor(64 * x) for x in v]

    out = []
    for q, v in queries:
        if q is None or not usable(v):
            continue
        scored = [
            (-sum(a * b for a, b in zip(ints(v), ints(w))), i)
            for i, w in rows
            if i is not None and i != q and usable(w)
        ]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k, block, block_rows", [(3, 4, 7), (20, 100, 64), (1, 3, 1024), (500, 50, 16)])
def test_top_k_matches_brute_force(spark, monkeypatch, k, block, block_rows):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(k)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(40)] + [r for r in ODD if r[0] != 906]  # many ties
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score")
    queries = vectors.filter("vec_id % 20 = 0 or vec_id >= 900 or vec_id is null")
    found = topk_search.top_k(queries, vectors.repartition(3), k, block_queries=block)
    asked = [(i, v) for i, v in rows if i is None or i % 20 == 0 or i >= 900]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == plain_top(asked, rows, k)


def top_of(spark, rows, k=20):
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = topk_search.top_k(vectors, vectors, k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def test_large_components_score_exactly(spark):
    """Beyond 2**28, beyond 2**53, and where terms beyond a long cancel out."""
    rows = [(0, [5e6, 1.0]), (1, [1.0, 1.0])]
    assert top_of(spark, rows) == [(0, 1, 1, 20480004096), (1, 1, 0, 20480004096)] == plain_top(rows, rows, 20)
    big = [
        (0, [1e7, 3e6 + 1 / 64, -2.0, 7.0]), (1, [2e6, -3.0, 1 / 64, 9.0]), (2, [1e12 + 1 / 64, 0.0, 1.0, 1.0]),
        (3, [1e13, 1e13, -1e12, -1e12]), (4, [1.0, -1.0, 5.0, -5.0]), (5, [0.0] * 4),
    ]
    with pytest.raises(Exception, match="does not fit a long"):
        top_of(spark, big)
    big[3] = (3, [2e17, -2e17, 1.0, 1.0])
    big[2] = (2, [1.0, 1.0, 1.0, -1.0])
    big[:2] = [(0, [3.0, 3.0, 4.0, 4.0]), (1, [5e8, 5e8, 2.0, 1 / 64])]
    big[4] = (4, [7.0, 7.0, -5e8, 5.0])
    for k in (1, 2, 20):
        assert top_of(spark, big, k) == plain_top(big, big, k)


def test_rows_below_the_threshold_are_not_fully_scored():
    """Of clustered vectors, the missing half of most pairs is never looked at."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(50, 32))
    rows = np.floor(64 * (centres[np.arange(2000) % 50] + 0.05 * rng.normal(size=(2000, 32))))
    ids = np.arange(2000)
    block = topk_search.QueryBlock(ids[:100], rows[:100], 20)
    exact = rows[:100] @ rows.T
    exact[np.arange(100), np.arange(100)] = -np.inf
    cutoff = np.partition(block.gathered(ids, rows), 0, axis=1)[:, 0]
    at, found, score = block.survivors(ids, rows, cutoff)
    assert block.resolved < 0.1 * exact.size
    expected = {(q, i) for q, i in zip(*np.nonzero(exact >= cutoff[:, None]))}
    assert set(zip(at, found)) == expected and (score == exact[at, found]).all()


def test_top_k_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(20, [1.0]), (20, [1.0])], SCHEMA)
    assert topk_search.top_k(none, some).collect() == []
    assert topk_search.top_k(some, none).collect() == []
    assert topk_search.top_k(some, some).collect() == []


def plain_links(rows, cosine):
    def linked(v, w):
        if not usable(v) or not usable(w) or not any(v) or not any(w) or len(v) != len(w):
            return False
        a, b = (np.array(x) / np.abs(x).max() for x in (v, w))
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine - 1e-12

    links = [[i != j and linked(v, w) for j, (_, w) in enumerate(rows)] for i, (_, v) in enumerate(rows)]
    labels = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, line in enumerate(links):
            for j, on in enumerate(line):
                if on and labels[j] < labels[i]:
                    labels[i], changed = labels[j], True
    smallest = {}
    for label, (i, _) in zip(labels, rows):
        if i is not None:
            smallest[label] = min(i, smallest.get(label, i))
    return sorted(
        ((i, sum(line), smallest.get(label)) for (i, _), line, label in zip(rows, links, labels)), key=str
    )


@pytest.mark.parametrize("shard_rows", [5, 1024])
def test_links_match_brute_force(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(i, list(map(float, rng.normal(size=16)))) for i in range(150)]
    for i in range(60):  # chains of near-copies, scaled ones, exact ones
        base = np.array(rows[i % 4][1])
        rows.append((200 + i, list(map(float, (base + rng.normal(size=16) * 0.15) * (1 + i % 3)))))
    rows += [(300 + i, rows[0][1]) for i in range(6)] + [(310, [2 * x for x in rows[0][1]]), (149, rows[149][1])]
    rows += ODD + [(950, [1e-300] * 8), (951, [-0.0, 0.0])]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as node")
    found = cap_filter.near_duplicate_vectors(vectors, shard_rows=shard_rows, filter_rows=20)
    got = found.collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == plain_links(rows, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert cap_filter.near_duplicate_vectors(vectors.limit(0)).collect() == []


def test_recall_at_the_threshold_itself(spark):
    """Pairs of cosine 0.95 and a bit, the hardest there are."""
    rng = np.random.default_rng(4)
    first = rng.normal(size=(1500, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = rng.normal(size=first.shape)
    other -= (other * first).sum(axis=1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    second = 0.951 * first + math.sqrt(1 - 0.951**2) * other
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((first, second)))]
    found = cap_filter.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))
    assert found.filter("n_links > 0").count() / len(rows) >= 0.98


def test_cap_height_is_that_of_random_vectors():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(200_000, 12))
    share = (vectors[:, 0] / np.linalg.norm(vectors, axis=1) >= cap_filter.cap_height(12, 0.01)).mean()
    assert abs(share - 0.01) < 0.001
