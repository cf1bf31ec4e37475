from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from airstrata.llm import signature_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, k=10):
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    counts = [(doc, c) for doc, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in items:
        scores = []
        asked = set(terms(text))
        weight = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in counts) + 1)))
            for t in asked
        }
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // total
            score = sum(
                weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        scores.sort(key=lambda s: s[:3])
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(spark, items, docs, k=10):
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as rank")
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "3 as items", "4 as bound")
    df = search.search(items, docs.repartition(3), k)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, n=300):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["Äpfel", "日本", "É"]
    docs = []
    for doc in range(n):
        size = draw.choice([1, 3, 10, 40, 200])
        docs.append((doc, " ".join(words[int(draw.paretovariate(0.6)) % len(words)] for _ in range(size))))
    items = [(i, ", ".join(draw.choice(words) for _ in range(draw.choice([1, 4, 12])))) for i in range(20)]
    return items, docs


ODD_DOCS = [
    (1, None), (2, ""), (3, " \t.-"), (4, "a"), (5, "A a"), (6, "ä Ä"), (7, "a_b"), (8, "x\x00y"), (9, "a1 1a"),
    (10, "long " * 300_000 + "tail"), (11, "same words"), (12, "same words"), (12, "same words"), (None, "same words"),
    (-5, "same words"), (13, "x y"), (14, "WORDS same, same"),
]
ODD_ITEMS = [
    (1, "a"), (2, None), (3, "..."), (4, "SAME words words"), (5, "nowhere"), (6, "tail of the long"), (7, "Ä b"),
    (8, "y"), (9, "x y"), (1, "1a"), (4, "SAME words words"), (None, "same"),
]


def test_odd_rows_match_brute_force(spark):
    assert found(spark, ODD_ITEMS, ODD_DOCS) == plain(ODD_ITEMS, ODD_DOCS)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_random_corpus_matches_brute_force(spark, k, monkeypatch):
    """Small blocks and slices, and signatures so full that most bits are set."""
    monkeypatch.setattr(search, "BITS_PER_ENTRY", 1)
    monkeypatch.setattr(search, "SLICE_BYTES", 5000)
    monkeypatch.setattr(search, "CELLS", 4000)
    monkeypatch.setattr(search, "QUERY_ROWS", 7)
    items, docs = corpus(k)
    assert found(spark, items, docs, k) == plain(items, docs, k)


def test_bounds_are_never_below_the_score(spark):
    """And most documents are excluded without a look at their texts."""
    items, docs = corpus(5)
    texts = pa.array([t for _, t in docs])
    queries = next(search.read_queries(spark.createDataFrame(items, "item_id long, text string")))
    counts = [Counter(terms(t)) for _, t in docs]
    queries.n_docs, queries.n_terms = len(docs), sum(c.total() for c in counts)
    queries.weights = np.array(
        [int(1000 * math.log((2 * len(docs) + 2) / (2 * sum(t in c for c in counts) + 1))) for t in queries.terms]
    )
    seen, above = 0, 0
    for start, lowered in search.slices(texts):
        part = search.count_terms(lowered)
        for bits, members, top, data in search._blocks(part):
            for first, bounds in search.upper_bounds(queries, bits, part.n_terms[members], top, data):
                for item in range(len(queries.ids)):
                    own = queries.term[queries.start[item] : queries.start[item + 1]]
                    for at, bound in enumerate(bounds[item]):
                        c = counts[start + members[first + at]]
                        length = int(queries.lengths(np.array([c.total()]))[0])
                        score = sum(
                            int(queries.weights[t]) * (10**9 * c[queries.terms[t]] // (1000 * c[queries.terms[t]] + length))
                            for t in own
                        )
                        assert bound >= score
                        seen += 1
                        above += bound > 1.2 * score
    assert seen == len(queries.ids) * len(docs) and above < 0.1 * seen


def test_empty_tables(spark):
    items, docs = corpus(1, 5)
    assert found(spark, [], docs) == found(spark, items, []) == found(spark, items, [(1, "...")]) == []
