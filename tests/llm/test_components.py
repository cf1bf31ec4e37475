from __future__ import annotations

import random

from airstrata.llm.components import connected_components


def plain(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def test_components_match_union_find(spark):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)]  # a chain
    pairs += [(7, draw.randrange(1000, 1100)) for _ in range(60)]  # a hub
    pairs += [(draw.randrange(-400, 0), draw.randrange(-400, 0)) for _ in range(150)]
    pairs += [(5, 5), (2**62, -(2**62)), (3, 4), (4, 3), (3, 4)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.root for r in connected_components(frame, "a", "b").collect()}
    assert found == plain(pairs)
    assert connected_components(frame.limit(0), "a", "b").collect() == []
