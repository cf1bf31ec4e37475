from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from airstrata.llm import simhash


def plain_fingerprint(text: bytes, width: int = 4) -> int:
    words = [w for w in text.lower().replace(b"\r", b" ").split() if w]
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    shingles = [b" ".join(words[i : i + width]) for i in range(count)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def components(fps: list[int], ids: list, radius: int) -> list:
    labels = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= radius and labels[i] != labels[j]:
                    labels[i] = labels[j] = min(labels[i], labels[j])
                    changed = True
    known = {}
    for label, doc in zip(labels, ids):
        if doc is not None:
            known[label] = min(doc, known.get(label, doc))
    return [known.get(label) for label in labels]


@pytest.mark.parametrize(
    "text",
    ["", " \t\n", "one", "One two", "a b c d", "a b c d e f g a b c d", "é b c d e", "x " * 40_000],
)
def test_fingerprint_is_that_of_plain_counting(text):
    if len(text) > 1000:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(b"x x x x")
    else:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text.encode())


def test_hash_is_sparks_own(spark):
    row = spark.sql("select xxhash64('a b c d') as h").first()
    assert row.h & (2**64 - 1) == simhash.fingerprint(b"a b c d")


def test_tree_finds_what_a_scan_finds():
    draw = random.Random(3)
    centre = draw.getrandbits(64)
    values = [centre ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(12))) for _ in range(300)]
    values = sorted({v & (2**64 - 1) for v in values})
    tree = simhash.BKTree(values)
    gone = set(range(0, len(values), 3))
    for i in gone:
        tree.remove(i)
    for query in values[::7]:
        expected = {i for i, v in enumerate(values) if i not in gone and (v ^ query).bit_count() <= 4}
        assert set(tree.within(query, 4)) == expected


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_links_within_the_radius_share_a_key(spark, radius):
    draw = random.Random(radius)
    pairs = []
    for _ in range(200):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), radius):
            b ^= 1 << bit
        pairs.append((a - 2**63, b - 2**63))
    frame = spark.createDataFrame(pairs, "a long, b long")
    shared = frame.select(
        F.arrays_overlap(
            F.expr(simhash.shard_keys("a", radius)), F.expr(simhash.shard_keys("b", radius))
        ).alias("met")
    )
    assert shared.filter("not met").count() == 0


@pytest.mark.parametrize("shard_rows", [4, 1000])
def test_components_match_brute_force(spark, shard_rows):
    draw = random.Random(5)
    base = [f"w{draw.randrange(500)}" for _ in range(400)]
    rows = []
    for i in range(60):
        words = list(base) if i % 2 else [f"v{draw.randrange(900)}" for _ in range(50)]
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(500)}"
        rows.append((i + 10, " ".join(words)))
    rows += [(5, None), (7, ""), (8, " \n"), (9, "One two"), (9, "one  TWO"), (None, "one two"), (None, "lone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = simhash.near_duplicates(docs, shard_rows=shard_rows).collect()
    texts = [(t or "").encode() for _, t in rows]
    fps = [plain_fingerprint(t) for t in texts]
    expected = components(fps, [i for i, _ in rows], 4)
    got = sorted((r.doc_id or -1, r.fp & (2**64 - 1), r.component_id or -1) for r in found)
    assert got == sorted((i or -1, fp, c or -1) for (i, _), fp, c in zip(rows, fps, expected))


def test_one_row_of_each_group_stays(spark):
    rows = [
        (3, "a b c d e", "x"), (2, "a b c d e", "y"), (4, "other words are here now", "x"),
        (2, "third text of the same id stands", "z"), (2, "a b c d e", "y"),
        (None, "third text of the same id stands", "z"), (None, "nobody knows my number", "q"),
        (None, "nobody knows my number", "q"), (None, "nor is mine known to anyone", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    kept = [(r.doc_id, r.text, r.root) for r in simhash.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted({rows[1], rows[2], rows[3], rows[6], rows[8]}, key=str)
    assert simhash.keep_one(docs.limit(0)).collect() == []
