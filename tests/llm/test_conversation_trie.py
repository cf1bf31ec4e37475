from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from airstrata.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def sequences(rows, rebuilt):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {conv: [t[2] for t in sorted(turns, key=lambda t: t[:2])] for conv, turns in held.items()}
    if not rebuilt:
        return own
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(rows, rebuilt=False):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sequences(rows, rebuilt).items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    out = []
    totals = defaultdict(lambda: [0, 0])
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            totals[node[:depth]][0] += not children[node]
            totals[node[:depth]][1] += (len(convs) - 1) * words
    for node, convs in members.items():
        joined = ",".join(map(str, sorted(ends[node])))
        out.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                children[node], *totals[node], hashlib.sha256(joined.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


ODD = [
    (0, 2, "user", "c d"), (0, 0, "user", "a"), (0, 1, "bot", " b\tb\n"), (1, 0, "user", "a"),
    (1, 1, "bot", " b\tb\n"), (1, 5, None, None), (2, None, "user", "a"), (2, 7, "", ""), (3, 0, "us", "era"),
    (4, 0, "user", "a"), (5, 0, "bot", "a"), (6, 0, "user", "a b"), (25, 0, "user", "own"),
    (26, 3, "user", "first"), (26, 4, "user", "second"), (26, 9, "bot", "third"), (26, 10, "bot", "fourth"),
    (-7, 0, "user", "a"), (-7, 1, "user", "b"), (-21, 0, "user", "z"), (None, 0, "user", "a"),
    (40, 0, "user", "only"), (41, 0, "user", "x"), (41, 1, "user", "y"), (42, 0, "user", "word " * 100_000),
]


@pytest.mark.parametrize("rebuilt", [False, True])
def test_odd_rows_match_brute_force(spark, rebuilt):
    turns = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as depth", "2 as name", "3 as position", "4 as n_words")
    assert collected(trie.conversation_trie(turns, rebuilt)) == plain(ODD, rebuilt)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tries_match_brute_force(spark, seed):
    """Few distinct turns and lengths around powers of two, so that prefixes meet everywhere."""
    draw = random.Random(seed)
    rows = []
    for conv in range(120):
        length = draw.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17])
        same = draw.randrange(length + 1)
        for turn in range(length):
            text = "same" if turn < same else draw.choice(["a", "b b"])
            rows.append((conv, turn, "user" if turn % 2 else "bot", text))
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collected(trie.conversation_trie(turns)) == plain(rows)
    assert collected(trie.conversation_trie(turns, rebuilt=True)) == plain(rows, rebuilt=True)


def test_shared_turns_of_many_conversations(spark, monkeypatch):
    """Ids of one node come in many chunks, and a first turn is shared by all."""
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = [(conv, turn, "user", "same") for conv in range(300) for turn in range(2 + conv % 2)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert collected(trie.conversation_trie(turns)) == plain(rows)


def test_ties_are_ordered_by_name(spark):
    rows = [(1, 0, "user", t) for t in "abc"]
    turns = spark.createDataFrame(rows + [(2, *r[1:]) for r in reversed(rows)], SCHEMA)
    found = trie.conversation_trie(turns)
    assert sorted((r.conv_id, r.depth, r.n_convs) for r in found.collect()) == [(1, d, 2) for d in range(4)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.conversation_trie(empty).count() == trie.conversation_trie(empty, True).count() == 0
    nameless = spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)
    assert trie.conversation_trie(nameless).count() == 0
