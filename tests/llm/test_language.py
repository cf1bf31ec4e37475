"""Language identification and language-model scoring."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airstrata.llm import class_lm, langid
from airstrata.llm.queries import op2_language_id, op7_class_lm

SMALL = "/root/testdata/sf0.001"


def plain_grams(text: str) -> Counter:
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    counts = Counter()
    for word in letters.split():
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def packed(gram: str) -> int:
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


@pytest.mark.parametrize("text", ["", "  12 ", "a", "Ab a,b", "der Hund. DER hund!", "é日本 x", "ΑΣ İ"])
def test_grams_are_those_of_padded_words(text):
    grams, counts = langid.gram_counts(text.encode())
    assert dict(zip(grams.tolist(), counts.tolist())) == {packed(g): n for g, n in plain_grams(text).items()}


def plain_identify(examples, texts, size):
    totals = {}
    for text, lang in examples:
        if lang is not None:
            totals.setdefault(lang, Counter()).update(
                {packed(g): n for g, n in plain_grams(text or "").items()}
            )

    def top(counter):
        return sorted(counter, key=lambda g: (-counter[g], g))[:size]

    profiles = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in totals.items()}
    out = []
    for text in texts:
        own = top(Counter({packed(g): n for g, n in plain_grams(text or "").items()}))
        if not own:
            out.append(("und", 0.0))
            continue
        apart = {
            lang: sum(min(abs(i - p[g]), size) if g in p else size for i, g in enumerate(own))
            for lang, p in profiles.items()
        }
        best = min(sorted(apart), key=apart.get)
        out.append((best, 1 - apart[best] / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [5, 300])
def test_identification_matches_brute_force(spark, size):
    examples = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), (None, "de"),
                ("der hund und die katze", "de"), ("junk", None), ("the the the", "en")]
    texts = ["the dog", "la vache", "und die maus", None, "", "12 !?", "zzz", "the dog", "x" * 50_000]
    docs = spark.createDataFrame([(t, 7) for t in texts], "text string, score int").withColumnRenamed("score", "gram")
    table = spark.createDataFrame(examples, "text string, lang string")
    found = langid.identify(docs, table, size).collect()
    expected = Counter((t, lang, round(s, 9)) for t, (lang, s) in zip(texts, plain_identify(examples, texts, size)))
    assert Counter((r.text, r.lang_pred, round(r.score, 9)) for r in found) == expected


def test_nothing_learned_and_no_rows(spark):
    docs = spark.createDataFrame([("text",)], "text string")
    none = spark.createDataFrame([], "text string, lang string")
    assert [tuple(r) for r in langid.identify(docs, none).collect()] == [("text", "und", 0.0)]
    assert langid.identify(docs.limit(0), none).collect() == []


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op2_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def objective(matrix):
    def f(x):
        return float(class_lm._xlogx(np.asarray(x, float)).sum())

    return f(matrix) - f(matrix.sum(axis=1)) - f(matrix.sum(axis=0))


def test_a_move_gains_what_the_likelihood_gains():
    rng = np.random.default_rng(0)
    words, size = 30, class_lm.END_CLASS + 1
    pairs = rng.poisson(0.7, size=(words, words))
    classes = rng.integers(0, 5, words)

    def matrix(of):
        out = np.zeros((size, size))
        np.add.at(out, (of[:, None].repeat(words, 1), of[None, :].repeat(words, 0)), pairs)
        return out

    before = matrix(classes)
    for word in range(words):
        left, right = np.zeros(size), np.zeros(size)
        np.add.at(left, classes, pairs[:, word])
        np.add.at(right, classes, pairs[word])
        best, gain = class_lm.best_class(before, int(classes[word]), left, right, pairs[word, word])
        values = []
        for target in range(7):
            moved = classes.copy()
            moved[word] = target
            values.append(objective(matrix(moved)))
        assert math.isclose(max(values) - objective(before), gain, abs_tol=1e-6)
        assert best >= 7 or math.isclose(values[best], max(values), abs_tol=1e-6)


def test_exchange_finds_words_that_stand_alike(spark):
    """Articles come before nouns and nouns before ends; the classes must tell them apart."""
    nouns, articles = [b"n%d" % i for i in range(20)], [b"a%d" % i for i in range(20)]
    rng = np.random.default_rng(1)
    texts = [b" ".join((articles[rng.integers(20)], nouns[rng.integers(20)])) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text binary")
    numbers = {w: i for i, w in enumerate(nouns + articles)}
    pairs = class_lm.count_pairs(frame, numbers).cache()
    assert pairs.agg(F.sum("n")).first()[0] == 9000
    start = np.arange(class_lm.END_WORD + 1) % class_lm.CLASSES
    start[class_lm.RARE_WORD], start[class_lm.END_WORD] = class_lm.RARE_CLASS, class_lm.END_CLASS
    classes = class_lm.exchange_classes(pairs, 40)
    assert not set(classes[:20]) & set(classes[20:40])
    assert objective(class_lm.class_matrix(pairs, classes)) >= objective(class_lm.class_matrix(pairs, start)) - 1e-6


def plain_base(texts, learned):
    tokens = [[*t.encode().lower().split(), b""] for t in texts]
    counts = Counter(w for words, on in zip(tokens, learned) if on for w in words)
    total, types = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t) for t in tokens]
    return tokens, counts, total, base


def check_scores(rows, texts, learned):
    tokens, counts, total, base = plain_base([t or "" for t in texts], learned)
    for row, words, expected in zip(rows, tokens, base):
        assert (row.n_tokens, row.train_tokens) == (len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert math.isclose(row.base_score, expected, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(row.score) and row.score < 0


def plain_scores(texts, learned, classes):
    """Class bigrams over words given by class; None is a word never seen."""
    size, rare, end = class_lm.END_CLASS + 1, class_lm.RARE_CLASS, class_lm.END_CLASS
    tokens = [t.encode().lower().split() for t in texts]
    matrix, counts, types = np.zeros((size, size)), Counter(), Counter(classes.values())
    for words, on in zip(tokens, learned):
        if on:
            counts.update(words)
            row = [end, *[classes[w] for w in words], end]
            for pair in zip(row, row[1:]):
                matrix[pair] += 1
    sums = matrix.sum(axis=0)
    share = np.array([0 if c == rare else sums[c] + 1 for c in range(size)])
    share = share / share.sum()
    go = (matrix + size * share) / (matrix.sum(axis=1, keepdims=True) + size)
    scale = [sums[c] + 0.1 * (types[c] + 1) for c in range(class_lm.CLASSES)]
    out = []
    for words in tokens:
        total, last = 0.0, end
        for w in words:
            c = classes.get(w, rare)
            p = sum(go[last, k] * 0.1 / scale[k] for k in range(class_lm.CLASSES)) if c == rare else (
                go[last, c] * (counts[w] + 0.1) / scale[c])
            total, last = total + math.log10(p), c
        out.append(total + math.log10(go[last, end]))
    for last in range(size):
        words = sum(go[last, classes[w]] * (n + 0.1) / scale[classes[w]] for w, n in counts.items())
        unseen = sum(go[last, k] * 0.1 / scale[k] for k in range(class_lm.CLASSES))
        assert math.isclose(words + unseen + go[last, end], 1, rel_tol=1e-9)
    return out


def few_words(monkeypatch, clustered, held):
    monkeypatch.setattr(class_lm, "CLUSTERED", clustered)
    monkeypatch.setattr(class_lm, "RARE_WORD", clustered)
    monkeypatch.setattr(class_lm, "END_WORD", clustered + 1)
    monkeypatch.setattr(class_lm, "HELD_WORDS", held)


@pytest.mark.parametrize("clustered, held", [(8192, 1 << 18), (20, 40), (20, 20)])
def test_scores_match_brute_force(spark, monkeypatch, clustered, held):
    """Scores are those of one class bigram model, whichever words the tasks hold."""
    few_words(monkeypatch, clustered, held)
    placed = {}
    begin, keep = class_lm.Held.__init__, class_lm.stored

    def watched(self, head):
        placed["head"] = head
        begin(self, head)

    def kept(df, name="table"):
        placed[name] = keep(df, name)
        return placed[name]

    monkeypatch.setattr(class_lm.Held, "__init__", watched)
    monkeypatch.setattr(class_lm, "stored", kept)
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 400) for _ in range(60)]
    texts += ["", "w3", "tail tail tail Tail w1 tail", "new words only", "w1 new w2 newer newest tail"]
    learned = [True] * 63 + [False] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = class_lm.score_documents(docs, docs.filter("doc_id < 63")).collect()
    classes = {bytes(r.token): r["class"] for r in placed["words"].collect()}
    for word, _, c in placed["head"]:
        assert classes.setdefault(word, c) == c
    assert set(classes.values()) <= set(range(class_lm.CLASSES))
    assert len(placed["head"]) == min(held, len(classes))
    rows = sorted(rows, key=lambda r: r.doc_id)
    for row, expected in zip(rows, plain_scores(texts, learned, classes)):
        assert math.isclose(row.score, expected, rel_tol=1e-9, abs_tol=1e-9)
    check_scores(rows, texts, learned)


def test_tail_words_join_the_class_of_most_gain():
    rng = np.random.default_rng(3)
    size, rare = class_lm.END_CLASS + 1, class_lm.RARE_CLASS
    matrix = rng.poisson(300, size=(size, size)).astype(float)
    left, right = rng.poisson(0.05, size=(2, 200, size)).astype(float)
    same = rng.poisson(0.3, size=200).astype(float)
    gains = class_lm.join_gains(matrix, left, right, same)
    for i in range(200):
        before, after = left[i].copy(), right[i].copy()
        before[rare] += same[i]
        after[rare] += same[i]
        best, _ = class_lm.best_class(matrix, rare, before, after, same[i])
        assert math.isclose(gains[i].max(), gains[i][best], abs_tol=1e-6)


@pytest.mark.parametrize("held, clustered", [(1 << 18, 8192), (40, 20)])
def test_scores_of_the_query(spark, monkeypatch, held, clustered):
    few_words(monkeypatch, clustered, held)
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    rows = sorted(op7_class_lm(spark, SMALL).collect(), key=lambda r: r.doc_id)
    learned = [zlib.crc32(str(r.doc_id).encode()) % 10 != 0 for r in docs]
    assert [r.held_out for r in rows] == [not on for on in learned]
    check_scores(rows, [r.text for r in docs], learned)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_rows_of_any_shape(spark):
    rows = [(1, None, "k"), (None, "a b", None), (1, None, "k"), (2, " \n", "k"), (3, "a " * 20_000, "k")]
    docs = spark.createDataFrame(rows, "token long, text string, row string")
    training = spark.createDataFrame([("a b c",), (None,)], "text string")
    found = class_lm.score_documents(docs, training).collect()
    assert sorted(((r.token, r.row) for r in found), key=str) == sorted(((i, k) for i, _, k in rows), key=str)
    assert sorted(r.n_tokens for r in found) == [1, 1, 1, 3, 20_001]
    none = class_lm.score_documents(docs, training.limit(0)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in none} == {(0, 0, 0.0)}
    assert class_lm.score_documents(docs.limit(0), training).collect() == []


def test_texts_are_split_as_bytes_are():
    rng = np.random.default_rng(7)
    parts = [b"A", b"b", b" ", b"\t", b"\n", b"\x0b", b"\f", b"\r", b"\x1c", b"\x85", b"\xff", "Äİ".encode(), b"word"]
    texts = [b"".join(parts[i] for i in rng.integers(len(parts), size=rng.integers(30))) for _ in range(300)]
    texts += [b"", b" ", b"  x  "]
    for found in (pa.array(texts, pa.binary()), pa.array([b"left out", *texts], pa.binary()).slice(1)):
        words, sequence, ends = class_lm.split_texts(found)
        names = [*words.to_pylist(), None]
        assert len(set(names)) == len(names)
        expected = [w for t in texts for w in (None, *t.lower().split())] + [None]
        assert [names[i] for i in sequence] == expected
        assert ends.tolist() == [i for i, w in enumerate(expected) if w is None]
        batch = pa.RecordBatch.from_arrays([found], ["text"])
        cut = list(class_lm.pieces(iter([batch]), 40))
        assert [t for piece in cut for t in piece.column("text").to_pylist()] == texts
        assert all(len(p) == 1 or sum(map(len, p.column("text").to_pylist())) <= 40 for p in cut)


def test_a_word_is_shuffled_once_for_each_piece_of_the_texts(spark, monkeypatch):
    """Not once for each of its contexts; a word whose rows lie in several batches is one word."""
    few_words(monkeypatch, 20, 40)
    numbers, classes = {b"w%d" % i: i for i in range(20)}, np.arange(22) % class_lm.CLASSES
    classes[20:] = class_lm.RARE_CLASS, class_lm.END_CLASS
    texts = [b" ".join([b"w%d rare" % i for i in range(20)] + [b"rare x"])] * 30
    frame = spark.createDataFrame([(t,) for t in texts], "text binary").coalesce(1)
    assert Counter(bytes(r.token) for r in class_lm.count_contexts(frame, numbers, classes).collect()) == {b"rare": 1, b"x": 1}

    monkeypatch.setattr(class_lm, "SPLIT_BYTES", 1)
    contexts = class_lm.count_contexts(frame, numbers, classes)
    size = class_lm.END_CLASS + 1
    matrix = np.random.default_rng(2).poisson(3000, size=(size, size)).astype(float)
    left, right, rare = np.zeros((1, size)), np.zeros((1, size)), class_lm.RARE_CLASS
    np.add.at(left[0], [*range(20)], 30)
    np.add.at(right[0], [*range(1, 20), rare], 30)
    expected = int(class_lm.join_gains(matrix, left, right, np.full(1, 30.0)).argmax())
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, 7)
    try:
        found = {bytes(r.token): (r.n, r["class"]) for r in class_lm.place_words(contexts, matrix).collect()}
    finally:
        spark.conf.unset(key)
    assert found[b"rare"] == (30 * 21, expected) and found[b"x"][0] == 30
