"""Class-based n-gram model: exchange clustering, and scores from classes and their words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.llm.common import others, text_bytes
from airstrata.session import stored

# Words that the rounds of exchange clustering move, and the classes. Every other word joins
# its best class once, by the same gain. The end of a text is a further class; another stands
# for words without a class, which are those not yet placed and those never seen.
CLUSTERED = 8192
CLASSES = 64
ROUNDS = 4
# Words whose counts and classes every task holds; those of the others come by joins.
HELD_WORDS = 1 << 18
# Bytes of text that a task splits at once; pairs of words that it gathers before it hands them on.
SPLIT_BYTES = 4 << 20
HELD_PAIRS = 1 << 20
# Added to every count, as in the unigram base; weight of the class unigram in transitions.
DELTA = 0.1
# The token at the end of a text; no word is empty.
END = b""
RARE_CLASS, END_CLASS = CLASSES, CLASSES + 1
RARE_WORD, END_WORD = CLUSTERED, CLUSTERED + 1
# Beside a word: the same word; a word that the task doesn't hold.
ITSELF, ELSEWHERE = END_CLASS + 1, -1
CONTEXTS = ITSELF + 1
# How two classes are written as one number, and the counts whose gains are tabulated.
CONTEXT_TYPE = np.dtype("<i2")
SMALL_COUNTS = 16


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(words, sequence, ends)`` of texts (bytes): runs without ASCII blanks, A-Z lower-cased.

    ``words`` are distinct. ``sequence`` gives each token's place in ``words``, text after text;
    an end, given by ``len(words)``, stands before the first text and after each, at ``ends``.
    """
    texts = texts.cast(pa.binary())
    # The same bytes as text; ASCII functions look at single bytes, so any bytes will do.
    plain = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(plain))
    found = lists.flatten().view(pa.binary())
    # Blanks at a margin leave an empty word.
    full = pc.binary_length(found).to_numpy(zero_copy_only=False) > 0
    bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
    bounds = np.concatenate(([0], np.cumsum(full)))[bounds]
    coded = found.filter(pa.array(full)).dictionary_encode()
    words = coded.dictionary
    ends = bounds + np.arange(len(bounds))
    sequence = np.full(bounds[-1] + len(bounds), -1, np.int32)
    sequence[ends] = len(words)
    sequence[sequence < 0] = coded.indices.to_numpy()
    return words, sequence, ends


def pieces(incoming: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of ``text``, none empty."""
    for batch in incoming:
        size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(batch):
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Each word's place in ``known``; ``len(known)`` for others, and one more for the end."""
    found = pc.index_in(words, value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
    return np.append(found.astype(np.int64), len(known) + 1)


def by_number(numbers: dict[bytes, int]) -> pa.Array:
    """Words in the order of their numbers, which begin at 0."""
    return pa.array(sorted(numbers, key=numbers.get), pa.binary())


def distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct rows of columns of numbers from 0, and how often each occurs."""
    sizes = [int(c.max(initial=0)) + 1 for c in columns]
    code = columns[0].astype(np.int64)
    for column, size in zip(columns[1:], sizes[1:]):
        code = code * size + column
    code, n = np.unique(code, return_counts=True)
    found = [n]
    for size in sizes[:0:-1]:
        code, column = np.divmod(code, size)
        found.append(column)
    return (code, *found[:0:-1], n)


def count_tokens(texts: DataFrame) -> DataFrame:
    """``(token, n)`` over all of ``text`` (bytes), the end of each text included."""

    def of_piece(piece: pa.RecordBatch) -> pa.RecordBatch:
        words, sequence, _ = split_texts(piece.column("text"))
        n = np.bincount(sequence[1:], minlength=len(words) + 1)
        tokens = pa.concat_arrays([words, pa.array([END], pa.binary())])
        return pa.RecordBatch.from_arrays([tokens, pa.array(n, pa.int64())], ["token", "n"])

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(of_piece, pieces(incoming, SPLIT_BYTES))

    counted = texts.mapInArrow(count, "token binary, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def count_pairs(texts: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``(left, right, n)``: how often one word follows another, words given by number.

    Words without a number count as ``RARE_WORD``; the end of a text is ``END_WORD`` and also
    stands before its first word.
    """
    known = texts.sparkSession.sparkContext.broadcast(by_number(numbers))

    def of_piece(piece: pa.RecordBatch) -> np.ndarray:
        words, sequence, _ = split_texts(piece.column("text"))
        number = places(words, known.value)
        number[number == len(known.value)] = RARE_WORD
        number[-1] = END_WORD
        row = number[sequence]
        return row[:-1] * (END_WORD + 1) + row[1:]

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: list[np.ndarray] = []
        size, pairs, counts = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.concatenate(codes), return_counts=True)
            both, where = np.unique(np.concatenate((pairs, new)), return_inverse=True)
            return both, np.bincount(where, np.concatenate((counts, n))).astype(np.int64)

        def frame() -> pa.RecordBatch:
            columns = [pairs // (END_WORD + 1), pairs % (END_WORD + 1), counts]
            kinds = [pa.int32(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["left", "right", "n"]
            )

        for piece in pieces(incoming, SPLIT_BYTES):
            codes.append(of_piece(piece))
            size += len(codes[-1])
            if size >= HELD_PAIRS:
                pairs, counts = merged()
                codes, size = [], 0
                if len(pairs) >= HELD_PAIRS:
                    yield frame()
                    pairs, counts = pairs[:0], counts[:0]
        if codes:
            pairs, counts = merged()
        if len(pairs):
            yield frame()

    counted = texts.mapInArrow(count, "left int, right int, n long")
    return counted.groupBy("left", "right").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(
    matrix: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, same: float
) -> tuple[int, float]:
    """The class to which a word's move raises the likelihood of class pairs most, and by how much.

    ``matrix`` counts pairs of classes; ``left`` and ``right`` count the classes before and
    after the word, itself included ``same`` times; ``own`` is its class.
    """
    rest = matrix.copy()
    rest[:, own] -= left
    rest[own, :] -= right
    rest[own, own] += same
    before, after = left.copy(), right.copy()
    before[own] -= same
    after[own] -= same
    base = _xlogx(rest)
    into = _xlogx(rest + before[:, None]) - base  # [c, b]: pairs (c, b) if the word joins b
    out_of = _xlogx(rest + after[None, :]) - base  # [b, c]: pairs (b, c)
    both = _xlogx(np.diag(rest) + before + after + same) - np.diag(base)
    gain = into.sum(axis=0) - np.diag(into) + out_of.sum(axis=1) - np.diag(out_of) + both
    # Tokens of each class but the word's own, those beside the word included.
    rows, columns = rest.sum(axis=1) + before, rest.sum(axis=0) + after
    gain -= _xlogx(rows + right.sum()) - _xlogx(rows)
    gain -= _xlogx(columns + left.sum()) - _xlogx(columns)
    best = int(np.argmax(gain[:CLASSES]))
    return best, float(gain[best] - gain[own])


def class_matrix(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of pairs of classes; their number is fixed."""
    named = _with_class(_with_class(pairs, classes, "left"), classes, "right")
    rows = named.groupBy("left_class", "right_class").agg(F.sum("n").alias("n")).collect()
    matrix = np.zeros((END_CLASS + 1, END_CLASS + 1))
    for row in rows:
        matrix[row["left_class"], row["right_class"]] = row["n"]
    return matrix


def _with_class(pairs: DataFrame, classes: np.ndarray, side: str) -> DataFrame:
    """Pairs with the class of one side. There are at most CLUSTERED + 2 words to look up."""
    table = pairs.sparkSession.createDataFrame(
        [(i, int(c)) for i, c in enumerate(classes)], f"{side} int, {side}_class int"
    )
    return pairs.join(F.broadcast(table), side)


def likelihood(matrix: np.ndarray) -> float:
    """What class pairs add to the log-likelihood of the text."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(axis=0)).sum() - _xlogx(matrix.sum(axis=1)).sum())


def exchange_classes(pairs: DataFrame, words: int, rounds: int = ROUNDS) -> np.ndarray:
    """A class for each of the ``words`` most frequent words, by exchange clustering.

    Words begin in turn of their rank. In a round every second word, in turn the even and the
    odd ones, moves to the class that raises the likelihood most with all other words in place.
    The words' neighbours are counted over all pairs and each word is weighed in a task of its
    own rows; the assignment, of fixed size, is all that reaches the driver. Words of a round
    move at once, so their gains can clash: a round that lowers the likelihood is taken back and
    ends the exchange.
    """
    classes = np.arange(END_WORD + 1) % CLASSES
    classes[RARE_WORD], classes[END_WORD] = RARE_CLASS, END_CLASS
    best = None
    for turn in range(rounds + 1):
        matrix = class_matrix(pairs, classes)
        reached = likelihood(matrix)
        if best is not None and reached < best[0]:
            return best[1]
        best = reached, classes.copy()
        if turn == rounds:
            break
        chosen = [
            _with_class(pairs.filter(f"{side} < {words} and {side} % 2 = {turn % 2}"), classes, other)
            .groupBy(F.col(side).alias("word"), F.col(f"{other}_class").alias("class"))
            .agg(
                F.sum("n").alias("n"),
                F.sum(F.when(F.col("left") == F.col("right"), F.col("n")).otherwise(0)).alias("same"),
            )
            .withColumn("before", F.lit(side == "right"))
            for side, other in (("left", "right"), ("right", "left"))
        ]
        rows = chosen[0].unionByName(chosen[1]).groupBy("word").agg(
            F.collect_list(F.struct("class", "before", "n", "same")).alias("neighbours")
        )
        moved = rows.mapInArrow(
            partial(_moves, matrix=matrix, classes=classes), "word int, class int"
        ).collect()
        for row in moved:
            classes[row["word"]] = row["class"]
    return classes


def _moves(incoming, matrix: np.ndarray, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in incoming:
        found = []
        for word, neighbours in zip(*(batch.column(c).to_pylist() for c in ("word", "neighbours"))):
            left, right, same = np.zeros(len(matrix)), np.zeros(len(matrix)), 0.0
            for entry in neighbours:
                (left if entry["before"] else right)[entry["class"]] += entry["n"]
                same += entry["same"] if entry["before"] else 0
            target, gain = best_class(matrix, int(classes[word]), left, right, same)
            if gain > 1e-6:
                found.append((word, target))
        columns = [pa.array([pair[i] for pair in found], pa.int32()) for i in range(2)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "class"])


def count_contexts(texts: DataFrame, numbers: dict[bytes, int], classes: np.ndarray) -> DataFrame:
    """``(token, contexts)`` for words without a number: the classes before and after them.

    ``contexts`` has a number for each time that the word stands in some piece of the texts,
    ``before * CONTEXTS + after``, as ``CONTEXT_TYPE``. A word without a number has ``RARE_CLASS``,
    unless it is the word itself. Rows of a token lie in one partition, one after the other.
    """
    held = texts.sparkSession.sparkContext.broadcast((by_number(numbers), classes))

    def of_piece(piece: pa.RecordBatch) -> pa.RecordBatch:
        known, class_of = held.value
        words, sequence, _ = split_texts(piece.column("text"))
        number = places(words, known)
        rare = np.append(number[:-1] == len(known), False)
        number[-1] = END_WORD
        number[rare] = RARE_WORD
        of_word = class_of[number]
        at = np.flatnonzero(rare[sequence])
        word = sequence[at]
        before, after = sequence[at - 1], sequence[at + 1]
        before = np.where(before == word, ITSELF, of_word[before])
        after = np.where(after == word, ITSELF, of_word[after])
        contexts = (before * CONTEXTS + after)[np.argsort(word)].astype(CONTEXT_TYPE)
        n = np.bincount(word, minlength=len(words))
        here = np.flatnonzero(n)
        offsets = np.append(0, np.cumsum(n[here])) * CONTEXT_TYPE.itemsize
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(contexts)]
        columns = [words.take(pa.array(here)), pa.Array.from_buffers(pa.binary(), len(here), buffers)]
        return pa.RecordBatch.from_arrays(columns, ["token", "contexts"])

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(of_piece, pieces(incoming, SPLIT_BYTES))

    counted = texts.mapInArrow(count, "token binary, contexts binary")
    return counted.repartition("token").sortWithinPartitions("token")


class JoinGains:
    """What words of ``RARE_CLASS`` gain by joining a class.

    As in ``best_class``, but for many words. Only classes that stand beside a word change its
    pairs, so the work follows the entries that are not zero, and most of these are small counts,
    whose gains are the same for all words.
    """

    def __init__(self, matrix: np.ndarray):
        self.tables = np.stack((matrix, matrix.T))
        self.inner = np.diag(matrix)[:CLASSES]
        self.sums = [sums[:CLASSES] for sums in (matrix.sum(axis=1), matrix.sum(axis=0))]
        self.small = self.change(np.arange(1, SMALL_COUNTS + 1)[:, None, None, None], self.tables[..., :CLASSES])
        # The class itself is counted once, apart.
        inner = np.arange(CLASSES)
        self.small[:, :, inner, inner] = 0

    @staticmethod
    def change(n: np.ndarray, rest: np.ndarray) -> np.ndarray:
        return _xlogx(rest + n) - _xlogx(rest)

    def of(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
        """For each word and class the gain, up to a constant.

        Row i of ``left`` and ``right`` counts the classes beside word i, which follows itself
        ``same[i]`` times besides.
        """
        size = left.shape[1]
        own, other = np.hstack((left, right)), np.stack((right, left))
        word, column = np.nonzero(own)
        side, beside = np.divmod(column, size)
        n = own[word, column]
        gains = self.small[np.minimum(n, SMALL_COUNTS).astype(int) - 1, side, beside]
        many = np.flatnonzero(n > SMALL_COUNTS)
        gains[many] = self.change(n[many, None], self.tables[side[many], beside[many], :CLASSES])
        inner = many[beside[many] < CLASSES]
        gains[inner, beside[inner]] = 0
        # Of the pairs with rare words, those with the word itself leave.
        rare = np.flatnonzero(beside == RARE_CLASS)
        less = other[side[rare], word[rare], :CLASSES]
        i, c = np.nonzero(less)
        rest = self.tables[side[rare[i]], RARE_CLASS, c] - less[i, c]
        gains[rare[i], c] = self.change(n[rare[i]], rest)
        gain = np.zeros((len(left), CLASSES))
        entries = np.bincount(word, minlength=len(left))
        start = np.cumsum(entries) - entries
        for k in range(entries.max(initial=0)):
            more = np.flatnonzero(entries > k)
            gain[more] += gains[start[more] + k]
        added = left[:, :CLASSES] + right[:, :CLASSES] + same[:, None]
        i, c = np.nonzero(added)
        gain[i, c] += self.change(added[i, c], self.inner[c])
        for sums, beside in zip(self.sums, (right, left)):
            counts, which = np.unique(beside.sum(axis=1) + same, return_inverse=True)
            gain -= self.change(counts[:, None], sums)[which]
        return gain


def join_gains(matrix: np.ndarray, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
    """The gains of ``JoinGains`` in a matrix of pairs of classes."""
    return JoinGains(matrix).of(left, right, same)


def place_words(contexts: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``(token, n, class)`` for the words of ``count_contexts``: each joins its best class."""

    def place(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = JoinGains(matrix)

        def frame(tokens: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            best, n = [np.zeros(0, np.int64)], counts[0].sum(axis=1)
            for i in range(0, len(tokens), 512):
                left, right = counts[:, i : i + 512].astype(float)
                best.append(gains.of(left[:, :ITSELF], right[:, :ITSELF], left[:, ITSELF]).argmax(axis=1))
            columns = [tokens, pa.array(n, pa.int64()), pa.array(np.concatenate(best), pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["token", "n", "class"])

        # The last word of a batch may go on in the next; its counts have a fixed size.
        last = None
        for batch in incoming:
            if not len(batch):
                continue
            coded = batch.column("token").dictionary_encode()
            tokens, found = coded.dictionary, batch.column("contexts")
            times = pc.binary_length(found).to_numpy(zero_copy_only=False) // CONTEXT_TYPE.itemsize
            word = np.repeat(coded.indices.to_numpy().astype(np.int64), times)
            code = np.frombuffer(b"".join(found.to_pylist()), CONTEXT_TYPE)
            size = len(tokens) * CONTEXTS
            counts = np.stack(
                [
                    np.bincount(word * CONTEXTS + beside, minlength=size).reshape(-1, CONTEXTS)
                    for beside in np.divmod(code, CONTEXTS)
                ]
            )
            if last is not None:
                if last[0][0] == tokens[0]:
                    counts[:, :1] += last[1]
                else:
                    yield frame(*last)
            yield frame(tokens[:-1], counts[:, :-1])
            last = tokens[-1:], counts[:, -1:]
        if last is not None:
            yield frame(*last)

    return contexts.mapInArrow(place, "token binary, n long, class int")


class Held:
    """Classes and counts of the words that every task holds."""

    def __init__(self, head: list[tuple[bytes, int, int]]):
        self.words = pa.array([word for word, _, _ in head], pa.binary())
        self.counts = np.array([n for _, n, _ in head], np.float64)
        self.classes = np.array([c for _, _, c in head] + [ELSEWHERE, END_CLASS], np.int64)


def outer_parts(sequence: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a sequence has to meet the table of words, given the class of each of its tokens.

    Each word that isn't held comes with the classes on both sides, and each two in a row come as
    a pair: the places of the former, and those of the latter's first words.
    """
    at = np.flatnonzero(classes == ELSEWHERE)
    return at, at[classes[at + 1] == ELSEWHERE]


def full_matrix(texts: DataFrame, held: Held, words: DataFrame) -> np.ndarray:
    """Counts of pairs of classes over all ``texts``, with the classes of all words."""
    shared = texts.sparkSession.sparkContext.broadcast(held)
    size = END_CLASS + 1

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        inner = np.zeros(size * size, np.int64)
        kinds = {"token": pa.binary(), "next": pa.binary(), "before": pa.int32(), "after": pa.int32(), "n": pa.int64()}

        def frame(*columns) -> pa.RecordBatch:
            columns = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds.values())]
            return pa.RecordBatch.from_arrays(columns, list(kinds))

        for piece in pieces(incoming, SPLIT_BYTES):
            words, sequence, _ = split_texts(piece.column("text"))
            classes = held.classes[places(words, held.words)][sequence]
            before, after = classes[:-1], classes[1:]
            both = (before != ELSEWHERE) & (after != ELSEWHERE)
            inner += np.bincount(before[both] * size + after[both], minlength=size * size)
            ones, twos = outer_parts(sequence, classes)
            # Classes from 0, so one more than each.
            word, left, right, n = distinct(sequence[ones], classes[ones - 1] + 1, classes[ones + 1] + 1)
            yield frame(words.take(pa.array(word)), pa.nulls(len(word), pa.binary()), left - 1, right - 1, n)
            word, following, n = distinct(sequence[twos], sequence[twos + 1])
            outside = np.full(len(word), ELSEWHERE)
            yield frame(words.take(pa.array(word)), words.take(pa.array(following)), outside, outside, n)
        at = np.flatnonzero(inner)
        yield frame(*[pa.nulls(len(at), pa.binary())] * 2, at // size, at % size, inner[at])

    parts = texts.mapInArrow(count, "token binary, next binary, before int, after int, n long")
    parts = stored(parts, "class-pairs")
    own = F.col("class")
    named = parts.filter("token is not null").join(words.select("token", "class"), "token")
    twos = named.filter("next is not null").select(own.alias("before"), F.col("next").alias("token"), "n")
    # A word's two pairs come out of one generator, so its class is looked up once.
    sides = F.array(
        F.struct(F.col("before"), own.alias("after"), "n"), F.struct(own.alias("before"), F.col("after"), "n")
    )
    ones = named.filter("next is null").select(F.inline(sides))
    counted = [
        parts.filter("token is null").select("before", "after", "n"),
        ones.filter(f"before != {ELSEWHERE} and after != {ELSEWHERE}"),
        twos.join(words.select("token", "class"), "token").select("before", own.alias("after"), "n"),
    ]
    pairs = reduce(DataFrame.unionByName, counted).groupBy("before", "after").agg(F.sum("n").alias("n"))
    matrix = np.zeros((size, size))
    for row in pairs.collect():
        matrix[row["before"], row["after"]] = row["n"]
    return matrix


class Scorer:
    """Log10 probabilities, but for those of words that a task doesn't hold.

    ``class_types`` counts the words of each class. Each class has room for one unseen word, and
    ``DELTA`` is added to every count in it.
    """

    def __init__(self, held: Held, matrix: np.ndarray, class_types: np.ndarray, tokens: int, types: int):
        self.held = held
        self.base_scale = tokens + DELTA * (types + 1)
        of_class = matrix.sum(axis=0)
        ends = of_class[END_CLASS]
        self.end_known = int(ends > 0)
        self.class_scale = of_class + DELTA * (class_types + 1)
        emitted = np.log10((held.counts + DELTA) / self.class_scale[held.classes[:-2]])
        # The last two entries: a word that isn't held, and the end.
        self.emission = np.concatenate((emitted, [0, 0]))
        self.base = np.concatenate(
            (np.log10((held.counts + DELTA) / self.base_scale), [0, np.log10((ends + DELTA) / self.base_scale)])
        )
        # No seen word is in RARE_CLASS; what follows an unseen word follows the classes' shares.
        share = of_class + 1
        share[RARE_CLASS] = 0
        share /= share.sum()
        weight = len(matrix)
        self.transition = (matrix + weight * share) / (matrix.sum(axis=1, keepdims=True) + weight)
        step = self.transition.copy()
        step[:, RARE_CLASS] = step[:, :CLASSES] @ (DELTA / self.class_scale[:CLASSES])
        self.step = np.log10(step)

    def score(self, row: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """For each text: known tokens, base and model score of the part that is held.

        ``row`` gives the places of the tokens of texts among the words held, with ends as in
        ``split_texts``.
        """
        classes = self.held.classes[row]
        before, after = classes[:-1], classes[1:]
        both = (before != ELSEWHERE) & (after != ELSEWHERE)
        model = self.emission[row[1:]] + np.where(both, self.step[before, after], 0)
        known = after != ELSEWHERE
        known[ends[1:] - 1] = self.end_known
        sums = (known.astype(np.int64), self.base[row[1:]], model)
        return [np.add.reduceat(values, ends[:-1]) for values in sums]

    def weigh(self, single, before, after, own, following, n) -> np.ndarray:
        """Log10 probability of a part; ``own`` and ``following`` are classes, ``n`` is the word's count."""
        first = np.where(before == ELSEWHERE, 0, self.step[before, own])
        second = np.where(after == ELSEWHERE, 0, self.step[own, after])
        emitted = np.where(own == RARE_CLASS, 0, np.log10((n + DELTA) / self.class_scale[own]))
        return np.where(single, first + second + emitted, self.step[own, following])


def _scored(incoming: Iterator[pa.RecordBatch], scorer) -> Iterator[pa.RecordBatch]:
    """A row of sums for each text, and a row for each of its parts that is not held.

    Where there is no word, ``token`` and ``next`` hold what no word equals and no other text
    has, so the later joins spread the rows. Further columns go with the sums and are NULL beside
    the parts.
    """
    scorer = scorer.value
    held = scorer.held
    for piece in pieces(incoming, SPLIT_BYTES):
        kept = {c: piece.column(c) for c in piece.schema.names if c not in ("row", "text")}

        def frame(columns: dict, kept: dict) -> pa.RecordBatch:
            n = len(columns["row"])
            arrays = [
                c if isinstance(c := columns.get(name, 0), pa.Array) else pa.array(np.broadcast_to(c, n), kind)
                for name, kind in PART_COLUMNS.items()
            ]
            return pa.RecordBatch.from_arrays([*arrays, *kept.values()], [*PART_COLUMNS, *kept])

        def part_frame(text, token, following, single, before, after, n) -> pa.RecordBatch:
            columns = {"row": rows[text], "token": words.take(pa.array(token)), "next": following}
            columns |= {"single": single, "before": before, "after": after, "n": n}
            return frame(columns, {name: pa.nulls(len(text), c.type) for name, c in kept.items()})

        words, sequence, ends = split_texts(piece.column("text"))
        rows = piece.column("row").to_numpy()
        row = places(words, held.words)[sequence]
        classes = held.classes[row]
        text = np.repeat(np.arange(len(rows) + 1), np.diff(ends, prepend=-1)) - 1
        alone = pa.array([b" %d" % number for number in rows.tolist()], pa.binary())
        ones, twos = outer_parts(sequence, classes)
        # Classes from 0, so one more than each.
        of, word, before, after, n = distinct(
            text[ones], sequence[ones], classes[ones - 1] + 1, classes[ones + 1] + 1
        )
        yield part_frame(of, word, alone.take(pa.array(of)), True, before - 1, after - 1, n)
        of, word, following, n = distinct(text[twos], sequence[twos], sequence[twos + 1])
        yield part_frame(of, word, words.take(pa.array(following)), False, ELSEWHERE, ELSEWHERE, n)
        known, base, model = scorer.score(row, ends)
        sums = {"row": rows, "token": alone, "next": alone, "single": False}
        sums |= {"tokens": np.diff(ends), "known": known, "base": base, "model": model}
        yield frame(sums, kept)


PART_COLUMNS = {
    "row": pa.int64(), "token": pa.binary(), "next": pa.binary(), "single": pa.bool_(),
    "before": pa.int32(), "after": pa.int32(), "n": pa.int64(), "tokens": pa.int64(),
    "known": pa.int64(), "base": pa.float64(), "model": pa.float64(),
}
PART_SCHEMA = (
    "row long, token binary, next binary, single boolean, before int, after int, n long, "
    "tokens long, known long, base double, model double"
)
SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def score_documents(docs: DataFrame, training: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs``' rows with the log10 probability of their text under a class bigram model.

    Both tables have ``text``; NULL counts as empty. Tokens are those of ``split_texts`` and one end.
    Columns: those of ``docs`` but ``text`` and such that bear a name of the following,
    ``n_tokens``, ``n_known`` (tokens seen in training),
    ``train_tokens``, ``base_score`` (unigrams with 0.1 added to every count) and ``score``: the
    sum over tokens of a class's probability after the class before it, and of the token's
    share of its class. Transitions are smoothed by the classes' own shares; each class has room
    for a word never seen, whose probability is that of those rooms. Perplexity is
    ``10 ** (-score / n_tokens)``. Without training texts no token is known, the base is 0 and
    all classes are alike. Rows may repeat, an empty table gives no rows.

    All training texts count and every word of theirs has a class. What tasks hold (the head of
    the vocabulary, classes and their pairs) has a fixed size; the counts and classes of other
    words reach the texts by joins.
    """
    learned = training.select(text_bytes().alias("text"))
    vocabulary = stored(count_tokens(learned), "vocabulary")
    sizes = vocabulary.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = sizes["tokens"] or 0, sizes["types"]
    ranked = vocabulary.filter(F.length("token") > 0).orderBy(F.desc("n"), "token")
    top = ranked.limit(CLUSTERED).toArrow()
    first = list(zip(top.column("token").to_pylist(), top.column("n").to_pylist()))
    numbers = {word: i for i, (word, _) in enumerate(first)}
    pairs = stored(count_pairs(learned, numbers), "pairs")
    classes = exchange_classes(pairs, len(numbers), rounds)
    contexts = count_contexts(learned, numbers, classes)
    words = stored(place_words(contexts, class_matrix(pairs, classes)), "words")
    more = words.orderBy(F.desc("n"), "token").limit(max(HELD_WORDS - CLUSTERED, 0)).toArrow()
    head = [(word, n, int(classes[i])) for i, (word, n) in enumerate(first)]
    held = Held([*head, *zip(*(more.column(c).to_pylist() for c in ("token", "n", "class")))])
    matrix = full_matrix(learned, held, words)
    class_types = np.bincount(classes[: len(first)], minlength=len(matrix)).astype(float)
    for row in words.groupBy("class").agg(F.count(F.lit(1)).alias("types")).collect():
        class_types[row["class"]] += row["types"]
    scorer = Scorer(held, matrix, class_types, tokens, types)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    stay = others(docs.columns, "text", *SCORES)
    kept = {f"kept{i}": docs.schema[c] for i, c in enumerate(stay)}
    # A row's number only ties together what one job makes of it.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        text_bytes().alias("text"),
        *[F.col(field.name).alias(name) for name, field in kept.items()],
    )
    schema = PART_SCHEMA
    schema += "".join(f", {name} {field.dataType.simpleString()}" for name, field in kept.items())
    parts = rows.mapInArrow(partial(_scored, scorer=shared), schema)

    @F.pandas_udf("double")
    def weigh(single: pd.Series, before: pd.Series, after: pd.Series, own: pd.Series,
              following: pd.Series, n: pd.Series) -> pd.Series:
        arrays = (x.to_numpy() for x in (single, before, after, own, following, n))
        return pd.Series(shared.value.weigh(*arrays))

    table = words.select("token", F.col("n").alias("c"), F.col("class").alias("own"))
    follows = words.select(F.col("token").alias("next"), F.col("class").alias("following"))
    seen = F.coalesce("c", F.lit(0))
    single = F.when(F.col("single"), F.col("n")).otherwise(0)
    unseen = F.lit(RARE_CLASS)
    weight = weigh(
        "single", "before", "after", F.coalesce("own", unseen), F.coalesce("following", unseen), seen
    )
    sums = (
        parts.join(table, "token", "left")
        .join(follows, "next", "left")
        .withColumn("weight", F.col("n") * weight)
        .groupBy("row")
        .agg(
            F.sum("tokens").alias("n_tokens"),
            F.sum(F.col("known") + F.when(seen > 0, single).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + single * F.log10((seen + DELTA) / scorer.base_scale)).alias("base_score"),
            F.sum(F.col("model") + F.col("weight")).alias("score"),
            *[F.first(name, ignorenulls=True).alias(name) for name in kept],
        )
    )
    return sums.select(
        *[F.col(name).alias(field.name) for name, field in kept.items()],
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
