"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airstrata.llm.common import others, text_bytes, unused

PROFILE_SIZE = 300
UNDETERMINED = "und"
# Distinct n-grams a task may hold before it hands them on.
HELD_GRAMS = 500_000
BLANK = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams of a text, packed into longs, and how often each occurs.

    Letters are lower-cased; everything else separates words, which are padded by a blank at
    either side. No n-gram spans two words.
    """
    points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    points = np.where(_letters()[points], points, BLANK).astype(np.int64)
    points = np.concatenate(([BLANK], points, [BLANK]))
    blank = points == BLANK
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]
    blank = points == BLANK
    pairs = points[:-1] << 21 | points[1:]
    triples = (pairs[:-1] << 21 | points[2:])[~blank[1:-1]]
    if len(points) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.sort(np.concatenate((points[~blank], pairs, triples)))
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[starts], np.diff(np.append(starts, len(grams)))


def _most_frequent(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties to the smaller one."""
    return grams[np.lexsort((grams, -counts))[:size]]


def learn_profiles(
    examples: DataFrame, size: int = PROFILE_SIZE
) -> dict[str, list[int]]:
    """The ``size`` most frequent n-grams of each ``lang`` in order of rank.

    ``examples`` has ``text`` and ``lang``; rows without a language are left out. All texts
    count; tasks hand on partial counts. Only the profiles reach the driver: their number is
    that of languages, their size is fixed.
    """

    def count(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        size = 0
        for batch in incoming:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                grams = gram_counts(text.as_py())
                held[lang.as_py()].append(grams)
                size += len(grams[0])
                if size > 8 * HELD_GRAMS:
                    held = defaultdict(list, {k: [_summed(v)] for k, v in held.items()})
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > HELD_GRAMS:
                        yield from map(_frame, held.items())
                        held, size = defaultdict(list), 0
        yield from map(_frame, held.items())

    known = examples.filter("lang is not null").select("lang", text_bytes().alias("text"))
    counted = known.mapInArrow(count, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = defaultdict(list)
    for row in top.orderBy("lang", "rank").collect():
        profiles[row["lang"]].append(row["gram"])
    return dict(profiles)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(where, np.concatenate([p[1] for p in parts]), len(grams))
    return grams, counts.astype(np.int64)


def _frame(item: tuple[str, list]) -> pa.RecordBatch:
    grams, counts = _summed(item[1])
    langs = pa.array([item[0]] * len(grams), pa.string())
    return pa.RecordBatch.from_arrays([langs, pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])


class Profiles:
    """Language profiles as one table of ranks, for all languages at a time."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size = size
        self.langs = sorted(profiles)
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *map(np.array, profiles.values())]))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for column, lang in enumerate(self.langs):
            grams = np.array(profiles[lang], np.int64)
            self.ranks[np.searchsorted(self.grams, grams), column] = np.arange(len(grams))

    def predict(self, text: bytes) -> tuple[str, float]:
        """The language whose profile is least out of place, and how well it fits (0 to 1).

        Each of the text's most frequent n-grams is as far out of place as its rank differs
        from its rank in the profile, and the profile's size if it isn't there. Ties go to the
        first language in alphabetical order.
        """
        grams, counts = gram_counts(text)
        if not len(grams) or not self.langs:
            return UNDETERMINED, 0.0
        own = _most_frequent(grams, counts, self.size)
        places = np.searchsorted(self.grams, own)
        known = self.grams[np.minimum(places, len(self.grams) - 1)] == own
        ranks = self.ranks[np.where(known, places, len(self.grams))]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, np.minimum(apart, self.size)).sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], 1 - float(distance[best]) / (self.size * len(own))


def predict(profiles: dict[str, list[int]], text: Column, size: int = PROFILE_SIZE) -> Column:
    """``struct<lang, score>`` of a text given as bytes."""

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        table = Profiles(profiles, size)
        return pd.DataFrame([table.predict(text) for text in texts], columns=["lang", "score"])

    return of(text)


def identify(
    docs: DataFrame,
    examples: DataFrame,
    size: int = PROFILE_SIZE,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language and its score, called ``names``; only ``text`` decides.

    Profiles are learned from all of ``examples`` (``text``, ``lang``). A text that is NULL or
    has no letter is ``und`` with score 0, as is every text if nothing was learned. Repeated
    rows fare alike, an empty table gives no rows; other columns stay as they are, whatever
    their names, but for columns called ``names``, which the new ones replace.
    """
    found = predict(learn_profiles(examples, size), text_bytes(), size)
    (language,) = unused([*docs.columns, *names], "language")
    return docs.withColumn(language, found).select(
        *others(docs.columns, *names),
        F.col(f"{language}.lang").alias(names[0]),
        F.col(f"{language}.score").alias(names[1]),
    )
