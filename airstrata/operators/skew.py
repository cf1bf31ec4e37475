"""Joins whose key may stand in a large part of the rows."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys that a sketch follows, and the most heavy keys that it may name.
TRACKED, MOST_HEAVY = 8192, 512
COPY = "_copy"


@dataclass(frozen=True)
class HeavyKeys:
    """Values of a key that hold more rows than an even partition, and their pieces."""

    dtype: T.DataType
    pieces: dict[object, int]

    def pieces_of(self, key: Column) -> Column:
        if not self.pieces:
            return F.lit(1)
        pairs = chain.from_iterable(
            (F.lit(value).cast(self.dtype), F.lit(n)) for value, n in self.pieces.items()
        )
        return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(1))


def heavy_keys(df: DataFrame, key: str, partitions: int | None = None) -> HeavyKeys:
    """The heavy values of ``key``, found by one pass that keeps a sketch a task.

    A value is heavy if it holds more rows than one of ``partitions`` even shares (by default
    the session's shuffle partitions), so there are at most as many as shares. Its pieces are
    the shares it fills. The sketch's counts are approximate; they decide how rows are spread
    and never which rows are joined. NULL joins nothing and is not counted.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = max(2, min(partitions, MOST_HEAVY))
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {shares}, {TRACKED})").alias("top"),
    ).first()
    even = found["n"] / shares
    pieces = {
        row["item"]: math.ceil(row["count"] / even)
        for row in found["top"] or []
        if row["count"] > even
    }
    return HeavyKeys(df.schema[key].dataType, pieces)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    heavy: HeavyKeys,
    how: str = "inner",
    also: Column | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on their keys, the rows of heavy keys dealt into pieces.

    A left row of a heavy key takes one piece by a hash of the row, so a repeated task deals it
    the same way; the right rows of that key are copied to every piece. Other keys have a
    single piece. Each left row still meets each of its right rows once, so every join kind
    works that keeps no right rows without a partner. ``also`` is a further condition, for keys
    that are hashes of what has to agree. Both sides must have different column names.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no spread join of kind {how!r}")
    on = F.col(left_key) == F.col(right_key)
    if also is not None:
        on = on & also
    if not heavy.pieces:
        return left.join(right, on, how)
    plain = [f.name for f in left.schema if isinstance(f.dataType, T.AtomicType)]
    piece = F.pmod(F.xxhash64(*plain), heavy.pieces_of(F.col(left_key)).cast("long"))
    copies = F.sequence(F.lit(0), heavy.pieces_of(F.col(right_key)) - 1)
    dealt = left.withColumn(f"{COPY}_left", piece.cast("int"))
    copied = right.withColumn(f"{COPY}_right", F.explode(copies))
    met = on & (F.col(f"{COPY}_left") == F.col(f"{COPY}_right"))
    return dealt.join(copied, met, how).drop(f"{COPY}_left", f"{COPY}_right")
