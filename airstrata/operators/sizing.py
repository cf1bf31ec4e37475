"""Measured broadcast decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.session import ensure_checkpoint_dir

BROADCAST_LIMIT = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows, counted by one aggregation: 16 bytes a value plus its text.

    Nested values and variants count by the length of their JSON.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    texts = [
        F.to_json(F.struct(f.name)) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema
        if isinstance(f.dataType, (T.StringType, T.BinaryType, *nested))
    ]
    lengths = [F.coalesce(F.octet_length(text), F.lit(0)).cast("long") for text in texts]
    row = reduce(Column.__add__, lengths, F.lit(16 * len(df.columns)).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(
    df: DataFrame, limit: int = BROADCAST_LIMIT, settle: bool = True
) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes, else unhinted.

    Unhinted, the join shuffles. Without the check up front, adaptive execution would start
    shuffling the large side before it knows that the small one could have been broadcast.
    ``settle`` computes ``df`` once into the checkpoint folder; leave it out for stored tables.
    """
    if settle:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    return F.broadcast(df) if measured_bytes(df) <= limit else df
