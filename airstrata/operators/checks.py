"""Checks that stand in for constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_uniqueness(df: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, with their ``occurrences``; empty if unique."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.filter(F.col("occurrences") > 1)
