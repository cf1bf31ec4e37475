"""Group averages and member lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_avg(
    df: DataFrame,
    keys: Sequence[str | Column],
    measures: Sequence[str],
    rounded: bool = False,
) -> DataFrame:
    """Mean of each measure per key, rounded to whole numbers on request.

    Means of fractions depend in their last bits on the order of summation. Rounding to six
    places first keeps a mean that lies exactly half way from going either way.
    """

    def mean(measure: str) -> Column:
        value = F.avg(measure)
        return F.round(F.round(value, 6)) if rounded else value

    return df.groupBy(*keys).agg(*[mean(m).alias(m) for m in measures])


def _matching(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    for column, value in filters.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def members(df: DataFrame, column: str, desc: bool = False, **filters: object) -> DataFrame:
    """Sorted distinct values of a column among the rows equal to ``filters``."""
    return (
        _matching(df, filters)
        .select(column)
        .distinct()
        .orderBy(F.desc(column) if desc else F.asc(column))
    )


def member_dates(df: DataFrame, desc: bool = True, **filters: object) -> DataFrame:
    """Sorted distinct dates of ``measurement_time`` among the rows equal to ``filters``."""
    dated = _matching(df, filters).select(F.to_date("measurement_time").alias("measurement_date"))
    return members(dated, "measurement_date", desc)
