"""Air-quality index expressions: plain ``Column`` algebra, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from airstrata.schemas import LABELS, MEASURES


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def argmax_label(values: Sequence[str | Column], labels: Sequence[str]) -> Column:
    """Label of the largest value, NULL counting as 0; on a tie the earliest label wins."""
    filled = [F.coalesce(_as_column(v), F.lit(0)) for v in values]
    top = F.greatest(*filled)
    # The last label needs no test: something equals the maximum.
    chain = F.when(filled[0] == top, labels[0])
    for value, label in zip(filled[1:-1], labels[1:-1]):
        chain = chain.when(value == top, label)
    return chain.otherwise(labels[-1])


def capped_count(conditions: Sequence[Column], cap: int) -> Column:
    """How many conditions hold, at most ``cap``; an unknown condition does not hold."""
    hits = [F.when(c, 1).otherwise(0) for c in conditions]
    return F.least(F.lit(cap), reduce(Column.__add__, hits))


def qualified_max(values: Sequence[str | Column], score: Column, threshold: int) -> Column:
    """Row maximum where ``score`` exceeds ``threshold``, else 0. NULL values are skipped."""
    return F.when(score > threshold, F.greatest(*map(_as_column, values))).otherwise(F.lit(0))


def _arguments(measures: Sequence[str | Column], integer_args: bool) -> list[Column]:
    columns = [_as_column(m) for m in measures]
    return [F.round(c) for c in columns] if integer_args else columns


def prominent_index(
    measures: Sequence[str | Column] = MEASURES, integer_args: bool = False
) -> Column:
    """Pollutant with the highest mean. ``measures`` follow the order of ``POLLUTANTS``.

    ``integer_args`` rounds the arguments first, for callers that read the declared
    whole-number parameter types literally.
    """
    return argmax_label(_arguments(measures, integer_args), LABELS)


def criteria(measures: Sequence[str | Column] = MEASURES, integer_args: bool = False) -> Column:
    """0..3: one point for a particulate above zero, up to two for non-zero gases."""
    pm25, pm10, *gases = _arguments(measures, integer_args)
    particulates = capped_count([pm25 > 0, pm10 > 0], 1)
    return particulates + capped_count([gas != 0 for gas in gases], 2)


def aqi_value(measures: Sequence[str | Column] = MEASURES, integer_args: bool = False) -> Column:
    """Largest mean where all three criteria points are reached, else 0."""
    return qualified_max(measures, criteria(measures, integer_args), 2)
