"""Text to timestamp and text to number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAST_UPDATE_FORMAT = "dd-MM-yyyy HH:mm:ss"


def parse_ts(text: str | Column, fmt: str = LAST_UPDATE_FORMAT) -> Column:
    """Wall-clock text as ``timestamp_ntz``; NULL where it does not match the zone-less format.

    Parsing to a zoned timestamp and casting would move times that fall into a daylight-saving
    gap of the session zone. Reading the text as UTC and counting from the epoch does not
    depend on the session.
    """
    column = F.col(text) if isinstance(text, str) else text
    instant = F.try_to_timestamp(F.concat(column, F.lit(" Z")), F.lit(f"{fmt} X"))
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def clean_numeric(
    text: str | Column, sentinels: Sequence[str] = ("NA",), on_bad: str = "raise"
) -> Column:
    """Rounded number of a text reading; 0 for a sentinel or NULL.

    Other text that is no finite number, ``NaN`` included, fails the job (``raise``) or becomes
    NULL (``null``), whatever the session's ANSI setting.
    """
    if on_bad not in ("raise", "null"):
        raise ValueError(f"on_bad must be 'raise' or 'null', not {on_bad!r}")
    column = F.col(text) if isinstance(text, str) else text
    missing = column.isNull() | column.isin(*sentinels)
    return F.when(missing, F.lit(0.0)).otherwise(F.round(strict_cast(column, "double", on_bad)))


def strict_cast(text: Column, kind: str | T.DataType, on_bad: str = "raise") -> Column:
    """Text as a finite number; text that is none fails the job or becomes NULL."""
    number = text.try_cast(kind)
    approximate = number.cast("double")
    good = ~F.isnan(approximate) & (F.abs(approximate) < F.lit(float("inf")))
    checked = F.when(good, number)
    if on_bad == "null":
        return checked
    failure = F.raise_error(F.concat(F.lit("not a number: "), text)).cast(kind)
    return F.when(text.isNotNull() & ~F.coalesce(good, F.lit(False)), failure).otherwise(checked)
