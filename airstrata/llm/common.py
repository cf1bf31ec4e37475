"""Small helpers of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What \x20 and \x09-\x0D hold: the separators of words and the margins of lines.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores appended to those that a column bears, in any case."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def others(columns: Iterable[str], *names: str) -> list[str]:
    """The columns that bear none of the names, in any case."""
    gone = {name.lower() for name in names}
    return [c for c in columns if c.lower() not in gone]


def id_remainder(name: str, divisor: int) -> Column:
    """crc32 of an id's text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % divisor


def batches(rows: Iterable[tuple[object, int]], limit: int = 8 << 20) -> Iterator[list]:
    """Lists of what ``rows`` gives, cut when the sizes given along add up to ``limit``."""
    held: list = []
    size = 0
    for row, weight in rows:
        held.append(row)
        size += weight
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
