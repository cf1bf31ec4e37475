"""Hash keys of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: str) -> Column:
    """64-bit key of the columns.

    ``xxhash64`` skips NULLs, which would make (NULL, 1) and (1, NULL) equal, so every value
    is preceded by its null flag.
    """
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)
