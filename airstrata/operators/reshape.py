"""Nested records to rows, and rows to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_records(
    df: DataFrame,
    document: str,
    fields: Sequence[str],
    keep: Sequence[str] = (),
    array: str = "records",
) -> DataFrame:
    """One row per element of the array field, its ``fields`` as text, after ``keep``.

    ``document`` is a variant, from which the array is extracted in one typed step, or the
    array of structs that parsing has found already. A variant has a largest size, and a document
    beyond it is NULL there and has no rows: where documents may be that large, pass the parsed
    array. A missing field, or an element that is no object, yields NULLs; a document without
    elements yields no row.
    """
    kind = df.schema[document].dataType
    if isinstance(kind, T.ArrayType):
        found = kind.elementType.names

        def record(r: Column) -> Column:
            return F.struct(
                *[(r[f] if f in found else F.lit(None)).cast("string").alias(f) for f in fields]
            )

        return df.select(*keep, F.inline(F.transform(document, record)))
    leaves = ",".join(f"`{f}`:string" for f in fields)
    records = F.try_variant_get(document, f"$.{array}", f"array<struct<{leaves}>>")
    return df.select(*keep, F.inline(records))


def pivot_long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    value: str,
    columns: Mapping[str, str],
    numeric: bool = False,
) -> DataFrame:
    """One row per key with a column for each category listed in ``columns``.

    A repeated reading keeps its maximum. By default values compare as text, as the original
    tables do: '9' beats '10' and 'NA' beats every number. ``numeric`` compares numbers
    instead, ignoring other text.

    Spark aggregates numbers in a hash table but sorts for text maxima. Grouping by a hash of
    the keys first leaves the groups as they are and lets that sort compare one number where
    it would compare all key columns.
    """
    reading = F.col(value).try_cast("double") if numeric else F.col(value)
    lead = [] if numeric else [F.xxhash64(*keys).alias("_keys_hash")]
    wide = df.groupBy(*lead, *keys).agg(
        *[
            F.max(F.when(F.col(category) == code, reading)).alias(column)
            for code, column in columns.items()
        ]
    )
    return wide.select(*keys, *columns.values())
