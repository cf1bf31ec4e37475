"""Row numbers within a key, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airstrata.operators.sizing import broadcast_if_small
from airstrata.session import ensure_checkpoint_dir


def rank_within_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], name: str = "rank"
) -> DataFrame:
    """All rows with ``row_number`` per key, highest by ``newest`` first.

    A window would put every row of a key into one task. Here the rows are range-partitioned
    by key and order together, so a hot key spreads over many tasks. Each sorted row gets its
    position; a key's rank is the position relative to the start of the key in that partition
    plus the rows of the key in earlier partitions. The checkpoint pins the positions that
    both uses of the sorted rows rely on. End ``newest`` with a unique column.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(k).asc() for k in keys] + [F.desc(c) for c in newest]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftrightunsigned("_position", 33))
    )
    # One row per key and partition: at most (keys + partitions) rows, since the ranges of a
    # key are contiguous.
    runs = placed.groupBy(*keys, "_part").agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    starts = runs.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_run"),
        (F.col("_first") - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).alias("_start"),
    )
    matches: Column = F.col("_part") == F.col("_run")
    for i, key in enumerate(keys):
        matches = matches & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    return placed.join(broadcast_if_small(starts), matches).select(
        *df.columns, (F.col("_position") - F.col("_start") + 1).cast("int").alias(name)
    )
