"""Latest version per key, and load-once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airstrata.operators.sizing import BROADCAST_LIMIT, broadcast_if_small


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the highest by ``newest``, compared in that order, NULLs lowest.

    End ``newest`` with a unique column to make the choice deterministic. The rank filter is
    applied before the shuffle too, so a hot key sends one row per input partition.
    """
    ranking = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest])
    return (
        df.withColumn("_rank", F.row_number().over(ranking))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_latest_rows(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str],
    row_id: str,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``latest_per_key`` for rows with a heavy payload and a unique ``row_id``.

    The winners are found on the narrow columns alone; their ids then filter a second scan.
    While the ids fit a broadcast, the payload is neither sorted nor shuffled.
    """
    narrow = df.select(*dict.fromkeys([*keys, *newest, row_id]))
    winners = latest_per_key(narrow, keys, [*newest, row_id]).select(row_id)
    return df.join(broadcast_if_small(winners, broadcast_limit), row_id, "left_semi")


def not_yet_loaded(files: DataFrame, loaded: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Files whose identity (name and content hash) is not among the loaded ones."""
    return files.join(loaded.select(*identity), list(identity), "left_anti")
