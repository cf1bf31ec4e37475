"""How far the tables are behind what has arrived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.schemas import COVERAGE
from airstrata.sources.lake import Lake
from airstrata.streaming.ingest import new_files
from airstrata.streaming.loads import LOADED, REFRESHED
from airstrata.streaming.refresh import PARENTS

BRONZE = "raw_aqi"


def freshness(
    lake: Lake, landing: str | None = None, recursive: bool = False, now: dt.datetime | None = None
) -> DataFrame:
    """``(table_name, covered_until, waiting_since, lag_seconds)`` of bronze and all derived tables.

    A file arrives at its modification time. ``covered_until`` is the newest arrival that a
    table covers, ``waiting_since`` the oldest one that it does not, and ``lag_seconds`` the
    time from then until ``now`` (UTC; the current time by default). A table that covers
    everything waits for nothing and has lag 0, however long nothing arrives; one that was never
    refreshed covers nothing. Bronze waits for files in ``landing`` that no load has taken; they
    count for the derived tables as well, and without ``landing`` for none.

    The times of a load are observed while it is written. Nothing but the ledger, the list of
    files and the listing is read.
    """
    spark = lake.spark
    files = lake.table("landed_files")
    landed = files.agg(F.max("_stg_file_load_ts").alias("covered_until"))
    late = (
        spark.createDataFrame([(None,)], "waiting timestamp_ntz")
        if landing is None
        else new_files(lake, landing, recursive).agg(F.min("_stg_file_load_ts").alias("waiting"))
    )
    bronze = landed.crossJoin(F.broadcast(late)).select(
        F.lit(BRONZE).alias("table_name"), "covered_until", F.col("waiting").alias("waiting_since")
    )

    # Loads stay in the ledger until all tables cover them, so these joins are small.
    steps = lake.read("loads").groupBy("load_number").agg(
        F.min("first_arrival").alias("first_arrival"),
        F.max(F.col("step") == LOADED).alias("loaded"),
        F.max(F.col("step") == REFRESHED).alias("covered"),
    )
    open_loads = steps.filter(F.col("loaded") & ~F.col("covered"))
    names = spark.createDataFrame([(name,) for name in PARENTS], "table_name string")
    known = names.join(lake.table("coverage").select(*COVERAGE.names), "table_name", "left")
    ahead = open_loads.select(F.col("load_number").alias("open_load"), "first_arrival")
    behind = F.col("open_load") > F.coalesce("load_number", F.lit(0))
    waiting = known.join(F.broadcast(ahead), behind, "left").groupBy("table_name").agg(
        F.first("covered_until").alias("covered_until"), F.min("first_arrival").alias("unrefreshed")
    )
    derived = waiting.crossJoin(F.broadcast(late)).select(
        "table_name", "covered_until", F.least("unrefreshed", "waiting").alias("waiting_since")
    )
    at = F.lit(now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    lag = F.timestamp_diff("SECOND", F.col("waiting_since"), at)
    return bronze.unionByName(derived).withColumn("lag_seconds", F.coalesce(lag, F.lit(0).cast("long")))
