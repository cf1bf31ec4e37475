"""Keeping the derived tables equal to their definitions.

``refresh_all`` recomputes everything; ``refresh_dates`` recomputes what a change of bronze
on some dates can reach, and gives the same tables. Both write whole partitions, parents
first, so a run that was cut short is repaired by running it again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.operators.sizing import broadcast_if_small
from airstrata.plans import model
from airstrata.schemas import DATE_PARTITION, DIM_LOCATION
from airstrata.session import stored
from airstrata.sources.lake import Lake, in_parallel, spread_by_date
from airstrata.streaming.loads import mark_covered, mark_refreshed, pending_loads

# Each derived table with the tables it is computed from, parents first.
PARENTS = {
    "curated_aqi_dt": ("raw_aqi",),
    "curated_flatten_aqi_dt": ("curated_aqi_dt",),
    "dim_date": ("curated_flatten_aqi_dt",),
    "location_by_day": ("curated_flatten_aqi_dt",),
    "location_counts": ("location_by_day",),
    "dim_location": ("location_counts",),
    "fact_air_quality": ("curated_flatten_aqi_dt",),
    "location_hour": ("curated_flatten_aqi_dt",),
    "city_hour_sums": ("location_hour", "dim_location"),
    "fact_city_agg_hour_level": ("city_hour_sums",),
    "fact_city_agg_day_level": ("fact_city_agg_hour_level",),
}
# Tables in which a date depends on the same date of the parents and on nothing else: one after
# the other, then side by side.
DAILY = ("curated_aqi_dt", "curated_flatten_aqi_dt")
DAILY_BRANCHES = ("dim_date", "fact_air_quality", "location_hour")
CITIES = ("fact_city_agg_hour_level", "fact_city_agg_day_level")

Dates = Iterable[dt.date] | None
STATION = DIM_LOCATION.names


def refresh_order(*targets: str) -> list[str]:
    """The targets (all tables by default) and the tables they need, parents first."""
    needed = set(targets or PARENTS)
    for name in reversed(PARENTS):
        if name in needed:
            needed.update(PARENTS[name])
    return [name for name in PARENTS if name in needed]


def derive(lake: Lake, name: str, dates: Dates = None) -> DataFrame:
    """Definition of a table over its stored parents, restricted to dates if given."""
    carry = [DATE_PARTITION]
    if name == "curated_aqi_dt":
        return model.silver_long(lake.raw(dates), lake.on_bad, carry)
    if name == "curated_flatten_aqi_dt":
        return model.wide_clean(
            lake.read("curated_aqi_dt", dates), lake.on_bad, lake.numeric, carry
        )
    if name == "dim_date":
        return model.dim_date(lake.read("curated_flatten_aqi_dt", dates), carry)
    if name == "location_by_day":
        return model.dim_location(lake.read("curated_flatten_aqi_dt", dates), carry)
    if name == "location_counts":
        days = lake.read("location_by_day", dates)
        return days.groupBy(*STATION).agg(F.count(F.lit(1)).alias("n_days"))
    if name == "dim_location":
        return lake.table("location_counts").select(*STATION)
    if name == "fact_air_quality":
        return model.fact_air_quality(lake.read("curated_flatten_aqi_dt", dates), carry)
    if name == "location_hour":
        return model.location_hour(lake.read("curated_flatten_aqi_dt", dates), carry)
    if name == "city_hour_sums":
        parts = lake.read("location_hour", dates)
        locations = broadcast_if_small(lake.table("dim_location"), settle=False)
        return model.merge_parts(model.city_parts(parts, locations, carry), carry)
    if name == "fact_city_agg_hour_level":
        return model.city_means(lake.read("city_hour_sums", dates), carry)
    if name == "fact_city_agg_day_level":
        days = model.city_day(lake.read("fact_city_agg_hour_level", dates))
        return days.withColumn(DATE_PARTITION, F.col("measurement_date"))
    raise KeyError(name)


def refresh_all(lake: Lake, *targets: str) -> None:
    """Recompute the targets and their parents from bronze."""
    labels, _ = pending_loads(lake)
    loads = stored(lake.read("loads"), "loads")
    lake.delete(_staging(lake))
    for name in refresh_order(*targets):
        df = derive(lake, name)
        lake.overwrite(name, spread_by_date(df) if DATE_PARTITION in df.columns else df)
    mark_covered(lake, refresh_order(*targets), loads)
    if not targets:
        mark_refreshed(lake, labels)


def refresh_pending(lake: Lake) -> set[dt.date]:
    """Refresh the dates of all loads that none has covered yet, also of an aborted run."""
    finish_refresh(lake)
    labels, dates = pending_loads(lake)
    if labels:
        loads = stored(lake.read("loads"), "loads")
        refresh_dates(lake, dates)
        mark_covered(lake, PARENTS, loads)
        mark_refreshed(lake, labels)
    return dates


def _dates_of(df: DataFrame) -> set[dt.date]:
    """Distinct partition dates; bounded by the days on record, so safe to bring here."""
    return {row[0] for row in df.select(DATE_PARTITION).distinct().collect()}


def refresh_dates(lake: Lake, dates: Iterable[dt.date]) -> None:
    """Recompute everything that rows of these dates in bronze can change.

    The tables of the dates are replaced. What reaches beyond them, a station that is new on a
    known coordinate or gone from it, is found by ``stage_places`` from the stations of these
    dates, and applied by ``finish_refresh``.
    """
    finish_refresh(lake)
    dates = set(dates)
    if not dates:
        return
    live = _dates_of(lake.raw(dates))
    for name in DAILY:
        _replace_dates(lake, name, live, dates - live)
    in_parallel(
        lake.spark, lambda name: _replace_dates(lake, name, live, dates - live), DAILY_BRANCHES
    )
    stage_places(lake, live, dates - live)
    finish_refresh(lake)


def _staging(lake: Lake, name: str = "") -> str:
    return f"{lake.root}/_refresh/{name}".rstrip("/")


def stage_places(lake: Lake, live: set[dt.date], gone: set[dt.date]) -> None:
    """Work out what the stations of the dates change, without applying any of it.

    A station counts the days it is on record. Those of the dates before and after the change
    give signed counts; where a count leaves or reaches zero, the station has come or gone. If
    its coordinate keeps other stations, the city means of every date of that coordinate
    change: its partial means leave the cities it was in and join those it is in now, and no
    fact is read. Otherwise no other date is read at all.

    Results are staged whole beside the tables, and a list of the dates last: only with it do
    they count.
    """
    lake.delete(_staging(lake))
    carry = [DATE_PARTITION]
    days = stored(derive(lake, "location_by_day", sorted(live)), "stations") if live else None
    before = lake.read("location_by_day", live | gone).select(*STATION, F.lit(-1).alias("n_days"))
    change = before if days is None else before.unionByName(days.select(*STATION, F.lit(1).alias("n_days")))
    known = lake.table("location_counts")
    counts = (
        known.withColumn("was", F.col("n_days"))
        .unionByName(change.withColumn("was", F.lit(0)))
        .groupBy(*STATION)
        .agg(F.sum("n_days").alias("n_days"), F.sum("was").alias("was"))
    )
    counts = stored(counts, "counts")
    moved = _moved_keys(counts)
    reached: set[dt.date] = set()
    if moved is not None:
        on_record = lake.read("location_by_day").select("location_pk", DATE_PARTITION)
        reached = _dates_of(on_record.join(moved, "location_pk", "left_semi")) - live - gone

    after = counts.filter("n_days > 0")
    after.select(*STATION, "n_days").write.parquet(_staging(lake, "location_counts"))
    locations = broadcast_if_small(after.select(*STATION), settle=False)
    sums = []
    if live:
        parts = lake.read("location_hour", sorted(live))
        sums.append(model.merge_parts(model.city_parts(parts, locations, carry), carry))
        days.write.parquet(_staging(lake, "location_by_day"))
    if reached:
        parts = lake.read("location_hour", sorted(reached))
        parts = parts.join(moved.withColumnRenamed("location_pk", "location_fk"), "location_fk", "left_semi")
        leave = model.city_parts(parts, lake.table("dim_location"), carry)
        join = model.city_parts(parts, locations, carry)
        columns = [F.negative(c).alias(c) if c in model.PARTS else F.col(c) for c in leave.columns]
        stayed = lake.read("city_hour_sums", sorted(reached)).select(*leave.columns)
        moves = stayed.unionByName(leave.select(*columns)).unionByName(join)
        sums.append(model.merge_parts(moves, carry))
    if sums:
        reduce(DataFrame.unionByName, sums).write.parquet(_staging(lake, "city_hour_sums"))
    listed = [(d, "live") for d in live] + [(d, "gone") for d in gone] + [(d, "reached") for d in reached]
    dates = lake.spark.createDataFrame(listed, "date date, kind string")
    dates.coalesce(1).write.parquet(_staging(lake, "dates"))


def _moved_keys(counts: DataFrame) -> DataFrame | None:
    """Coordinates that had stations and still have some, but not the same; None without any."""
    came_or_went = (F.col("was") > 0) != (F.col("n_days") > 0)
    keys = counts.groupBy("location_pk").agg(
        F.max(came_or_went).alias("changed"), F.sum("was").alias("was"), F.sum("n_days").alias("now")
    )
    moved = stored(keys.filter("changed and was > 0 and now > 0").select("location_pk"), "moved")
    return None if moved.isEmpty() else broadcast_if_small(moved, settle=False)


def finish_refresh(lake: Lake) -> None:
    """Apply what is staged, if all of it is; a run that dies here is completed by the next.

    Every step replaces whole partitions or tables by staged ones or by functions of them, so
    it can be repeated. A staging without its list of dates was cut short and is dropped.
    """
    if not lake.exists(_staging(lake, "dates/_SUCCESS")):
        lake.delete(_staging(lake))
        return
    listed = lake.spark.read.schema("date date, kind string").parquet(_staging(lake, "dates")).collect()
    gone = {row["date"] for row in listed if row["kind"] == "gone"}
    live = {row["date"] for row in listed} - gone

    def apply(name: str) -> None:
        if lake.exists(_staging(lake, name)):
            staged = lake.spark.read.schema(lake.stored_schema(name)).parquet(_staging(lake, name))
            if name == "location_counts":
                lake.overwrite(name, staged)
            else:
                lake.overwrite_partitions(name, spread_by_date(staged))
        if name != "location_counts":
            for date in sorted(gone):
                lake.empty_partition(name, date)

    in_parallel(lake.spark, apply, ("location_by_day", "city_hour_sums", "location_counts"))
    lake.overwrite("dim_location", derive(lake, "dim_location"))
    for name in CITIES:
        _replace_dates(lake, name, live, gone)
    lake.delete(_staging(lake))


def _replace_dates(lake: Lake, name: str, live: set[dt.date], gone: set[dt.date]) -> None:
    if live:
        df = derive(lake, name, sorted(live))
        lake.overwrite_partitions(name, spread_by_date(df))
    for date in sorted(gone):
        lake.empty_partition(name, date)
