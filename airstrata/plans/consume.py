"""The questions asked of the model. Choices are arguments and never become SQL text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.operators import rank_within_key, star_join
from airstrata.plans.model import city_hour, date_parts, fact_air_quality, index_columns
from airstrata.schemas import (
    AUDIT_COLUMNS,
    DATE_PARTITION,
    GOLD_MEASURES,
    MEASURES,
    STATION_KEYS,
)

CITY_ORDER = ("country", "state", "city", "measurement_time")
FILE_COLUMNS = ("index_record_ts", "record_count", "json_version", *AUDIT_COLUMNS)
MAP_COORDINATE = T.DecimalType(10, 7)


def _moment(value: str | dt.datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _on_date(df: DataFrame, time: str, date: str | dt.date) -> DataFrame:
    """Rows of a date; a stored table also reads only that date's partition."""
    day = F.lit(date).cast("date")
    if DATE_PARTITION in df.columns:
        df = df.filter(F.col(DATE_PARTITION) == day)
    return df.filter(F.to_date(time) == day) if time in df.columns else df


def _on_day_of(df: DataFrame, ts: str | dt.datetime) -> DataFrame:
    """A stored table reduced to the partition of a time; other tables as they are."""
    if DATE_PARTITION not in df.columns:
        return df
    return df.filter(F.col(DATE_PARTITION) == _moment(ts).cast("date"))


def top_cities_latest_day(day: DataFrame, k: int = 10, latest: Column | None = None) -> DataFrame:
    """The ``k`` cities with the highest index on the latest day, ties by state and city.

    ``latest`` supplies the day where the caller has it from a cheaper table.
    """
    stored = DATE_PARTITION in day.columns
    if latest is None:
        latest = day.agg(F.max(DATE_PARTITION if stored else "measurement_date")).scalar()
    if stored:
        day = day.filter(F.col(DATE_PARTITION) == latest)
    return (
        day.filter(F.col("measurement_date") == latest)
        .orderBy(F.desc("aqi"), "state", "city")
        .select("state", "city", *MEASURES, "prominent_pollutant", "aqi")
        .limit(k)
    )


def city_hourly_trend(
    hours: DataFrame, state: str, city: str, date: str | dt.date
) -> DataFrame:
    """Pollutant means of a city for each hour of a date."""
    chosen = hours.filter((F.col("state") == state) & (F.col("city") == city))
    return (
        _on_date(chosen, "measurement_time", date)
        .orderBy("measurement_time")
        .select(F.hour("measurement_time").alias("hour"), *MEASURES)
    )


def station_drilldown(
    fact: DataFrame,
    dates: DataFrame,
    locations: DataFrame,
    state: str,
    city: str,
    station: str,
    date: str | dt.date,
) -> DataFrame:
    """Readings and index of a station for each hour of a date."""
    chosen = locations.filter(
        (F.col("state") == state) & (F.col("city") == city) & (F.col("station") == station)
    )
    joined = star_join(
        _on_date(fact, "measurement_time", date).drop(DATE_PARTITION),
        _on_date(dates, "measurement_time", date).drop(DATE_PARTITION),
        chosen,
    )
    return joined.orderBy("measurement_time").select(
        F.hour("measurement_time").alias("hour"),
        "state",
        "city",
        "station",
        F.col("latitude").cast(MAP_COORDINATE).alias("latitude"),
        F.col("longitude").cast(MAP_COORDINATE).alias("longitude"),
        *MEASURES,
        "prominent_pollutant",
        "aqi",
    )


def hourly_index(drilldown: DataFrame) -> DataFrame:
    """Hour and index of a drill-down."""
    return drilldown.select("hour", "aqi")


def hourly_pollutants(drilldown: DataFrame) -> DataFrame:
    """Hour and pollutant readings of a drill-down."""
    return drilldown.select("hour", *MEASURES)


def map_points(df: DataFrame) -> DataFrame:
    """Coordinates as floating-point numbers, for drawing."""
    return df.select(
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
    )


def file_rank_audit(bronze: DataFrame, n: int | None = None) -> DataFrame:
    """Files with their rank among the files of the same hour, newest file first.

    With ``n``, the files of the latest hours: sorting by hour and then by rank order means
    the first ``n`` rows hold every better-ranked file, so ranking those rows alone is exact.
    """
    newest = ["_stg_file_load_ts", "_stg_file_name", "id"]
    files = bronze.filter(F.col("index_record_ts").isNotNull()).select("id", *FILE_COLUMNS)
    if n is None:
        ranked = rank_within_key(files, ["index_record_ts"], newest, "latest_file_rank")
        return ranked.select(*FILE_COLUMNS, "latest_file_rank")
    order = [F.desc(c) for c in newest]
    head = files.orderBy(F.desc("index_record_ts"), *order).limit(n)
    rank = F.row_number().over(Window.partitionBy("index_record_ts").orderBy(*order))
    return (
        head.withColumn("latest_file_rank", rank)
        .orderBy(F.desc("index_record_ts"), "latest_file_rank")
        .select(*FILE_COLUMNS, "latest_file_rank")
    )


def bronze_ids(bronze: DataFrame) -> DataFrame:
    """Ids and times of the dated files in id order."""
    dated = bronze.filter(F.col("index_record_ts").isNotNull())
    return dated.select("id", "index_record_ts").orderBy("id")


def staged_preview(parsed: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` parsed documents before they are loaded."""
    return parsed.drop("value", "reject_reason").limit(n)


def foreign_rows(some: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``some`` whose keys ``known`` lacks.

    ``some`` is small, and stored if its rows are any: it is read twice. Its keys go to the rows
    of ``known``, which has any size and is neither broadcast nor shuffled whole.
    """
    keys = list(keys)
    found = known.select(*keys).join(F.broadcast(some.select(*keys)), keys, "left_semi").distinct()
    return some.join(F.broadcast(found), keys, "left_anti")


def station_inspect(df: DataFrame, country: str, state: str, station: str) -> DataFrame:
    """Readings of a station, long or wide, with the hour of measurement in front."""
    chosen = df.filter(
        (F.col("country") == country) & (F.col("state") == state) & (F.col("station") == station)
    )
    return chosen.select(F.hour("index_record_ts").alias("measurement_hours"), "*").orderBy(
        "measurement_hours", "index_record_ts"
    )


def fact_point_lookup(
    wide: DataFrame, city: str, station: str, ts: str | dt.datetime
) -> DataFrame:
    """The fact row of a station at a time."""
    chosen = _on_day_of(wide, ts).filter(
        (F.col("city") == city)
        & (F.col("station") == station)
        & (F.col("index_record_ts") == _moment(ts))
    )
    return fact_air_quality(chosen).drop("aqi_pk")


def city_hour_lookup(hours: DataFrame, city: str, ts: str | dt.datetime) -> DataFrame:
    """Cities of a name at a time."""
    chosen = _on_day_of(hours, ts).filter(
        (F.col("city") == city) & (F.col("measurement_time") == _moment(ts))
    )
    return chosen.drop(DATE_PARTITION).orderBy(*CITY_ORDER)


def city_hour_head(hours: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` rows by country, state, city and time."""
    return hours.drop(DATE_PARTITION).orderBy(*CITY_ORDER).limit(n)


def city_hour_draft(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """City means per hour keyed by state and city only."""
    return city_hour(fact, dates, locations, keys=("measurement_time", "state", "city"))


def station_denorm(wide: DataFrame) -> DataFrame:
    """Station readings with date parts (hours from 0) and index, in one table."""
    return wide.select(
        "index_record_ts",
        *date_parts("index_record_ts"),
        *STATION_KEYS,
        *GOLD_MEASURES,
        *index_columns(),
    )
