"""The tables of the model as functions from DataFrame to DataFrame.

``carry`` names extra columns to pass through, such as the day partition of stored tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.functions import aqi_value, clean_numeric, prominent_index, surrogate_key
from airstrata.functions.text import strict_cast
from airstrata.operators import (
    HeavyKeys,
    keep_latest_rows,
    pivot_long_to_wide,
    rollup_avg,
    star_join,
)
from airstrata.operators.sizing import BROADCAST_LIMIT
from airstrata.schemas import (
    AUDIT_COLUMNS,
    COORDINATE,
    COUNTS,
    GOLD_MEASURES,
    LOCATION_COLUMNS,
    MEASURES,
    POLLUTANTS,
    READING_KEYS,
    RECORD_FIELDS,
    SUMS,
)

PLACE = ("country", "state", "city")
PARTS = ("n_rows", *SUMS, *COUNTS)
PIVOT = {p.code: p.column for p in POLLUTANTS}


def silver_long(
    bronze: DataFrame,
    on_bad: str = "raise",
    carry: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per hour, station and pollutant, from the newest file of each hour.

    ``bronze`` has the ``records`` that the loader found in each document. A coordinate that is
    no number fails the job, or becomes NULL with ``on_bad='null'``.
    """
    dated = bronze.filter(F.col("index_record_ts").isNotNull())
    newest = keep_latest_rows(
        dated,
        ["index_record_ts"],
        ["_stg_file_load_ts", "_stg_file_name"],
        row_id="id",
        broadcast_limit=broadcast_limit,
    )
    keep = ["index_record_ts", *AUDIT_COLUMNS, *carry]
    flat = newest.select(*keep, F.inline("records"))

    def coordinate(name: str) -> Column:
        return strict_cast(F.col(name), COORDINATE, on_bad).alias(name)

    return flat.select(
        "index_record_ts",
        *[coordinate(f) if f in ("latitude", "longitude") else F.col(f) for f in RECORD_FIELDS],
        *AUDIT_COLUMNS,
        *carry,
    )


def spaced_states(df: DataFrame) -> DataFrame:
    """State names with spaces for underscores, as all tables after silver long have them."""
    return df.withColumn("state", F.replace("state", F.lit("_"), F.lit(" ")))


def wide_text(long: DataFrame, numeric: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """One row per hour and station with the pollutant readings as columns, not yet cleaned."""
    keys = [*READING_KEYS, *carry]
    return pivot_long_to_wide(long, keys, "pollutant_id", "pollutant_avg", PIVOT, numeric)


def wide_clean(
    long: DataFrame,
    on_bad: str = "raise",
    numeric: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per hour and station with whole-number readings, 0 where missing.

    With ``numeric``, text that is neither a number nor ``NA`` fails the job, or counts as
    missing with ``on_bad='null'``.
    """
    if numeric:
        reading = F.nullif("pollutant_avg", F.lit("NA"))
        long = long.withColumn("pollutant_avg", strict_cast(reading, "double", on_bad))
        cleaned = {m: F.round(F.coalesce(m, F.lit(0.0))) for m in MEASURES}
    else:
        cleaned = {m: clean_numeric(m, on_bad=on_bad) for m in MEASURES}
    return (
        spaced_states(wide_text(long, numeric, carry))
        .withColumns(cleaned)
        .select(*READING_KEYS, *MEASURES, *carry)
    )


def date_parts(ts: str, hour_offset: int = 0) -> list[Column]:
    """Year, month, quarter, day and hour of a timestamp as ``aqi_*`` columns."""
    return [
        F.year(ts).alias("aqi_year"),
        F.month(ts).alias("aqi_month"),
        F.quarter(ts).alias("aqi_quarter"),
        F.dayofmonth(ts).alias("aqi_day"),
        (F.hour(ts) + hour_offset).alias("aqi_hour"),
    ]


def dim_date(readings: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Distinct times with their parts; ``aqi_hour`` counts from 1.

    Any table with ``index_record_ts`` will do, the narrower the cheaper.
    """
    times = readings.select("index_record_ts", *carry).distinct()
    return times.select(
        surrogate_key("index_record_ts").alias("date_pk"),
        F.col("index_record_ts").alias("measurement_time"),
        *date_parts("index_record_ts", hour_offset=1),
        *carry,
    )


def dim_location(readings: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Distinct stations. The key covers the coordinate only, so it can repeat."""
    stations = readings.select(*LOCATION_COLUMNS, *carry).distinct()
    return stations.select(
        surrogate_key("latitude", "longitude").alias("location_pk"), *LOCATION_COLUMNS, *carry
    )


def index_columns() -> list[Column]:
    """Prominent pollutant and index of the seven means."""
    return [
        prominent_index(MEASURES).alias("prominent_pollutant"),
        aqi_value(MEASURES).alias("aqi"),
    ]


def fact_air_quality(wide: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Station readings with keys and index."""
    return wide.select(
        surrogate_key("index_record_ts", "latitude", "longitude").alias("aqi_pk"),
        surrogate_key("index_record_ts").alias("date_fk"),
        surrogate_key("latitude", "longitude").alias("location_fk"),
        *GOLD_MEASURES,
        *index_columns(),
        *carry,
    )


def city_hour(
    fact: DataFrame,
    dates: DataFrame,
    locations: DataFrame,
    keys: Sequence[str] = ("measurement_time", "country", "state", "city"),
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Mean of the stations of a city for each hour, with the index of the means.

    The means are those over the star join, where a fact counts once for every station of its
    location key. Joining all of them would emit every pair of a fact and a station on a shared
    coordinate. Here each fact meets one row per key: the city and its station count if all
    stations of the key lie in one city, else the key itself. Sums of shared keys are given to
    their cities, weighted by station counts, only after they have been aggregated. ``heavy``
    names coordinates with a large part of the facts, as for ``star_join``.
    """
    place = [k for k in keys if k != "measurement_time"]
    cities = locations.groupBy("location_pk", *place).agg(F.count(F.lit(1)).alias("_stations"))
    only = F.min(F.struct(*place, "_stations"))
    per_key = cities.groupBy("location_pk").agg(F.count(F.lit(1)).alias("_n"), only.alias("_only"))
    alone = F.col("_n") == 1
    labels = per_key.select(
        "location_pk",
        F.when(~alone, F.col("location_pk")).alias("_shared"),
        F.when(alone, F.col("_only._stations")).otherwise(1).alias("_stations"),
        *[F.when(alone, F.col(f"_only.{p}")).alias(p) for p in place],
    )

    def totals(df: DataFrame, *by: str) -> DataFrame:
        sums = [F.sum(F.col(m) * F.col("_stations")).alias(m) for m in GOLD_MEASURES]
        counts = [F.sum(F.col(f"_n_{m}") * F.col("_stations")).alias(f"_n_{m}") for m in GOLD_MEASURES]
        return df.groupBy(*by).agg(*sums, *counts)

    counted = fact.select(
        "date_fk",
        "location_fk",
        *GOLD_MEASURES,
        *[F.col(m).isNotNull().cast("long").alias(f"_n_{m}") for m in GOLD_MEASURES],
    )
    joined = star_join(counted, dates.select("date_pk", "measurement_time"), labels, heavy)
    parts = totals(joined, "measurement_time", "_shared", *place)

    sharing = cities.select(
        F.col("location_pk").alias("_key"),
        "_stations",
        *[F.col(p).alias(f"_{p}") for p in place],
    )
    # Nearly all parts share no key. They would meet in the partition of NULL; a hash of their
    # own columns spreads them, and the second condition keeps them from matching.
    parts = parts.withColumn("_met", F.coalesce("_shared", F.xxhash64("measurement_time", *place)))
    met = (F.col("_met") == F.col("_key")) & F.col("_shared").isNotNull()
    placed = parts.join(sharing, met, "left").withColumns(
        {p: F.coalesce(p, f"_{p}") for p in place}
        | {"_stations": F.coalesce("_stations", F.lit(1))}
    )
    means = totals(placed, *keys).select(
        *keys, *[F.try_divide(m, f"_n_{m}").alias(m) for m in GOLD_MEASURES]
    )
    return means.select("*", *index_columns())


def location_hour(wide: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Sums and counts of the readings of each coordinate and hour, from which means are merged.

    Readings are whole numbers, so their sums are exact and can be subtracted again.
    """
    keyed = wide.withColumns(
        {"location_fk": surrogate_key("latitude", "longitude"), "measurement_time": F.col("index_record_ts")}
    )
    return keyed.groupBy("location_fk", "measurement_time", *carry).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(s) for m, s in zip(GOLD_MEASURES, SUMS)],
        *[F.count(m).alias(n) for m, n in zip(GOLD_MEASURES, COUNTS)],
    )


def city_parts(parts: DataFrame, locations: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The partial means of coordinates as those of their cities, not yet merged.

    A city counts a coordinate once for each of its stations there. Parts are one row for a
    coordinate and hour, so what a shared coordinate gives is bounded by the cities' hours.
    """
    places = locations.groupBy("location_pk", *PLACE).agg(F.count(F.lit(1)).alias("_stations"))
    placed = parts.join(places, F.col("location_fk") == F.col("location_pk"))
    return placed.select(
        "measurement_time", *PLACE, *[(F.col(c) * F.col("_stations")).alias(c) for c in PARTS], *carry
    )


def merge_parts(parts: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Partial means of each city and hour; a city without rows at an hour has none."""
    merged = parts.groupBy("measurement_time", *PLACE, *carry).agg(*[F.sum(c).alias(c) for c in PARTS])
    return merged.filter("n_rows > 0")


def city_means(sums: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``city_hour`` from merged partial means."""
    means = sums.select(
        "measurement_time", *PLACE,
        *[F.try_divide(s, n).alias(m) for m, s, n in zip(GOLD_MEASURES, SUMS, COUNTS)],
        *carry,
    )
    return means.select("measurement_time", *PLACE, *GOLD_MEASURES, *index_columns(), *carry)


def city_day(hours: DataFrame) -> DataFrame:
    """Rounded mean of the hourly means of a city for each day, with the index of the means."""
    day = F.to_date("measurement_time").alias("measurement_date")
    means = rollup_avg(hours, [day, "country", "state", "city"], GOLD_MEASURES, rounded=True)
    return means.select("*", *index_columns())
