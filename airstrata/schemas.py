"""Fixed names and column contracts shared by every layer.

The pollutant codes, column names and table names below are fixed values: queries
written against the original model depend on them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Pollutant(NamedTuple):
    code: str  # value of pollutant_id in the source documents
    column: str  # measure column in the wide tables
    label: str  # name reported as prominent pollutant


# Fixed values; the order is the tie-break order of the prominent pollutant.
POLLUTANTS = (
    Pollutant("PM2.5", "pm25_avg", "PM25"),
    Pollutant("PM10", "pm10_avg", "PM10"),
    Pollutant("SO2", "so2_avg", "SO2"),
    Pollutant("NO2", "no2_avg", "NO2"),
    Pollutant("NH3", "nh3_avg", "NH3"),
    Pollutant("CO", "co_avg", "CO"),
    Pollutant("OZONE", "o3_avg", "O3"),
)
MEASURES = tuple(p.column for p in POLLUTANTS)
LABELS = tuple(p.label for p in POLLUTANTS)
# The gold tables list PM10 before PM2.5.
GOLD_MEASURES = ("pm10_avg", "pm25_avg", "so2_avg", "no2_avg", "nh3_avg", "co_avg", "o3_avg")

STATION_KEYS = ("country", "state", "city", "station", "latitude", "longitude")
READING_KEYS = ("index_record_ts",) + STATION_KEYS
LOCATION_COLUMNS = ("latitude", "longitude", "country", "state", "city", "station")
AUDIT_COLUMNS = ("_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts")

# Text leaves of one element of the document's "records" array.
RECORD_FIELDS = (
    "country",
    "state",
    "city",
    "station",
    "latitude",
    "longitude",
    "pollutant_id",
    "pollutant_max",
    "pollutant_min",
    "pollutant_avg",
)

# Day partition of every stored table that carries a time; never part of a query result.
DATE_PARTITION = "index_date"

COORDINATE = T.DecimalType(12, 7)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, *rest) for name, dtype, *rest in fields])


def _strings(*names: str) -> list[tuple]:
    return [(n, T.StringType()) for n in names]


def _doubles(names: tuple[str, ...]) -> list[tuple]:
    return [(n, T.DoubleType()) for n in names]


_AUDIT = [
    ("_stg_file_name", T.StringType()),
    ("_stg_file_load_ts", T.TimestampNTZType()),
    ("_stg_file_md5", T.StringType()),
    ("_copy_data_ts", T.TimestampNTZType()),
]
_COORDINATES = [("latitude", COORDINATE), ("longitude", COORDINATE)]
_INDEX = [("prominent_pollutant", T.StringType()), ("aqi", T.DoubleType())]

RAW = _struct(
    ("id", T.LongType(), False),
    ("index_record_ts", T.TimestampNTZType(), False),
    ("json_data", T.VariantType()),
    ("record_count", T.LongType(), False),
    ("json_version", T.StringType(), False),
    *_AUDIT,
)

RECORDS = T.ArrayType(
    T.StructType([T.StructField(f, T.StringType()) for f in (*RECORD_FIELDS, "last_update")])
)

# What a load stores: accepted documents with their records, refused ones with text and reason.
LANDED = T.StructType(
    [T.StructField(f.name, f.dataType) for f in RAW]
    + [
        T.StructField("records", RECORDS),
        T.StructField("document_md5", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)

# What SQL users insert into, and what Spark fills in where an insert leaves a column out. NOT
# NULL is checked when rows are taken over, since parquet tables accept NULL.
INSERTS = _struct(
    ("index_record_ts", T.TimestampNTZType()),
    ("json_data", T.VariantType()),
    ("record_count", T.LongType()),
    ("json_version", T.StringType()),
    ("_stg_file_name", T.StringType()),
    ("_stg_file_load_ts", T.TimestampType()),
    ("_stg_file_md5", T.StringType()),
    ("_copy_data_ts", T.TimestampType()),
)
INSERT_DEFAULTS = {
    "record_count": "0",
    "_stg_file_load_ts": "current_timestamp()",
    "_copy_data_ts": "current_timestamp()",
}

# Versions of the files that loads have read; what is listed here is not opened again.
LANDED_FILES = _struct(
    ("_stg_file_name", T.StringType()),
    ("_stg_file_load_ts", T.TimestampNTZType()),
    ("_stg_file_length", T.LongType()),
)

# Steps of a load, in the partition of its number. A loaded step stands for one touched date. The
# arrivals are the times of the load's oldest and newest file.
LOADS = _struct(
    ("load_label", T.StringType()),
    ("step", T.StringType()),
    ("touched_date", T.DateType()),
    ("first_arrival", T.TimestampNTZType()),
    ("last_arrival", T.TimestampNTZType()),
)

# For each derived table the newest load it covers and the newest arrival among these loads.
COVERAGE = _struct(
    ("table_name", T.StringType()),
    ("load_number", T.LongType()),
    ("covered_until", T.TimestampNTZType()),
)

LONG = _struct(
    ("index_record_ts", T.TimestampNTZType()),
    *_strings("country", "state", "city", "station"),
    *_COORDINATES,
    *_strings("pollutant_id", "pollutant_max", "pollutant_min", "pollutant_avg"),
    *_AUDIT,
)

WIDE = _struct(
    ("index_record_ts", T.TimestampNTZType()),
    *_strings("country", "state", "city", "station"),
    *_COORDINATES,
    *_doubles(MEASURES),
)

DIM_DATE = _struct(
    ("date_pk", T.LongType()),
    ("measurement_time", T.TimestampNTZType()),
    *[(f"aqi_{part}", T.IntegerType()) for part in ("year", "month", "quarter", "day", "hour")],
)

DIM_LOCATION = _struct(
    ("location_pk", T.LongType()), *_COORDINATES, *_strings("country", "state", "city", "station")
)

# On how many days a station is on record.
LOCATION_COUNTS = T.StructType([*DIM_LOCATION.fields, T.StructField("n_days", T.LongType())])

# Mergeable means: rows, and for each measure the sum and the number of its values.
SUMS = tuple(f"sum_{m}" for m in GOLD_MEASURES)
COUNTS = tuple(f"n_{m}" for m in GOLD_MEASURES)
_PARTIAL = [("n_rows", T.LongType()), *_doubles(SUMS), *[(n, T.LongType()) for n in COUNTS]]

LOCATION_HOUR = _struct(
    ("location_fk", T.LongType()), ("measurement_time", T.TimestampNTZType()), *_PARTIAL
)
CITY_HOUR_SUMS = _struct(
    ("measurement_time", T.TimestampNTZType()), *_strings("country", "state", "city"), *_PARTIAL
)

FACT = _struct(
    ("aqi_pk", T.LongType()),
    ("date_fk", T.LongType()),
    ("location_fk", T.LongType()),
    *_doubles(GOLD_MEASURES),
    *_INDEX,
)

CITY_HOUR = _struct(
    ("measurement_time", T.TimestampNTZType()),
    *_strings("country", "state", "city"),
    *_doubles(GOLD_MEASURES),
    *_INDEX,
)

CITY_DAY = _struct(
    ("measurement_date", T.DateType()),
    *_strings("country", "state", "city"),
    *_doubles(GOLD_MEASURES),
    *_INDEX,
)
