"""Stored tables: one parquet folder per table below ``root/layer``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from airstrata import schemas
from airstrata.schemas import DATE_PARTITION

# Small jobs that run side by side.
AT_ONCE = 4

LAYERS = ("bronze", "silver", "gold", "consumption")


# Partition folder of rows without a date: the refused documents.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    layer: str
    schema: T.StructType
    partitions: tuple[str, ...] = (DATE_PARTITION,)


# Fixed table names of the model, except for the first four and those that make refreshes cheap:
# location_by_day, location_counts, location_hour and city_hour_sums. ``loads`` holds the newest
# load and those no refresh has covered, so it stays small however long the history.
TABLES = {
    "landed_documents": Table("bronze", schemas.LANDED, (DATE_PARTITION, "load_label")),
    "landed_files": Table("bronze", schemas.LANDED_FILES, ()),
    "loads": Table("bronze", schemas.LOADS, ("load_number",)),
    "coverage": Table("bronze", schemas.COVERAGE, ()),
    "curated_aqi_dt": Table("silver", schemas.LONG),
    "curated_flatten_aqi_dt": Table("silver", schemas.WIDE),
    "dim_date": Table("gold", schemas.DIM_DATE),
    "location_by_day": Table("gold", schemas.DIM_LOCATION),
    "location_counts": Table("gold", schemas.LOCATION_COUNTS, ()),
    "dim_location": Table("gold", schemas.DIM_LOCATION, ()),
    "fact_air_quality": Table("gold", schemas.FACT),
    "location_hour": Table("gold", schemas.LOCATION_HOUR),
    "city_hour_sums": Table("gold", schemas.CITY_HOUR_SUMS),
    "fact_city_agg_hour_level": Table("gold", schemas.CITY_HOUR),
    "fact_city_agg_day_level": Table("gold", schemas.CITY_DAY),
}


def _partition_type(name: str) -> T.DataType:
    return {DATE_PARTITION: T.DateType(), "load_number": T.LongType()}.get(name, T.StringType())


class Lake:
    """Tables below one root folder.

    ``landed_documents`` holds accepted and refused documents, so that a load scans the files
    once; ``raw_aqi`` and ``raw_aqi_rejects`` are its dated and undated partitions.

    ``on_bad='null'`` lets refreshes turn unreadable numbers into NULL instead of failing, and
    ``numeric`` compares readings as numbers.
    """

    def __init__(
        self, spark: SparkSession, root: str, on_bad: str = "raise", numeric: bool = False
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.on_bad = on_bad
        self.numeric = numeric

    def path(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].layer}/{name}"

    @property
    def inserts(self) -> str:
        """Folder of ``bronze.raw_aqi_inserts``, what SQL users insert into."""
        return f"{self.root}/bronze/raw_aqi_inserts"

    def create(self, *names: str) -> None:
        """Create the named tables empty (all by default), replacing what is there."""
        in_parallel(
            self.spark,
            lambda name: self.overwrite(name, self.spark.createDataFrame([], self.stored_schema(name))),
            names or TABLES,
        )

    def stored_schema(self, name: str) -> T.StructType:
        table = TABLES[name]
        extra = [T.StructField(p, _partition_type(p)) for p in table.partitions]
        return T.StructType(table.schema.fields + extra)

    def read(self, name: str, dates: Iterable[dt.date | None] | None = None) -> DataFrame:
        """The table with its partition columns, all of it or some dates (None: undated).

        With dates only their folders are listed, so the cost does not grow with the history.
        """
        reader = self.spark.read.schema(self.stored_schema(name))
        path = self.path(name)
        if dates is None:
            return reader.parquet(path)
        folders = ",".join(sorted({NO_DATE if d is None else str(d) for d in dates}))
        pattern = f"{path}/{DATE_PARTITION}={{{folders}}}"
        if not self._matches(pattern):
            return self.spark.createDataFrame([], self.stored_schema(name))
        return reader.option("basePath", path).parquet(pattern)

    def raw(self, dates: Iterable[dt.date] | None = None) -> DataFrame:
        """``raw_aqi`` with its partition columns and the records of each document."""
        landed = self.read("landed_documents", dates).filter(F.col(DATE_PARTITION).isNotNull())
        return landed.select(*schemas.RAW.names, "records", DATE_PARTITION, "load_label")

    def rejects(self) -> DataFrame:
        """``raw_aqi_rejects``: text, reason and provenance of the refused documents."""
        return self.read("landed_documents", [None]).select(
            "value", "reject_reason", *schemas.AUDIT_COLUMNS
        )

    def table(self, name: str) -> DataFrame:
        """The table with exactly the columns of the model."""
        if name == "raw_aqi":
            return self.raw().select(*schemas.RAW.names)
        return self.read(name).select(*TABLES[name].schema.names)

    def dated(self, name: str) -> DataFrame:
        """As ``table``, with the day partition: questions about a day then read that day only."""
        partition = [DATE_PARTITION] if DATE_PARTITION in TABLES[name].partitions else []
        return self.read(name).select(*TABLES[name].schema.names, *partition)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").partitionBy(*TABLES[name].partitions).parquet(self.path(name))

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace the whole table."""
        self._write(name, df, "static")

    def overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace the partitions that occur in ``df``; a repeated write changes nothing."""
        self._write(name, df, "dynamic")

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        partitions = TABLES[name].partitions
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(self.path(name))

    def empty_partition(self, name: str, date: dt.date) -> None:
        """Leave no rows for a date. Dynamic overwrite cannot: it skips dates without rows."""
        empty = self.spark.createDataFrame([], TABLES[name].schema)
        empty.write.mode("overwrite").parquet(f"{self.path(name)}/{DATE_PARTITION}={date}")

    def _folder(self, path: str) -> tuple:
        context = self.spark.sparkContext
        named = context._jvm.org.apache.hadoop.fs.Path(path)
        return named.getFileSystem(context._jsc.hadoopConfiguration()), named

    def _matches(self, pattern: str) -> bool:
        files, named = self._folder(pattern)
        return len(files.globStatus(named) or []) > 0

    def exists(self, path: str) -> bool:
        files, named = self._folder(path)
        return files.exists(named)

    def delete(self, path: str) -> None:
        files, named = self._folder(path)
        files.delete(named, True)

    def drop_loads(self, numbers: Iterable[int]) -> None:
        """Delete the steps of loads from ``loads``."""
        for number in numbers:
            self.delete(f"{self.path('loads')}/load_number={number}")

    def register(self) -> None:
        """Expose layers as schemas and tables as external tables to SQL users.

        Rows inserted into ``bronze.raw_aqi_inserts`` are taken over by ``load_inserted``.
        """
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
        for name, table in TABLES.items():
            full = f"{table.layer}.{name}"
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored_schema(name)
            )
            partitioned = f"PARTITIONED BY ({', '.join(table.partitions)})"
            self.spark.sql(f"DROP TABLE IF EXISTS {full}")
            self.spark.sql(
                f"CREATE TABLE {full} ({columns}) USING parquet "
                f"{partitioned if table.partitions else ''} LOCATION '{self.path(name)}'"
            )
            if table.partitions:
                self.spark.catalog.recoverPartitions(full)
        self.register_inserts("bronze.raw_aqi_inserts")
        for name, columns, dated in (
            ("raw_aqi", schemas.RAW.names, "IS NOT NULL"),
            ("raw_aqi_rejects", ["value", "reject_reason", *schemas.AUDIT_COLUMNS], "IS NULL"),
        ):
            self.spark.sql(
                f"CREATE OR REPLACE VIEW bronze.{name} AS SELECT {', '.join(columns)} "
                f"FROM bronze.landed_documents WHERE {DATE_PARTITION} {dated}"
            )

    def register_inserts(self, name: str) -> None:
        """The table that SQL users insert into, under a name of the session's catalog."""
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" DEFAULT {default}" if (default := schemas.INSERT_DEFAULTS.get(f.name)) else "")
            for f in schemas.INSERTS
        )
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{self.inserts}'")


def in_parallel(spark: SparkSession, job: Callable[[str], None], names: Iterable[str]) -> None:
    """Run a job for each name at once; each is small, and most of its time is not in tasks."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for _ in pool.map(inheritable_thread_target(spark)(job), names):
            pass


def spread_by_date(df: DataFrame) -> DataFrame:
    """Even write tasks: AQE merges small dates into one task and splits a large one.

    A plain repartition by date would put all rows of the largest date into one task.
    """
    return df.hint("rebalance", F.col(DATE_PARTITION))
