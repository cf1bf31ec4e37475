"""Merging the small files that many loads leave behind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.operators.sizing import broadcast_if_small
from airstrata.schemas import DATE_PARTITION
from airstrata.session import stored
from airstrata.sources.lake import NO_DATE, Lake, spread_by_date
from airstrata.streaming.loads import pending_loads

# What a load left of a day is merged below this size, once a day has so many of them.
TARGET_BYTES = 128 << 20
MOST_PARTS = 8
TABLE = "landed_documents"


def _staging(lake: Lake, name: str = "") -> str:
    return f"{lake.root}/_compaction/{name}".rstrip("/")


def parts_of_days(lake: Lake) -> DataFrame:
    """``(day, label, n_files, n_bytes)`` of bronze, by listing its files.

    ``day`` is the name of the partition's folder, also for undated documents.
    """
    files = (
        lake.spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(lake.path(TABLE))
    )
    folder = rf"/{DATE_PARTITION}=([^/]+)/load_label=([^/]+)/"
    return (
        files.select(
            F.regexp_extract("path", folder, 1).alias("day"),
            F.regexp_extract("path", folder, 2).alias("label"),
            "length",
        )
        .filter("day != ''")
        .groupBy("day", "label")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    )


def compact(lake: Lake, target_bytes: int = TARGET_BYTES, most_parts: int = MOST_PARTS) -> int:
    """Merge what loads have left of a day where it is small; returns how many parts were merged.

    A day with more than ``most_parts`` files in parts of less than ``target_bytes`` gets these
    merged into one part, in files of the session's advisory partition size. Larger parts stay,
    so a document is rewritten until its part has the target size and no more. Loads that were
    cut short or await a refresh keep their parts. Ids and all other columns stay; only the
    label of the load becomes that of the merge. The list of loaded files is rewritten as a
    whole.

    The merged rows are staged, then the parts they replace are listed, and only then is
    anything replaced; a run that dies is completed or undone by the next, or by the next load.
    Until it is, readers may see rows of both. Loads must not run meanwhile.
    """
    finish_compaction(lake)
    open_labels, _ = pending_loads(lake)
    small = parts_of_days(lake).filter(
        (F.col("n_bytes") < target_bytes) & ~F.col("label").isin(sorted(open_labels))
    )
    days = small.groupBy("day").agg(F.sum("n_files").alias("n")).filter(F.col("n") > most_parts)
    chosen = stored(small.join(days, "day", "left_semi").select("day", "label"), "parts")
    n_parts = chosen.count()
    if not n_parts:
        return 0
    landed = lake.read(TABLE)
    day = F.coalesce(F.col(DATE_PARTITION).cast("string"), F.lit(NO_DATE))
    here = (day == F.col("day")) & (F.col("load_label") == F.col("label"))
    merged = landed.join(broadcast_if_small(chosen, settle=False), here, "left_semi").withColumn(
        "load_label", F.lit(f"merged-{uuid.uuid4().hex}")
    )
    spread_by_date(merged).write.parquet(_staging(lake, "rows"))
    lake.table("landed_files").coalesce(1).write.parquet(_staging(lake, "files"))
    chosen.coalesce(1).write.parquet(_staging(lake, "parts"))
    finish_compaction(lake)
    return n_parts


def finish_compaction(lake: Lake) -> None:
    """Put staged rows in the place of the parts listed with them; every step can be repeated."""
    if not lake.exists(_staging(lake, "parts/_SUCCESS")):
        lake.delete(_staging(lake))
        return
    rows = lake.spark.read.schema(lake.stored_schema(TABLE)).parquet(_staging(lake, "rows"))
    lake.overwrite_partitions(TABLE, spread_by_date(rows))
    files = lake.spark.read.schema(lake.stored_schema("landed_files"))
    lake.overwrite("landed_files", files.parquet(_staging(lake, "files")).coalesce(1))
    parts = lake.spark.read.schema("day string, label string").parquet(_staging(lake, "parts"))
    for part in parts.toLocalIterator():
        lake.delete(f"{lake.path(TABLE)}/{DATE_PARTITION}={part['day']}/load_label={part['label']}")
    lake.delete(_staging(lake))
