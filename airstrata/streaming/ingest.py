"""Loading landed files into bronze: as a batch, or continuously."""

from __future__ import annotations

import datetime as dt
import uuid
from itertools import batched

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airstrata.operators.dedup import not_yet_loaded
from airstrata.operators.sizing import broadcast_if_small
from airstrata.schemas import DATE_PARTITION, INSERTS, LANDED, LANDED_FILES
from airstrata.sources import listing
from airstrata.sources.documents import (
    escaped,
    inserted_documents,
    landed_files,
    landing_root,
    parse_documents,
    read_documents,
    with_file_checksums,
    with_row_ids,
)
from airstrata.sources.lake import Lake
from airstrata.streaming.compaction import finish_compaction
from airstrata.streaming.loads import begin_load, close_cut_loads, cut_loads, finish_load
from airstrata.streaming.refresh import refresh_pending

# A version of a file. One put back to earlier content has another time, so it is loaded again
# and wins.
FILE_IDENTITY = LANDED_FILES.names
DOCUMENT_IDENTITY = ["_stg_file_name", "_stg_file_load_ts", "document_md5"]
# Files of one load, whose names the driver holds.
FILES_PER_LOAD = 10_000


def load_documents(lake: Lake, documents: DataFrame, label: str) -> set[dt.date]:
    """Append documents under ``label`` and return the dates they touch.

    The documents are those of files no load has recorded. Repeating a label replaces its own
    rows, and documents that a load has left behind which was cut short are not written again,
    so a retried load leaves no duplicates. Documents that break a constraint of bronze are
    stored without a date, as rejects, and with their text. Ids come from the number of the
    load, so no earlier one is read; dates and arrivals are observed by the write itself.
    """
    return _load_parsed(lake, parse_documents(documents), label)


def _load_parsed(lake: Lake, parsed: DataFrame, label: str) -> set[dt.date]:
    refused = F.col("reject_reason").isNotNull()
    fresh = parsed.withColumns(
        {
            DATE_PARTITION: F.when(~refused, F.to_date("index_record_ts")),
            "value": F.when(refused, F.col("value")),
        }
    )
    left_behind = set(cut_loads(lake).values()) - {label}
    if left_behind:
        written = lake.read("landed_documents").filter(F.col("load_label").isin(sorted(left_behind)))
        known = broadcast_if_small(written.select(*DOCUMENT_IDENTITY).distinct())
        fresh = fresh.join(known, DOCUMENT_IDENTITY, "left_anti")
    number = begin_load(lake, label)
    landed = with_row_ids(fresh, number).withColumn("load_label", F.lit(label))
    seen = Observation()
    landed = landed.select(*LANDED.names, DATE_PARTITION, "load_label").observe(
        seen,
        F.collect_set(DATE_PARTITION).alias("dates"),
        F.min("_stg_file_load_ts").alias("first"),
        F.max("_stg_file_load_ts").alias("last"),
    )
    lake.overwrite_partitions("landed_documents", landed)
    touched = set(seen.get["dates"])
    finish_load(lake, number, label, touched, (seen.get["first"], seen.get["last"]))
    return touched


def new_files(
    lake: Lake, landing: str, recursive: bool = False, modified_after: str | None = None
) -> DataFrame:
    """Versions of landed files that no load has recorded: a difference of listings.

    No file is opened. A file is new if its name below the landing folder, its time or its size
    is; a file that was renamed is new as well.
    """
    arrived = landed_files(lake.spark, landing, recursive, modified_after)
    known = lake.table("landed_files").select(*FILE_IDENTITY)
    arrived = arrived.select(*FILE_IDENTITY)
    return not_yet_loaded(arrived, broadcast_if_small(known, settle=False), FILE_IDENTITY)


def load_new_files(
    lake: Lake,
    landing: str,
    recursive: bool = False,
    line_delimited: bool = False,
    modified_after: str | None = None,
    max_files: int = FILES_PER_LOAD,
) -> set[dt.date]:
    """Load the new files, oldest first, in loads of at most ``max_files``.

    A load records its files when their documents are written, so one that dies is repeated.
    """
    finish_compaction(lake)
    cut = cut_loads(lake)
    new = new_files(lake, landing, recursive, modified_after)
    dates: set[dt.date] = set()
    for files in batched(new.orderBy("_stg_file_load_ts", "_stg_file_name").toLocalIterator(), max_files):
        names = [row["_stg_file_name"] for row in files]
        documents = read_documents(
            lake.spark, landing, line_delimited=line_delimited, files=names
        )
        if line_delimited:
            documents = with_file_checksums(documents)
        dates |= load_documents(lake, documents, f"load-{uuid.uuid4().hex}")
        lake.append("landed_files", lake.spark.createDataFrame(files, LANDED_FILES).coalesce(1))
    close_cut_loads(lake, cut)
    return dates


def load_inserted(
    lake: Lake, refresh: bool = True, max_files: int = FILES_PER_LOAD
) -> set[dt.date]:
    """Take over what SQL users inserted into ``bronze.raw_aqi_inserts`` since the last call.

    Returns the touched dates. What is new is the files of inserts that no load has recorded,
    so each row is taken once and an insert that runs meanwhile waits for the next call. Rows
    that break a constraint of bronze go to the rejects with a reason. An inserted document
    competes for its hour by its load time, as the file of that time would.
    """
    finish_compaction(lake)
    cut = cut_loads(lake)
    dates: set[dt.date] = set()
    new = new_files(lake, lake.inserts).orderBy(*FILE_IDENTITY) if lake.exists(lake.inserts) else None
    for files in batched(new.toLocalIterator() if new is not None else (), max_files):
        paths = [escaped(f"{lake.inserts}/{row['_stg_file_name']}") for row in files]
        rows = lake.spark.read.schema(INSERTS).parquet(*paths)
        dates |= _load_parsed(lake, inserted_documents(rows), f"load-{uuid.uuid4().hex}")
        lake.append("landed_files", lake.spark.createDataFrame(files, LANDED_FILES).coalesce(1))
    close_cut_loads(lake, cut)
    if refresh:
        refresh_pending(lake)
    return dates


def load_batch(
    lake: Lake,
    landing: str,
    recursive: bool = False,
    line_delimited: bool = False,
    modified_after: str | None = None,
    refresh: bool = True,
    max_files: int = FILES_PER_LOAD,
) -> set[dt.date]:
    """Load what the landing folder holds beyond the files already loaded.

    Also serves as backfill. Returns the touched dates; with ``refresh`` the derived tables
    are brought up to date, also for loads whose refresh was skipped or cut short. A call
    lists the folder and opens new files only; ``modified_after`` shortens the listing.
    """
    dates = load_new_files(lake, landing, recursive, line_delimited, modified_after, max_files)
    if refresh:
        refresh_pending(lake)
    return dates


def start_ingest(
    lake: Lake,
    landing: str,
    checkpoint: str,
    every: str | None = None,
    recursive: bool = False,
    line_delimited: bool = False,
    max_files: int = FILES_PER_LOAD,
    refresh: bool = True,
) -> StreamingQuery:
    """Load files as they arrive or are rewritten, each version once, and refresh their dates.

    ``every`` is the freshness target, such as ``'30 minutes'``; without it the query takes
    what is there and stops. A micro-batch runs when the listing below the landing folder has
    changed (``LandingListing``) and loads what is new by the history, as ``load_batch`` does;
    so a repeated batch, a restart or a new checkpoint loads nothing twice. Loads whose
    refresh is pending are refreshed at the start, whether or not files arrive.
    """
    spark = lake.spark
    if refresh:
        refresh_pending(lake)

    def take(batch: DataFrame, batch_id: int) -> None:
        load_new_files(lake, landing, recursive, line_delimited, max_files=max_files)
        if refresh:
            refresh_pending(lake)

    spark.dataSource.register(listing.LandingListing)
    changes = spark.readStream.format(listing.NAME).load(landing_root(spark, landing))
    writer = changes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
