"""Documents of any size: one JSON document read by many tasks, cut behind each record."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.functions.text import parse_ts
from airstrata.operators.sizing import broadcast_if_small
from airstrata.schemas import AUDIT_COLUMNS, RECORD_FIELDS, RECORDS
from airstrata.session import ensure_checkpoint_dir
from airstrata.sources.documents import (
    DOCUMENT,
    STRICT_JSON,
    file_text,
    lines_md5,
    parse_documents,
    read_documents,
    reject_reason,
    zoneless,
)

# A text of this many bytes or more is no value of a row.
ROW_LIMIT = (1 << 31) - 1024
TOO_LARGE = "too large for a row, and not cut at its records"

# JSON's white space, and how the texts between two closing braces begin.
WS = r"[ \t\r\n]*"
HEAD = rf'^({WS}\{{[^{{]*"records"{WS}:{WS}\[){WS}(\{{[\s\S]*)$'
RECORD = rf"^{WS},{WS}(\{{[\s\S]*)$"
TAIL = rf"^{WS}\]"
BLANK = rf"^{WS}$"


class SplitDocuments(NamedTuple):
    """``documents``: a row per file, with bronze columns, ``reject_reason`` and ``was_split``.
    ``records``: the records of accepted files, with time and provenance of their file."""

    documents: DataFrame
    records: DataFrame


def split_documents(
    spark: SparkSession, path: str, recursive: bool = False, files: Sequence[str] | None = None
) -> SplitDocuments:
    """Read files of one document each, whatever their size, without holding one in a row.

    Spark's text source cuts files at a separator, here the closing brace, so the blocks of one
    file go to many tasks and each text is a record. A file counts as cut at its records if its
    first text opens the document and the ``records`` array, each further one is a comma and one
    object in strict JSON, one closes the array and the document, at most white space
    follows, and head and end alone are a document. Then the whole is strict JSON too.

    Others (a brace in a text, objects outside ``records`` or within a record, no records,
    compression, what is not JSON at all) are read again as one row each by ``parse_documents``,
    which decides on them. Only their names pass the driver. One that no row can hold is
    refused with a reason. Rules and results are those of ``parse_documents``; a file that was cut
    has a checksum over its texts that does not change with their order. The scan runs
    twice: to decide on files, and when records are read.
    """
    texts = _texts(spark, path, recursive, files)
    ensure_checkpoint_dir(spark)
    found = _judged(texts).checkpoint()
    cut = found.filter("was_split")
    odd = found.filter(f"not was_split and size < {ROW_LIMIT}").select("file_name")
    names = [row["file_name"] for row in odd.toLocalIterator()]
    whole = parse_documents(read_documents(spark, path, recursive, files=names)) if names else None
    held = F.when(F.col("was_split"), F.col("reason")).otherwise(F.lit(TOO_LARGE))
    documents = found.filter(f"was_split or size >= {ROW_LIMIT}").select(
        "index_record_ts",
        F.coalesce("count", F.lit(0)).cast("long").alias("record_count"),
        "json_version",
        *AUDIT_COLUMNS,
        held.alias("reject_reason"),
        "was_split",
    )
    accepted = cut.filter(F.col("reason").isNull())
    of_file = broadcast_if_small(
        accepted.select(
            "file_name", "file_modification_time", "index_record_ts", *AUDIT_COLUMNS
        ),
        settle=False,
    )
    records = (
        texts.filter(F.col("opens") | F.col("continues"))
        .select("file_name", "file_modification_time", F.inline("parsed"))
        .join(of_file, ["file_name", "file_modification_time"])
        .select("index_record_ts", *RECORD_FIELDS, *AUDIT_COLUMNS)
    )
    if whole is not None:
        alone = whole.withColumn("was_split", F.lit(False))
        documents = documents.unionByName(alone.select(documents.columns))
        good = whole.filter(F.col("reject_reason").isNull())
        flat = good.select("index_record_ts", *AUDIT_COLUMNS, F.inline("records"))
        records = records.unionByName(flat.select(records.columns))
    return SplitDocuments(documents, records)


def _texts(
    spark: SparkSession, path: str, recursive: bool, files: Sequence[str] | None
) -> DataFrame:
    """The texts between closing braces, with their place, kind and parsed record."""
    read = file_text(spark, path, recursive, files=files, lineSep="}")
    # Texts of a block are numbered in the order in which they stand there.
    placed = read.select(
        "value",
        "file_name",
        "file_modification_time",
        F.col("_metadata.file_size").alias("size"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("text"),
        ).alias("place"),
    )
    value = F.col("value")
    opens, continues = value.rlike(HEAD), value.rlike(RECORD)
    body = F.when(opens, F.regexp_extract(value, HEAD, 2)).when(
        continues, F.regexp_extract(value, RECORD, 1)
    )
    one = F.concat(F.lit("["), body, F.lit("}]"))
    return placed.select(
        "*",
        opens.alias("opens"),
        continues.alias("continues"),
        value.rlike(TAIL).alias("closes"),
        value.rlike(BLANK).alias("blank"),
        F.from_json(one, RECORDS.simpleString(), STRICT_JSON).alias("parsed"),
    )


def _judged(texts: DataFrame) -> DataFrame:
    """One row per file: whether it is cut at its records, and its bronze columns."""
    opens, closes, blank = F.col("opens"), F.col("closes"), F.col("blank")
    one_record = F.coalesce(F.size("parsed") == 1, F.lit(False))
    record = opens | F.col("continues")
    place = F.col("place")

    files = texts.groupBy("file_name", "file_modification_time", "size").agg(
        F.count_if(opens).alias("n_opens"),
        F.count_if(closes).alias("n_closes"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(~F.when(record, one_record).otherwise(closes | blank)).alias("n_odd"),
        # Braces between the texts count as well: it tells a file that ends without its last one.
        (F.sum(F.octet_length("value").cast("long") + 1) - F.count_if(blank)).alias("n_bytes"),
        F.min(place).alias("first"),
        F.min(F.when(opens, place)).alias("opened"),
        F.max(F.when(record, place)).alias("last_record"),
        F.min(F.when(closes, place)).alias("closed"),
        F.min(F.when(blank, place)).alias("blank_at"),
        F.max(F.when(opens, F.regexp_extract("value", HEAD, 1))).alias("head"),
        F.max(F.when(closes, F.col("value"))).alias("end"),
        F.max(F.when(opens, F.get("parsed", F.lit(0))["last_update"])).alias("last_update"),
        lines_md5("value").alias("_stg_file_md5"),
    )
    in_order = (
        (F.col("first") == F.col("opened"))
        & (F.col("last_record") < F.col("closed"))
        & F.coalesce(F.col("closed") < F.col("blank_at"), F.lit(True))
    )
    # A second array of records, spelled in any way, is for the parser of whole documents.
    plain_end = ~F.col("end").rlike(r"records|\\u")
    frame = F.from_json(
        F.concat(F.lit("["), "head", "end", F.lit("}]")), DOCUMENT, STRICT_JSON
    )
    was_split = (
        (F.col("n_opens") == 1)
        & (F.col("n_closes") == 1)
        & (F.col("n_blank") <= 1)
        & (F.col("n_odd") == 0)
        & (F.col("n_bytes") == F.col("size"))
        & in_order
        & plain_end
        & (F.size("frame") == 1)
    )
    document = F.get("frame", F.lit(0))
    judged = files.withColumn("frame", frame).select(
        "file_name",
        "file_modification_time",
        "size",
        F.coalesce(was_split, F.lit(False)).alias("was_split"),
        parse_ts("last_update").alias("index_record_ts"),
        document["total"].alias("total"),
        document["total"].try_cast("bigint").alias("count"),
        document["version"].alias("json_version"),
        F.col("file_name").alias("_stg_file_name"),
        zoneless(F.col("file_modification_time")).alias("_stg_file_load_ts"),
        "_stg_file_md5",
        zoneless(F.current_timestamp()).alias("_copy_data_ts"),
    )
    return judged.withColumn(
        "reason", reject_reason("index_record_ts", "json_version", "total", "count")
    )
