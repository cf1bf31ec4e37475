"""Landed JSON files: listing, scanning, and parsing into bronze columns."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.functions.text import parse_ts
from airstrata.operators.sizing import broadcast_if_small
from airstrata.schemas import AUDIT_COLUMNS, RECORDS

# Characters that make a path a pattern.
GLOB_MARKS = "*?[]{}\\"

# How every document is read, whatever its size: strict JSON, strings of any length.
STRICT_JSON = {"allowSingleQuotes": "false", "maxStringLen": str((1 << 31) - 1)}
DOCUMENT = (
    f"array<struct<total:string,version:string,records:{RECORDS.simpleString()}>>"
)


def landing_root(spark: SparkSession, path: str) -> str:
    """Qualified name of the folder that holds the landed files of ``path``.

    For a pattern it is the folder above the first part with a mark, for a file its folder; a
    relative name counts from the file system's working folder, whichever that is.
    """
    parts = path.rstrip("/").split("/")
    marked = next((i for i, part in enumerate(parts) if set(part) & set(GLOB_MARKS)), len(parts))
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path("/".join(parts[:marked]) or ("/" if path[0] == "/" else "."))
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = files.makeQualified(base)
    if files.exists(base) and files.getFileStatus(base).isFile():
        base = base.getParent()
    return base.toString().rstrip("/")


def escaped(path: str) -> str:
    """A file's own name where a pattern is expected."""
    return "".join(f"\\{c}" if c in GLOB_MARKS else c for c in path)


def file_inventory(
    spark: SparkSession, path: str, recursive: bool = False, modified_after: str | None = None
) -> DataFrame:
    """Name, modification time and size of every landed file; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select("path", "modificationTime", "length")


def landed_files(
    spark: SparkSession, path: str, recursive: bool = False, modified_after: str | None = None
) -> DataFrame:
    """Versions of landed files: name below ``landing_root``, time and size, by listing alone."""
    found = file_inventory(spark, path, recursive, modified_after)
    start = len(landing_root(spark, path)) + 2
    return found.select(
        F.expr(f"substr(path, {start})").alias("_stg_file_name"),
        zoneless(F.col("modificationTime")).alias("_stg_file_load_ts"),
        F.col("length").alias("_stg_file_length"),
    )


def _name_below(root: str) -> Column:
    """Path of a file below the landing folder; scheme and authority are left aside."""
    folder = f"{urlsplit(root).path}/"
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = F.locate(folder, full)
    below = F.substring(full, at + len(folder), F.length(full))
    return F.when(at > 0, below).otherwise(F.col("_metadata.file_name"))


def read_documents(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    line_delimited: bool = False,
    modified_after: str | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Text of each document with the name and time of its file.

    A file is one document, or one per line with ``line_delimited`` (such files are split
    among tasks). Compression follows the file extension. Names are paths below
    ``landing_root``. ``modified_after`` drops older files while listing, before anything is
    read; ``files`` names those to read, and nothing else is listed or opened.
    """
    text = file_text(
        spark, path, recursive, modified_after, files, wholetext=str(not line_delimited).lower()
    )
    return text.select("value", "file_name", "file_modification_time")


def file_text(
    spark: SparkSession,
    path: str,
    recursive: bool = False,
    modified_after: str | None = None,
    files: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Texts of files as the text source's ``options`` cut them, with name and time of the file.

    The metadata of the source can be selected as well.
    """
    reader = spark.read.format("text").options(**options)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    root = landing_root(spark, path)
    chosen = path if files is None else [escaped(f"{root}/{name}") for name in files]
    found = reader.option("recursiveFileLookup", recursive).load(chosen)
    return found.select(
        "value",
        _name_below(root).alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        "_metadata",
    )


def file_checksums(documents: DataFrame) -> DataFrame:
    """``(file_name, file_md5)``: one checksum for each file of ``documents`` by line.

    It is an MD5 over the number of lines and four sums of parts of their MD5s. Sums merge over
    the splits of a file, in tasks and between them, so a file of any size is read by many
    tasks. The value changes with any line, also with how often it stands there, but not with the
    order of the lines, which are documents of their own.
    """
    return documents.groupBy("file_name").agg(lines_md5("value").alias("file_md5"))


def lines_md5(text: str) -> Column:
    """Aggregate of the texts of a file that does not depend on their order."""
    digest = F.md5(text)
    parts = [
        F.sum(F.conv(F.substring(digest, at, 8), 16, 10).cast("long")).cast("string")
        for at in (1, 9, 17, 25)
    ]
    return F.md5(F.concat_ws(",", F.count(F.lit(1)).cast("string"), *parts))


def with_file_checksums(documents: DataFrame) -> DataFrame:
    """Documents by line with the checksum of their file, for which the files are read twice."""
    sums = broadcast_if_small(file_checksums(documents))
    return documents.join(sums, "file_name")


def zoneless(time: Column, dtype: T.DataType = T.TimestampType()) -> Column:
    """An instant as its UTC wall clock; zone-less times stay."""
    if isinstance(dtype, T.TimestampNTZType):
        return time
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(time), F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    )


def reject_reason(time: str, version: str, total: str, count: str) -> Column:
    """Why a well-formed document breaks the bronze constraints; NULL if it satisfies them."""
    bad_total = F.col(count).isNull() & F.col(total).isNotNull()
    return (
        F.when(F.col(time).isNull(), "no readable last_update in the first record")
        .when(F.col(version).isNull(), "no version")
        .when(bad_total, "total is no whole number")
    )


def parse_documents(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Bronze columns of each document, plus ``records``, ``document_md5``, ``value``,
    ``reject_reason`` and ``carry``.

    A text is accepted if it is exactly one object in strict JSON, whatever its size: text
    before or after it, single quotes or a missing end refuse it. Of a repeated key the last
    value counts. Every document takes the time of its first record; ``reject_reason`` is NULL
    for rows that satisfy the bronze constraints; a missing ``total`` takes the default 0.
    ``_stg_file_md5`` is the ``file_md5`` that documents by line bring along
    (``with_file_checksums``); else a document is its file, and has its checksum.
    ``json_data`` decides nothing; it is NULL where a variant can't hold the document.

    The values come out of a generator, which the optimizer does not copy into the filters and
    projections above, so a plan parses each document once.
    """
    alone = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    loaded = documents.schema["file_modification_time"].dataType

    def values(found: Column) -> Column:
        whole = F.coalesce(F.size(found) == 1, F.lit(False))
        document = F.when(whole, F.get(found, F.lit(0)))
        first = F.get(document["records"], F.lit(0))
        return F.struct(
            whole.alias("_whole"),
            parse_ts(first["last_update"]).alias("index_record_ts"),
            document["total"].alias("_total"),
            document["total"].try_cast("bigint").alias("_count"),
            document["version"].alias("json_version"),
            document["records"].alias("records"),
        )

    parsed = documents.select(
        "value",
        F.inline(F.transform(F.array(F.from_json(alone, DOCUMENT, STRICT_JSON)), values)),
        F.col("file_name").alias("_stg_file_name"),
        zoneless(F.col("file_modification_time"), loaded).alias("_stg_file_load_ts"),
        (F.col("file_md5") if "file_md5" in documents.columns else F.md5("value")).alias(
            "_stg_file_md5"
        ),
        F.md5("value").alias("document_md5"),
        zoneless(F.current_timestamp()).alias("_copy_data_ts"),
        *carry,
    )
    reason = F.when(~F.col("_whole"), "malformed JSON").otherwise(
        reject_reason("index_record_ts", "json_version", "_total", "_count")
    )
    return parsed.select(
        "value",
        "index_record_ts",
        F.try_parse_json("value").alias("json_data"),
        F.coalesce("_count", F.lit(0)).cast("long").alias("record_count"),
        "json_version",
        *AUDIT_COLUMNS,
        *carry,
        "records",
        "document_md5",
        reason.alias("reject_reason"),
    )


def inserted_documents(rows: DataFrame) -> DataFrame:
    """Rows that SQL users inserted, in the columns of ``parse_documents``.

    A row with NULL where bronze allows none is refused with a reason. Its records are those of
    ``json_data``; a row without a file name bears the name of the file that the insert wrote.
    """
    text = F.to_json("json_data")
    missing = [
        F.when(F.col(name).isNull(), f"no {name}")
        for name in ("index_record_ts", "json_data", "record_count", "json_version")
    ]
    own_name = F.concat(F.lit("insert/"), F.col("_metadata.file_name"))
    return rows.select(
        text.alias("value"),
        "index_record_ts",
        "json_data",
        "record_count",
        "json_version",
        F.coalesce("_stg_file_name", own_name).alias("_stg_file_name"),
        zoneless(F.coalesce("_stg_file_load_ts", "_metadata.file_modification_time")).alias(
            "_stg_file_load_ts"
        ),
        F.coalesce("_stg_file_md5", F.md5(text)).alias("_stg_file_md5"),
        zoneless(F.coalesce("_copy_data_ts", F.current_timestamp())).alias("_copy_data_ts"),
        F.try_variant_get("json_data", "$.records", RECORDS.simpleString()).alias("records"),
        F.md5(F.coalesce(text, F.lit(""))).alias("document_md5"),
        F.coalesce(*missing).alias("reject_reason"),
    )


# Bits of a row id for the partition and for the row in it; the load number lies above them.
PARTITION_BITS, ROW_BITS = 20, 22


def with_row_ids(df: DataFrame, load_number: int = 0) -> DataFrame:
    """Unique, increasing ``id``, above those of all lower load numbers; gaps occur.

    An id holds the load number, the partition and the row. A load beyond a million partitions
    or four million rows in one of them fails instead of repeating an id.
    """
    place = F.monotonically_increasing_id()
    partition, row = F.shiftrightunsigned(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (partition < 1 << PARTITION_BITS) & (row < 1 << ROW_BITS)
    packed = F.lit(load_number << (PARTITION_BITS + ROW_BITS)) + F.shiftleft(partition, ROW_BITS) + row
    too_many = F.raise_error(F.lit("too many rows in one load")).cast("long")
    return df.select(F.when(fits, packed + 1).otherwise(too_many).alias("id"), "*")
