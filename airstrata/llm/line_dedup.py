"""Removal of lines that many documents share, by levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm.common import BLANKS, lower_ascii, others, unused
from airstrata.operators.skew import heavy_keys, spread_join
from airstrata.session import ensure_checkpoint_dir, stored

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FANOUT = 3
HASH = ["line_hash", "line_check"]


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(key: Column) -> Column:
    """96 bits of hash that stand for a line's key."""
    return F.struct(F.xxhash64(key).alias(HASH[0]), F.hash(key).alias(HASH[1]))


class LineRuns:
    """Sorted runs of line hashes on levels, in a folder.

    A run has a row for each hash: the documents that hold the line, and the largest of their
    ids. Every batch adds a run to level 0; as soon as a level has ``fanout`` runs, they are
    merged into one run of the next level. So each hash is rewritten once a level, and what
    a lookup reads is a few runs.

    The runs are partitions of one table, bucketed by hash into the session's number of shuffle
    partitions and sorted within. A bucket of a batch meets the same bucket of every run, so
    neither a lookup nor a merge moves the runs' rows again. With ``enough`` given, a batch is
    merge-anti-joined with the runs and adds only lines that are not yet in that many documents.
    Such batches must come in falling order of ids, which leaves the ids of the lines found
    earlier final.
    """

    def __init__(
        self, spark: SparkSession, folder: str, fanout: int = FANOUT, enough: int | None = None
    ):
        self.spark, self.folder, self.fanout, self.enough = spark, folder, fanout, enough
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[int]] = []
        self.written = 0

    def add(self, lines: DataFrame) -> None:
        """A run of a batch of ``(doc_id, line_hash, line_check)``, one row a document and line."""
        run = lines.groupBy(*HASH).agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")
        )
        if self.enough is not None and self.levels:
            known = self.merged().filter(F.col("n_docs") >= self.enough).select(*HASH)
            run = run.join(known.hint("merge"), HASH, "left_anti")
        self._place(run, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        number, self.written = self.written, self.written + 1
        rows = run.withColumn("run", F.lit(number)).write.format("parquet").mode("append")
        rows = rows.option("path", self.folder).partitionBy("run")
        rows.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(self.table)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(number)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._place(self._merge(full), level + 1)

    def _merge(self, runs: list[int]) -> DataFrame:
        rows = self.spark.table(self.table).filter(F.col("run").isin(runs))
        return rows.groupBy(*HASH).agg(
            F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")
        )

    def merged(self) -> DataFrame:
        """All runs as one: ``(line_hash, line_check, n_docs, last_doc)``."""
        return self._merge([run for level in self.levels for run in level])

    def forget(self) -> None:
        """Take the runs' table out of the catalog; its files go with the working folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.levels = []


def falling_batches(docs: DataFrame, batches: int) -> Column:
    """A number from 0 for each row: ranges of doc_id of about one size, the largest ids first.

    Rows without an id come last.
    """
    shares = [1 - i / batches for i in range(1, batches)]
    borders = []
    if shares:
        borders = docs.agg(F.percentile_approx("doc_id", shares).alias("b")).first()["b"] or []
    below = [F.when(F.col("doc_id") >= border, 0).otherwise(1) for border in borders]
    return reduce(Column.__add__, below, F.lit(0))


def line_places(text: Column, min_length: int) -> Column:
    """Array of ``(line_hash, line_check, place, first)`` for the long lines of a text.

    ``place`` is the line's number from 0; of lines with the same key, one is ``first``. Sorting
    brings them together, so the work does not grow with the square of the lines.
    """
    keyed = F.transform(
        lines_of(text), lambda line, i: F.struct(line_key(line).alias("key"), i.alias("place"))
    )
    long_ones = F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_length)
    hashed = F.transform(long_ones, lambda x: F.struct(line_hash(x["key"]).alias("h"), x["place"].alias("place")))

    def marked(rows: Column) -> Column:
        return F.transform(
            rows,
            lambda x, i: F.struct(
                x["h"][HASH[0]].alias(HASH[0]),
                x["h"][HASH[1]].alias(HASH[1]),
                x["place"].alias("place"),
                ((i == 0) | (F.get(rows, i - 1)["h"] != x["h"])).alias("first"),
            ),
        )

    # Sorted once, as the single element of an array, and looked up in place.
    return F.flatten(F.transform(F.array(F.sort_array(hashed)), marked))


def dedup_lines(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    names: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with ``text`` rid of shared lines, and the numbers of lines and of dropped ones.

    A line whose key (``line_key``) has at least ``min_length`` code points and stands in at
    least ``min_documents`` rows goes from all of them but those with the largest doc_id that
    holds it; where only rows without a doc_id hold it, it stays. Other lines stay, blank ones
    too, and are joined by ``\\n``. NULL text is one empty line and becomes an empty text.
    Repeated rows count each and fare alike. An empty table gives no rows. Further columns of
    ``docs`` stay as they are, whatever their names, but for columns called ``names``, as the
    new ones are, which these replace.

    ``doc_id`` is a number.

    The narrow lines are cut into batches of falling ids, and each batch adds its sorted run of
    the lines that the runs before do not settle (``LineRuns``). The runs are then merged and
    meet the lines; the places of what is to go are gathered for each document and meet the texts
    in one join. A line in a third of all documents is one row in each run that holds it
    and is spread over documents again by a join in pieces. The work on one document grows
    with its lines and their sort.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    # Rows of one doc_id with different texts have different places.
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    lines = docs.select(
        "doc_id",
        digest.alias("digest"),
        falling_batches(docs, batches).alias("batch"),
        F.inline(line_places(F.col("text"), min_length)),
    )
    lines.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{folder}/lines")
    runs = LineRuns(spark, f"{folder}/runs", fanout, min_documents)
    for number in range(batches):
        runs.add(lines.filter((F.col("batch") == number) & F.col("first")))
    shared = runs.merged().filter(F.col("n_docs") >= min_documents).drop("n_docs")
    # Only lines of several documents; what the result rests on is written, the runs can go.
    shared = stored(shared, "shared-lines")
    runs.forget()
    goes = F.col("last_doc").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("last_doc"))
    id_name, digest_name, gone_name, kept_name, text_name, lines_name, less_name = unused(
        [*docs.columns, *names],
        "dropped_id", "dropped_digest", "dropped", "kept", "kept_text", "all_lines", "fewer_lines",
    )
    # A common line stands in many documents: its rows are dealt into pieces before the shuffle.
    shared = shared.withColumnsRenamed({name: f"shared_{name}" for name in HASH})
    agree = F.col(HASH[1]) == F.col(f"shared_{HASH[1]}")
    heavy = heavy_keys(lines, HASH[0])
    dropped = (
        spread_join(lines, shared, HASH[0], f"shared_{HASH[0]}", heavy, also=agree)
        .filter(goes)
        .groupBy(F.col("doc_id").alias(id_name), F.col("digest").alias(digest_name))
        .agg(F.collect_set("place").alias(gone_name))
    )
    same_row = docs["doc_id"].eqNullSafe(F.col(id_name)) & (digest == F.col(digest_name))
    joined = docs.join(dropped, same_row, "left")
    rows = lines_of(F.col("text"))
    # Set difference of numbers, by hashing and in order.
    places = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), F.col(gone_name))
    some = F.flatten(F.transform(F.array(rows), lambda r: F.transform(places, lambda i: F.get(r, i))))
    kept = F.when(F.col(gone_name).isNull(), rows).otherwise(some)
    told = F.struct(
        F.array_join(kept_name, "\n").alias(text_name),
        F.size(rows).cast("long").alias(lines_name),
        (F.size(rows) - F.size(kept_name)).cast("long").alias(less_name),
    )
    stay = others(docs.columns, *names)
    # A generator keeps the optimizer from copying this work into later filters and functions.
    done = joined.withColumn(kept_name, kept).select(
        *[docs[c] for c in stay if c != "text"], F.inline(F.array(told))
    )
    return done.select(
        *[F.col(text_name).alias("text") if c == "text" else done[c] for c in stay],
        F.col(lines_name).alias(names[0]),
        F.col(less_name).alias(names[1]),
    )
