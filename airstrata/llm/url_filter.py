"""URL verdicts by a sorted sweep over reversed hosts."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.llm.common import lower_ascii

# Rows sampled to place the borders of the sweep, and URLs aimed at between two borders.
SAMPLE_ROWS = 50_000
RANGE_ROWS = 5_000
DEFAULT_VERDICT = "allow"


class Rule(NamedTuple):
    """A verdict for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by U+0000.

    The keys of a host and of all its subdomains are then one interval, from the host's key to
    the same key closed by U+0001.
    """
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "\0"), F.lit("\0"))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = DEFAULT_VERDICT,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``verdict``, ``host`` and ``path``. Of the rules that fit, the one with the
    longest host and path wins; of two equal rules ``block``; without one, ``rule`` is NULL and
    the verdict is ``default``. NULL URLs and such without ``://`` have an empty host and path,
    which no rule fits; rules with a NULL verdict, host or path or an empty host are left out.
    Other columns of either table play no part.

    Both sides are sorted by reversed host. A rule's host is an interval of that order; it is
    copied to the ranges it overlaps, and a sweep through a range keeps the stack of nested
    hosts that are active, each with its rules by path. Range borders come from a bounded
    sample of the keys and from a hash of the row, so a host with a third of all pages lies in
    many ranges; they change the balance only. Rows may repeat; an empty table gives no rows.
    """
    urls = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).select(
        "*",
        host_key(F.col("host")).alias("key"),
        F.xxhash64("page_id", "path").alias("salt"),
    )
    whole = "verdict is not null and host is not null and host != '' and path is not null"
    known = rules.filter(whole).select(
        "verdict", lower_ascii(F.col("host")).alias("host"), "path"
    )
    borders = _borders(urls, range_rows)
    placed = urls.withColumn("range", _range(borders, F.col("key"), F.col("salt")))
    key = host_key(F.col("host"))
    least, most = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    spread = known.withColumn("key", key).withColumn(
        "range",
        F.explode(
            F.sequence(
                _range(borders, F.col("key"), least),
                _range(borders, F.concat(F.expr("left(key, length(key) - 1)"), F.lit("\1")), most),
            )
        ),
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    both = spread.select(
        "range", "key", F.lit(None).cast(kind).alias("page_id"), "host", "path", "verdict"
    ).unionByName(
        placed.select(
            "range", "key", "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")
        )
    )
    order = ["range", "key", F.col("verdict").asc_nulls_last()]
    swept = both.repartition("range").sortWithinPartitions(*order)

    def sweep(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stack = None, []
        for batch in incoming:
            chosen, kept = [], []
            columns = [batch.column(c).to_pylist() for c in ("range", "key", "host", "path", "verdict")]
            for i, (number, key, host, path, verdict) in enumerate(zip(*columns)):
                if number != at:
                    at, stack = number, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if verdict is None:
                    kept.append(i)
                    chosen.append(_longest(stack, host, path))
                else:
                    if not stack or stack[-1].key != key:
                        stack.append(_Active(key, host, {}))
                    held = stack[-1].paths.get(path)
                    stack[-1].paths[path] = "block" if "block" in (held, verdict) else verdict
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(rows) for c in ("page_id", "host", "path")],
                    pa.array([rule for rule, _ in chosen], pa.string()),
                    pa.array([verdict or default for _, verdict in chosen], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return swept.mapInArrow(
        sweep, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


class _Active(NamedTuple):
    """A host on the stack: its key, and the verdicts of its rules by path."""

    key: str
    host: str
    paths: dict[str, str]


def _longest(stack: list[_Active], host: str, path: str) -> tuple[str | None, str | None]:
    """The fitting rule of the active hosts that is longest, and its verdict."""
    best, verdict = None, None
    for active in stack:
        if host != active.host and not host.endswith(f".{active.host}"):
            continue  # a label with U+0000 in it
        for length in sorted({len(p) for p in active.paths}, reverse=True):
            found = active.paths.get(path[:length]) if length <= len(path) else None
            if found:
                rule = active.host + path[:length]
                if best is None or len(rule) > len(best):
                    best, verdict = rule, found
                break
    return best, verdict


def _borders(urls: DataFrame, range_rows: int) -> list[tuple[str, int]]:
    """Quantiles of a bounded sample of (key, salt), about ``range_rows`` rows apart."""
    rows = urls.count()
    parts = min(rows // range_rows + 1, SAMPLE_ROWS // 10)
    if parts == 1:
        return []
    sample = urls.select("key", "salt").orderBy(F.xxhash64("salt", "key")).limit(SAMPLE_ROWS)
    drawn = sorted((row["key"], row["salt"]) for row in sample.collect())
    return [drawn[len(drawn) * i // parts] for i in range(1, parts)]


def _range(borders: Sequence[tuple[str, int]], key: Column, salt: Column) -> Column:
    """How many borders a (key, salt) has reached."""
    if not borders:
        return F.lit(0)

    @F.pandas_udf("int")
    def reached(keys: pd.Series, salts: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(borders, pair) for pair in zip(keys, salts)], dtype="int32")

    return reached(key, salt)


def rules_table(spark, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")
