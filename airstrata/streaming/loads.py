"""The ledger of loads: their numbers, the dates they touch, and which await a refresh.

A load is entered before it writes documents, so its number is never given to another one, and
again with its dates when they are written. The entries of refreshed loads are deleted, but for
the newest load's, which holds the number the next one counts from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.schemas import COVERAGE, DATE_PARTITION, LOADS
from airstrata.sources.lake import Lake

STARTED, LOADED, REFRESHED = "started", "loaded", "refreshed"


Arrivals = tuple[dt.datetime | None, dt.datetime | None]


def _enter(
    lake: Lake,
    number: int,
    rows: list[tuple[str, str, dt.date | None]],
    arrivals: Arrivals = (None, None),
) -> None:
    steps = lake.spark.createDataFrame([(*row, *arrivals) for row in rows], LOADS).coalesce(1)
    lake.append("loads", steps.withColumn("load_number", F.lit(number).cast("long")))


def begin_load(lake: Lake, label: str) -> int:
    """Number of the load, above all earlier ones; a repeated load starts under a new one."""
    last = lake.read("loads").agg(F.coalesce(F.max("load_number"), F.lit(0))).first()[0]
    _enter(lake, last + 1, [(label, STARTED, None)])
    return last + 1


def finish_load(
    lake: Lake,
    number: int,
    label: str,
    dates: Iterable[dt.date],
    arrivals: Arrivals = (None, None),
) -> None:
    """Enter the dates of a load whose documents are written, and when its files arrived."""
    rows = [(label, LOADED, date) for date in sorted(dates)] or [(label, LOADED, None)]
    _enter(lake, number, rows, arrivals)


def cut_loads(lake: Lake) -> dict[int, str]:
    """Numbers and labels of loads that began and have not written all their documents."""
    done = F.max(F.col("step").isin(LOADED, REFRESHED)).alias("done")
    steps = lake.read("loads").groupBy("load_number", "load_label").agg(done)
    found = steps.filter(~F.col("done")).select("load_number", "load_label").collect()
    return {row["load_number"]: row["load_label"] for row in found}


def close_cut_loads(lake: Lake, cut: dict[int, str]) -> None:
    """Enter what loads have left behind that were cut short, once their files are loaded."""
    if not cut:
        return
    written = lake.raw().filter(F.col("load_label").isin(sorted(set(cut.values()))))
    found = written.select("load_label", DATE_PARTITION).distinct().collect()
    for number, label in cut.items():
        finish_load(lake, number, label, {row[1] for row in found if row[0] == label})


def pending_loads(lake: Lake) -> tuple[set[str], set[dt.date]]:
    """Labels of the loads that no refresh has covered, and the dates they touch.

    Dates of a load that was cut short are found in bronze, by its label.
    """
    loads = lake.read("loads")
    steps = loads.groupBy("load_number", "load_label").agg(
        F.max(F.col("step") == LOADED).alias("done"),
        F.max(F.col("step") == REFRESHED).alias("covered"),
    )
    found = steps.filter(~F.col("covered")).select("load_number", "load_label", "done").collect()
    numbers = [row["load_number"] for row in found]
    touched = loads.filter(F.col("load_number").isin(numbers)).select("touched_date").distinct()
    dates = {row[0] for row in touched.collect()} - {None} if numbers else set()
    cut = sorted({row["load_label"] for row in found if not row["done"]})
    if cut:
        written = lake.raw().filter(F.col("load_label").isin(cut)).select(DATE_PARTITION)
        dates |= {row[0] for row in written.distinct().collect()}
    return {row["load_label"] for row in found}, dates


def mark_covered(lake: Lake, tables: Iterable[str], loads: DataFrame) -> None:
    """Note that the tables cover ``loads``, rows of the ledger as it was before the refresh."""
    now = loads.agg(F.max("load_number"), F.max("last_arrival")).first()
    known = {row["table_name"]: row for row in lake.table("coverage").collect()}
    rows = {name: (name, row["load_number"], row["covered_until"]) for name, row in known.items()}
    for name in tables:
        _, number, until = rows.get(name, (name, None, None))
        number, until = (
            max((v for v in pair if v is not None), default=None)
            for pair in ((number, now[0]), (until, now[1]))
        )
        rows[name] = (name, number, until)
    lake.overwrite("coverage", lake.spark.createDataFrame(sorted(rows.values()), COVERAGE).coalesce(1))


def mark_refreshed(lake: Lake, labels: Iterable[str]) -> None:
    """Take loads from the ledger; the newest one's entry stays, marked.

    A load that was cut short stays too, since its documents must not be written again.
    """
    loads = lake.read("loads")
    newest = loads.agg(F.max("load_number")).first()[0]
    steps = loads.groupBy("load_number", "load_label").agg(
        F.max(F.col("step") == LOADED).alias("done"),
        F.max(F.col("step") == REFRESHED).alias("covered"),
    )
    over = (F.col("load_label").isin(sorted(labels)) & F.col("done")) | F.col("covered")
    entries = steps.filter(over).collect()
    for row in entries:
        if row["load_number"] == newest and not row["covered"]:
            _enter(lake, newest, [(row["load_label"], REFRESHED, None)])
    lake.drop_loads(row["load_number"] for row in entries if row["load_number"] != newest)
