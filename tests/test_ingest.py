"""Landed files into bronze and on to gold: batch, stream, retries and late files."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from airstrata.operators import flatten_records, key_uniqueness
from airstrata.plans import consume
from airstrata.schemas import DATE_PARTITION
from airstrata.sources import Lake, file_checksums, file_inventory, parse_documents, read_documents
from airstrata.sources.lake import TABLES
from airstrata.streaming import (
    compact,
    freshness,
    load_batch,
    load_inserted,
    refresh_all,
    refresh_dates,
    refresh_order,
    refresh_pending,
    start_ingest,
)
from airstrata.streaming.ingest import load_documents
from airstrata.streaming.refresh import PARENTS

DAY = dt.date(2024, 3, 1)


def record(station, code, avg, hour="10", day="01-03-2024", lat="12.5", lon=77.25, **extra):
    return {
        "country": "India",
        "state": "Tamil_Nadu",
        "city": extra.pop("city", "Chennai"),
        "station": station,
        "latitude": lat,
        "longitude": lon,
        "pollutant_id": code,
        "pollutant_max": "99",
        "pollutant_min": "1",
        "pollutant_avg": avg,
        "last_update": f"{day} {hour}:00:00",
        **extra,
    }


def document(*records, **extra):
    return {"total": len(records), "version": "1.0", "records": list(records), **extra}


def land(folder, name, content, mtime):
    """Write a file completely elsewhere, then move it in, as a landing process would."""
    text = content if isinstance(content, str) else json.dumps(content)
    path = os.path.join(folder, name)
    staged = os.path.join(os.path.dirname(folder), f"staged-{name}")
    opener = gzip.open if name.endswith(".gz") else open
    with opener(staged, "wt") as f:
        f.write(text)
    os.utime(staged, (mtime, mtime))
    os.replace(staged, path)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return str(folder)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create()
    return lake


FULL = ["PM2.5", "PM10", "SO2", "NO2", "NH3", "CO", "OZONE"]


def fill(folder):
    a = [record("A", code, str(10 + i)) for i, code in enumerate(FULL)]
    b = [record("B", code, str(20 + i), lat="13.5") for i, code in enumerate(FULL)]
    land(folder, "h10.json", document(*a, *b), 1000)
    land(folder, "h10_v2.json", document(*a), 2000)
    land(folder, "h11.json.gz", document(record("A", "PM10", "7", hour="11")), 1000)
    na = [
        record("A", "PM2.5", "NA", hour="12"),
        record("A", "PM10", "9", hour="12"),
        record("A", "PM10", "10", hour="12"),
        record("A", "SO2", "9", hour="12"),
        record("A", "SO2", "NA", hour="12"),
    ]
    land(folder, "na.json", document(*na), 1000)
    land(folder, "multi.json", json.dumps(document(record("A", "CO", "5", hour="13")), indent=2), 1000)
    land(folder, "empty.json", document(), 1000)
    land(folder, "bad_ts.json", document({**record("A", "CO", "1"), "last_update": "2024-03-01"}), 1000)
    land(folder, "broken.json", "{oops", 1000)
    land(folder, "no_version.json", {"total": 1, "records": [record("A", "CO", "1")]}, 1000)
    land(folder, "bad_total.json", document(record("A", "CO", "1"), total="many"), 1000)
    no_total = document(record("A", "CO", "6", hour="14"))
    del no_total["total"]
    land(folder, "no_total.json", no_total, 1000)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def snapshot(lake, name):
    """Contents without the columns that name the load rather than the data."""
    drop = ["_copy_data_ts", "id", "json_data"]
    df = lake.table(name)
    return sorted(map(repr, df.drop(*drop).collect()))


def test_inventory_lists_names_and_sizes(spark, landing):
    fill(landing)
    files = file_inventory(spark, landing)
    assert files.columns == ["path", "modificationTime", "length"]
    assert files.count() == len(os.listdir(landing))
    assert files.filter("length <= 0").count() == 0


def test_bronze_columns_and_rejects(spark, landing, lake):
    fill(landing)
    assert load_batch(lake, landing, refresh=False) == {DAY}
    bronze = lake.table("raw_aqi")
    got = rows(
        bronze.select("_stg_file_name", F.hour("index_record_ts"), "record_count", "json_version"),
        "_stg_file_name",
    )
    assert got == [
        ("h10.json", 10, 14, "1.0"),
        ("h10_v2.json", 10, 7, "1.0"),
        ("h11.json.gz", 11, 1, "1.0"),
        ("multi.json", 13, 1, "1.0"),
        ("na.json", 12, 5, "1.0"),
        ("no_total.json", 14, 0, "1.0"),
    ]
    assert bronze.select("id").distinct().count() == 6
    assert bronze.filter("_stg_file_md5 is null or _copy_data_ts is null").count() == 0
    reasons = dict(rows(lake.rejects().select("_stg_file_name", "reject_reason"), "_stg_file_name"))
    assert reasons == {
        "bad_total.json": "total is no whole number",
        "bad_ts.json": "no readable last_update in the first record",
        "broken.json": "malformed JSON",
        "empty.json": "no readable last_update in the first record",
        "no_version.json": "no version",
    }
    assert lake.rejects().filter("_stg_file_name = 'broken.json'").first()["value"] == "{oops"


def test_checksum_and_time_come_from_the_file(spark, landing):
    import hashlib

    land(landing, "one.json", document(record("A", "CO", "1")), 1234)
    row = parse_documents(read_documents(spark, landing)).first()
    with open(os.path.join(landing, "one.json"), "rb") as f:
        assert row["_stg_file_md5"] == hashlib.md5(f.read()).hexdigest()
    assert row["_stg_file_load_ts"].timestamp() == 1234


def test_loading_again_adds_nothing(spark, landing, lake):
    fill(landing)
    load_batch(lake, landing, refresh=False)
    before = snapshot(lake, "raw_aqi"), lake.rejects().count()
    assert load_batch(lake, landing, refresh=False) == set()
    assert (snapshot(lake, "raw_aqi"), lake.rejects().count()) == before
    land(landing, "h15.json", document(record("A", "CO", "6", hour="15")), 1000)
    assert load_batch(lake, landing, refresh=False) == {DAY}
    ids = [r[0] for r in lake.table("raw_aqi").select("id").collect()]
    assert len(ids) == len(set(ids)) == 7


def test_repeating_a_label_replaces_its_rows(spark, landing, lake):
    fill(landing)
    load_documents(lake, read_documents(spark, landing), "same")
    before = snapshot(lake, "raw_aqi")
    load_documents(lake, read_documents(spark, landing), "same")
    assert snapshot(lake, "raw_aqi") == before


def test_ledger_numbers_loads_and_stays_small(spark, landing, lake):
    for hour in range(4):
        land(landing, f"h{hour}.json", document(record("A", "CO", "6", hour=f"0{hour}")), 1000)
        load_batch(lake, landing)
        assert lake.read("loads").select("load_number").distinct().collect() == [(hour + 1,)]
    ids = [r[0] for r in lake.table("raw_aqi").orderBy("index_record_ts").select("id").collect()]
    assert ids == sorted(set(ids)) and len(ids) == 4
    assert refresh_pending(lake) == set() and refresh_pending(lake) == set()
    assert lake.read("loads").count() == 3


def test_refresh_covers_a_load_that_was_cut_short(spark, landing, lake, monkeypatch):
    fill(landing)
    with monkeypatch.context() as cut:
        cut.setattr("airstrata.streaming.ingest.finish_load", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_batch(lake, landing)
    assert lake.table("fact_air_quality").count() == 0
    assert load_batch(lake, landing) == set()
    assert lake.table("fact_air_quality").count() > 0
    assert refresh_pending(lake) == set()


def test_freshness_by_table(spark, landing, lake):
    """With files not loaded, loads not refreshed, a late file, a partial refresh and idle times."""
    def second(time):
        return None if time is None else int((time - dt.datetime(1970, 1, 1)).total_seconds())

    def lags(now):
        found = freshness(lake, landing, now=dt.datetime(1970, 1, 1) + dt.timedelta(seconds=now)).collect()
        return {r.table_name: (second(r.covered_until), second(r.waiting_since), r.lag_seconds) for r in found}

    assert set(lags(50)) == {"raw_aqi", *DERIVED} and set(lags(50).values()) == {(None, None, 0)}
    land(landing, "a.json", document(record("A", "CO", "1", hour="10")), 1000)
    assert set(lags(1600).values()) == {(None, 1000, 600)}
    load_batch(lake, landing, refresh=False)
    assert lags(1700) == {"raw_aqi": (1000, None, 0)} | {n: (None, 1000, 700) for n in DERIVED}
    refresh_pending(lake)
    # Nothing arrives for long.
    assert set(lags(10**6).values()) == {(1000, None, 0)}
    land(landing, "b.json", document(record("A", "CO", "1", hour="11")), 5000)
    load_batch(lake, landing, refresh=False)
    land(landing, "late.json", document(record("A", "CO", "1", hour="12")), 900)
    load_batch(lake, landing, refresh=False)
    assert lags(6000) == {"raw_aqi": (5000, None, 0)} | {n: (1000, 900, 5100) for n in DERIVED}
    refresh_all(lake, "dim_date")
    fresh = {n: (5000, None, 0) for n in refresh_order("dim_date")}
    assert lags(6000) == {"raw_aqi": (5000, None, 0)} | {n: (1000, 900, 5100) for n in DERIVED} | fresh
    refresh_pending(lake)
    assert set(lags(6000).values()) == {(5000, None, 0)}


def test_compaction_bounds_the_files_of_a_day(spark, landing, lake, monkeypatch):
    """However many loads: readers see the same rows, and known files stay known."""
    from airstrata.streaming import compaction as module

    def files():
        return {(r.day, r.label): r.n_files for r in module.parts_of_days(lake).collect()}

    for hour in range(6):
        land(landing, f"h{hour}.json", document(record("A", "CO", "1", hour=f"0{hour}")), 1000)
        land(landing, f"broken{hour}.json", "{oops", 1000)
        load_batch(lake, landing, refresh=False)
    refresh_pending(lake)
    land(landing, "open.json", document(record("A", "CO", "1", hour="09")), 1000)
    load_batch(lake, landing, refresh=False)
    assert len(files()) == 13

    def rows():
        landed = lake.read("landed_documents").drop("json_data", "load_label")
        return sorted(map(repr, landed.collect())), lake.table("landed_files").count()

    before = rows()
    assert compact(lake, most_parts=6) == 0
    with monkeypatch.context() as cut:
        cut.setattr(module, "finish_compaction", lambda lake: None)
        assert compact(lake, most_parts=5) == 12
    assert rows() == before and len(files()) == 13
    assert load_batch(lake, landing) == set()
    after = files()
    assert len(after) == 3 and max(after.values()) <= 2 and rows() == before
    assert lake.exists(f"{lake.root}/_compaction") is False
    assert compact(lake, target_bytes=1, most_parts=0) == 0
    assert compact(lake, most_parts=1) == 2 and rows() == before
    assert sorted(day for day, _ in files()) == [str(DAY), "__HIVE_DEFAULT_PARTITION__"]
    incremental = {name: snapshot(lake, name) for name in DERIVED}
    refresh_all(lake)
    assert incremental == {name: snapshot(lake, name) for name in DERIVED}


def test_start_of_a_stream_refreshes_pending_loads(spark, tmp_path, landing, lake):
    fill(landing)
    load_batch(lake, landing, refresh=False)
    empty = tmp_path / "nothing"
    empty.mkdir()
    start_ingest(lake, str(empty), str(tmp_path / "stream")).awaitTermination(300)
    assert lake.table("fact_city_agg_day_level").count() > 0


def test_lenient_lake_reads_bad_numbers_as_null(spark, tmp_path, landing):
    lenient = Lake(spark, str(tmp_path / "lenient"), on_bad="null", numeric=True)
    lenient.create()
    values = [("PM2.5", "9"), ("PM2.5", "10"), ("CO", "oops"), ("SO2", "4")]
    land(landing, "a.json", document(*[record("A", c, v, lat="x") for c, v in values]), 1000)
    load_batch(lenient, landing)
    wide = lenient.table("curated_flatten_aqi_dt").first()
    found = (wide["latitude"], wide["pm25_avg"], wide["so2_avg"], wide["co_avg"])
    assert found == (None, 10.0, 4.0, 0.0)


def test_newest_file_replaces_the_hour(spark, landing, lake):
    fill(landing)
    load_batch(lake, landing)
    long = lake.table("curated_aqi_dt")
    ten = long.filter(F.hour("index_record_ts") == 10)
    assert {r[0] for r in ten.select("station").distinct().collect()} == {"A"}
    assert {r[0] for r in ten.select("_stg_file_name").distinct().collect()} == {"h10_v2.json"}
    assert long.select("state").distinct().collect()[0][0] == "Tamil_Nadu"
    wide = lake.table("curated_flatten_aqi_dt").filter(F.hour("index_record_ts") == 12).first()
    assert wide["state"] == "Tamil Nadu"
    # Text order: '9' beats '10', 'NA' beats '9'.
    assert (wide["pm25_avg"], wide["pm10_avg"], wide["so2_avg"], wide["o3_avg"]) == (0, 9, 0, 0)


def test_document_beyond_the_variant_size_is_whole(spark, landing, lake):
    pad = "x" * 2000
    stations = 10_000
    big = [record(f"S{i}", "CO", str(i % 500), note=pad) for i in range(stations)]
    text = json.dumps(document(*big))
    assert len(text) > 20 << 20
    land(landing, "big.json", text, 1000)
    land(landing, "big_broken.json", text[:-2], 1000)
    assert load_batch(lake, landing) == {DAY}
    assert [r["reject_reason"] for r in lake.rejects().collect()] == ["malformed JSON"]
    bronze = lake.table("raw_aqi").first()
    assert (bronze["record_count"], bronze["json_version"]) == (stations, "1.0")
    parsed = parse_documents(read_documents(lake.spark, landing))
    assert flatten_records(parsed, "records", ["station", "none"]).filter("none is null").count() == stations
    long = lake.table("curated_aqi_dt")
    assert long.select("station").distinct().count() == stations
    row = long.filter("station = 'S7'").first()
    assert (row.pollutant_avg, float(row.latitude), float(row.longitude)) == ("7", 12.5, 77.25)


@pytest.mark.parametrize("size", [10, 5 << 20, 21 << 20])
def test_one_rule_decides_for_every_size(spark, landing, lake, size):
    """Padding changes nothing about what is accepted."""
    good = json.dumps({"pad": "x" * size, **document(record("A", "CO", "1"))})
    texts = {
        "good": good,
        "twice": good + good,
        "listed": f"{good},{good}",
        "cut": good[:-1],
        "tail": f"{good} x",
        "quotes": good.replace('"', "'"),
        "repeated": f'{{"version": "0.9", {good[1:]}',
    }
    for name, text in texts.items():
        land(landing, f"{name}.json", text, 1000)
    load_batch(lake, landing, refresh=False)
    accepted = lake.table("raw_aqi").select("_stg_file_name", "json_version").collect()
    assert sorted(map(tuple, accepted)) == [("good.json", "1.0"), ("repeated.json", "1.0")]
    refused = {r._stg_file_name: r.reject_reason for r in lake.rejects().drop("value").collect()}
    assert refused == {
        f"{name}.json": "malformed JSON" for name in ("twice", "listed", "cut", "tail", "quotes")
    }


def test_a_file_put_back_is_loaded_and_wins(spark, landing, lake):
    for value, time in (("10", 1000), ("20", 2000), ("10", 3000)):
        land(landing, "a.json", document(record("A", "CO", value)), time)
        load_batch(lake, landing)
        assert load_batch(lake, landing) == set()
        assert [r.pollutant_avg for r in lake.table("curated_aqi_dt").collect()] == [value]
    assert lake.table("raw_aqi").count() == 3


def test_equal_names_in_two_folders_stay_apart(spark, landing, lake):
    for folder, hour in (("x", "10"), ("y y+1", "11")):
        os.mkdir(os.path.join(landing, folder))
        land(os.path.join(landing, folder), "d.json", document(record("A", "CO", "1", hour=hour)), 1000)
    load_batch(lake, landing, recursive=True, refresh=False)
    names = sorted(r[0] for r in lake.table("raw_aqi").select("_stg_file_name").collect())
    assert names == ["x/d.json", "y y+1/d.json"]
    assert load_batch(lake, landing, recursive=True, refresh=False) == set()


def test_history_meets_identities_not_payloads(spark, landing, lake, monkeypatch):
    """With broadcasts refused, no text or variant of an arrived document is shuffled for it."""
    from airstrata.operators import sizing
    from airstrata.streaming import ingest

    fill(landing)
    load_batch(lake, landing, refresh=False)
    seen = []
    monkeypatch.setattr(
        ingest, "not_yet_loaded",
        lambda files, known, identity: seen.append(files.columns) or sizing.F.broadcast(
            files.join(known.hint("merge"), identity, "left_anti")
        ),
    )
    assert load_batch(lake, landing, refresh=False) == set()
    assert seen == [ingest.FILE_IDENTITY]


def values_of(lake):
    return sorted((r._stg_file_name, r.pollutant_avg) for r in lake.table("curated_aqi_dt").collect())


def test_known_files_are_not_opened(spark, landing, lake, monkeypatch):
    """A file is known by name, time and size; renamed and rewritten ones are new."""
    from airstrata.streaming import ingest

    for hour in ("10", "11", "12"):
        land(landing, f"h{hour}.json", document(record("A", "CO", "1", hour=hour)), 1000)
    load_batch(lake, landing, refresh=False)
    opened = []
    read = ingest.read_documents
    monkeypatch.setattr(
        ingest, "read_documents", lambda *a, **k: opened.append(sorted(k["files"])) or read(*a, **k)
    )
    assert load_batch(lake, landing, refresh=False) == set() and opened == []
    plan = ingest.new_files(lake, landing)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan binaryFile" in line)
    assert "content" not in scan.split("ReadSchema")[1]

    land(landing, "h10.json", document(record("A", "CO", "2", hour="10")), 2000)
    os.rename(os.path.join(landing, "h11.json"), os.path.join(landing, "renamed.json"))
    load_batch(lake, landing)
    assert opened == [["h10.json", "renamed.json"]]
    assert values_of(lake) == [("h10.json", "2"), ("h12.json", "1"), ("renamed.json", "1")]
    assert lake.table("raw_aqi").count() == lake.table("landed_files").count() == 5


def test_loads_hold_a_bounded_number_of_files(spark, landing, lake):
    for hour in range(5):
        land(landing, f"h{hour}.json", document(record("A", "CO", "1", hour=f"0{hour}")), 1000 + hour)
    assert load_batch(lake, landing, refresh=False, max_files=2) == {DAY}
    labels = lake.raw().groupBy("load_label").count().select("count").collect()
    assert sorted(r[0] for r in labels) == [1, 2, 2]
    assert load_batch(lake, landing, refresh=False, max_files=2) == set()


@pytest.mark.parametrize("refreshed", [False, True])
def test_load_cut_before_its_files_are_recorded_leaves_no_copies(spark, landing, lake, monkeypatch, refreshed):
    fill(landing)
    with monkeypatch.context() as cut:
        cut.setattr(Lake, "append", lambda *_: 1 / 0)
        cut.setattr("airstrata.streaming.ingest.begin_load", lambda lake, label: 1)
        with pytest.raises(ZeroDivisionError):
            load_batch(lake, landing)
    begun = lake.raw().select("load_label").first()[0]
    from airstrata.streaming import loads

    loads._enter(lake, 1, [(begun, loads.STARTED, None)])
    if refreshed:
        refresh_pending(lake)
    land(landing, "h16.json", document(record("A", "CO", "6", hour="16")), 1000)
    load_batch(lake, landing)
    assert lake.table("raw_aqi").count() == 7 and lake.rejects().count() == 5
    assert loads.cut_loads(lake) == {} and refresh_pending(lake) == set()
    assert lake.table("landed_files").count() == 12


def test_patterns_and_odd_names_keep_files_apart(spark, landing, lake):
    for folder, hour in (("2024-01", "10"), ("2024-02", "11")):
        os.mkdir(os.path.join(landing, folder))
        for name in ("d.json", "odd [1]{x}.json"):
            land(os.path.join(landing, folder), name, document(record("A", "CO", name[0], hour=hour)), 1000)
    pattern = os.path.join(landing, "2024-*", "*.json")
    load_batch(lake, pattern, refresh=False)
    names = {r[0] for r in lake.table("raw_aqi").select("_stg_file_name").collect()}
    assert names == {f"2024-0{m}/{n}" for m in (1, 2) for n in ("d.json", "odd [1]{x}.json")}
    assert load_batch(lake, pattern, refresh=False) == set()
    named = {r[0] for r in read_documents(spark, pattern).select("file_name").collect()}
    assert named == names


def test_stream_sees_files_rewritten_under_their_name(spark, tmp_path, landing, lake):
    """Between two micro-batches, with an older time, and after a restart; each version once."""
    checkpoint = str(tmp_path / "stream")
    land(landing, "a.json", document(record("A", "CO", "1")), 2000)
    query = start_ingest(lake, landing, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        assert values_of(lake) == [("a.json", "1")]
        land(landing, "a.json", document(record("A", "CO", "2")), 3000)
        land(landing, "late.json", document(record("A", "CO", "9", hour="08")), 500)
        query.processAllAvailable()
        assert values_of(lake) == [("a.json", "2"), ("late.json", "9")]
    finally:
        query.stop()
    land(landing, "a.json", document(record("A", "CO", "33")), 4000)
    for _ in range(2):
        start_ingest(lake, landing, checkpoint).awaitTermination(300)
        assert values_of(lake) == [("a.json", "33"), ("late.json", "9")]
    assert lake.table("raw_aqi").count() == lake.table("landed_files").count() == 4


def test_questions_read_one_day_of_the_lake(spark, landing, lake):
    for name, content, mtime in many_files(4):
        land(landing, name, content, mtime)
    load_batch(lake, landing)
    hours, days = lake.dated("fact_city_agg_hour_level"), lake.dated("fact_city_agg_day_level")
    asked = [
        consume.city_hourly_trend(hours, "Tamil Nadu", "Chennai", "2024-03-02"),
        consume.city_hour_lookup(hours, "Chennai", "2024-03-02 10:00:00"),
        consume.fact_point_lookup(
            lake.dated("curated_flatten_aqi_dt"), "Chennai", "A", "2024-03-02 10:00:00"
        ),
        consume.station_drilldown(
            lake.dated("fact_air_quality"), lake.dated("dim_date"), lake.table("dim_location"),
            "Tamil Nadu", "Chennai", "A", "2024-03-02",
        ),
    ]
    for answer in asked:
        assert answer.count() > 0 and DATE_PARTITION not in answer.columns
        plan = answer._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.splitlines() if "FileScan" in line and DATE_PARTITION in line]
        assert filters and all("2024-03-02" in line.split("PartitionFilters")[1] for line in filters)
    top = consume.top_cities_latest_day(days)
    assert {tuple(r) for r in top.select("city").collect()} == {("Chennai",), ("Salem",)}
    assert DATE_PARTITION not in top.columns


def test_documents_by_line(spark, landing):
    lines = [json.dumps(document(record("A", "CO", "1", hour=h))) for h in ("10", "11", "12")]
    land(landing, "many.json", "\n".join(lines), 1000)
    parsed = parse_documents(read_documents(spark, landing, line_delimited=True))
    assert parsed.filter("reject_reason is null").count() == 3


def test_checksum_of_a_file_read_by_line(spark, tmp_path, landing, lake):
    """One for all lines, whatever the splits and the compression; it changes with any line."""
    lines = [json.dumps(document(record("A", "CO", str(h), hour=f"{h:02}"))) for h in range(20)]
    contents = {
        "a.json": lines, "same.json.gz": lines, "turned.json": lines[::-1], "less.json": lines[1:],
        "twice.json": [*lines, lines[0]], "other.json": [*lines[:-1], lines[0]],
    }
    for name, content in contents.items():
        land(landing, name, "\n".join(content), 1000)

    def sums():
        found = file_checksums(read_documents(spark, landing, line_delimited=True))
        return {r.file_name: r.file_md5 for r in found.collect()}

    whole = sums()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert sums() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert whole["a.json"] == whole["same.json.gz"] == whole["turned.json"]
    assert len(set(whole.values())) == 4
    load_batch(lake, landing, line_delimited=True, refresh=False)
    kept = lake.raw().select("_stg_file_name", "_stg_file_md5").distinct().collect()
    assert {r[0]: r[1] for r in kept} == whole and len(kept) == len(whole)


def test_nested_folders_and_modified_after(spark, landing):
    os.mkdir(os.path.join(landing, "sub"))
    land(landing, "a.json", document(record("A", "CO", "1")), 1000)
    land(os.path.join(landing, "sub"), "b.json", document(record("A", "CO", "1")), 200_000)
    assert read_documents(spark, landing, recursive=True).count() == 2
    after = read_documents(
        spark, landing, recursive=True, modified_after="1970-01-02T00:00:00"
    )
    assert [r["file_name"] for r in after.collect()] == ["sub/b.json"]


def test_preview_before_loading(spark, landing):
    fill(landing)
    preview = consume.staged_preview(parse_documents(read_documents(spark, landing)), 3)
    assert preview.count() == 3
    assert preview.columns[:4] == ["index_record_ts", "json_data", "record_count", "json_version"]


def many_files(seed):
    """Three days of hours, some delivered twice or late, one station renamed on the last day."""
    rng = random.Random(seed)
    files = []
    for day in (1, 2, 3):
        for hour in (9, 10, 11):
            for version in range(rng.choice([1, 1, 2])):
                stations = [("A", "12.5", "Chennai"), ("B", "13.5", "Chennai"), ("C", "14.5", "Salem")]
                if day == 3:
                    stations[2] = ("C renamed", "14.5", "Salem")
                if version == 1:
                    stations = stations[:2]
                records = [
                    record(name, code, str(rng.randint(0, 300)), f"{hour:02}", f"{day:02}-03-2024", lat, city=city)
                    for name, lat, city in stations
                    for code in FULL
                ]
                files.append((f"d{day}h{hour}v{version}.json", document(*records), 1000 + version))
    files.append(("broken.json", "{oops", 1000))
    rng.shuffle(files)
    return files


DERIVED = list(PARENTS)


def test_stream_in_random_order_equals_full_recompute(spark, tmp_path, landing, lake):
    seed = 2
    files = many_files(seed)
    checkpoint = str(tmp_path / "stream")
    cuts = sorted(random.Random(seed).sample(range(1, len(files)), 2))
    for start, end in zip([0, *cuts], [*cuts, len(files)]):
        for name, content, mtime in files[start:end]:
            land(landing, name, content, mtime)
        query = start_ingest(lake, landing, checkpoint)
        query.awaitTermination(300)
        assert query.exception() is None
    incremental = {name: snapshot(lake, name) for name in ["raw_aqi", *DERIVED]}

    whole = Lake(spark, str(tmp_path / "whole"))
    whole.create()
    load_batch(whole, landing, refresh=False)
    refresh_all(whole)
    for name in ["raw_aqi", *DERIVED]:
        assert incremental[name] == snapshot(whole, name), name
    assert lake.rejects().count() == 1
    # The renamed station shares a coordinate, so its key repeats and its facts fan out.
    assert key_uniqueness(lake.table("dim_location"), "location_pk").count() == 1
    assert refresh_pending(lake) == set()


def test_stream_ignores_known_files(spark, tmp_path, landing, lake):
    fill(landing)
    checkpoint = str(tmp_path / "stream")
    start_ingest(lake, landing, checkpoint).awaitTermination(300)
    before = snapshot(lake, "raw_aqi")
    start_ingest(lake, landing, checkpoint).awaitTermination(300)
    # A new checkpoint sees all files again; the load history keeps them out.
    start_ingest(lake, landing, str(tmp_path / "other")).awaitTermination(300)
    assert load_batch(lake, landing) == set()
    assert snapshot(lake, "raw_aqi") == before


def test_stream_with_freshness_target(spark, tmp_path, landing, lake):
    fill(landing)
    query = start_ingest(lake, landing, str(tmp_path / "stream"), every="1 second", max_files=100)
    try:
        query.processAllAvailable()
        assert lake.table("fact_city_agg_day_level").count() == 1
    finally:
        query.stop()


def test_refresh_cut_short_is_repaired(spark, landing, lake, monkeypatch):
    """A station renamed on day 3 changes days 1 and 2; the run dies just before those."""
    from airstrata.streaming import refresh

    files = many_files(5)
    for name, content, mtime in files:
        if not name.startswith("d3"):
            land(landing, name, content, mtime)
    load_batch(lake, landing)
    for name, content, mtime in files:
        if name.startswith("d3"):
            land(landing, name, content, mtime)
    original = refresh._replace_dates

    def dies(lake_, name, *rest):
        if name == "fact_city_agg_hour_level":
            raise RuntimeError("executor lost")
        original(lake_, name, *rest)

    monkeypatch.setattr(refresh, "_replace_dates", dies)
    with pytest.raises(RuntimeError):
        load_batch(lake, landing)
    monkeypatch.setattr(refresh, "_replace_dates", original)
    assert load_batch(lake, landing) == set()
    repaired = {name: snapshot(lake, name) for name in DERIVED}
    refresh_all(lake)
    assert repaired == {name: snapshot(lake, name) for name in DERIVED}


def test_emptied_date_disappears(spark, landing, lake):
    for name, content, mtime in many_files(3):
        land(landing, name, content, mtime)
    load_batch(lake, landing)
    gone = dt.date(2024, 3, 2)
    kept = lake.read("landed_documents").filter(F.col(DATE_PARTITION).isNull() | (F.col(DATE_PARTITION) != gone))
    pinned = kept.checkpoint()
    lake.overwrite("landed_documents", pinned)
    refresh_dates(lake, [gone])
    incremental = {name: snapshot(lake, name) for name in DERIVED}
    assert lake.table("fact_city_agg_day_level").filter(F.col("measurement_date") == gone).count() == 0
    refresh_all(lake)
    assert incremental == {name: snapshot(lake, name) for name in DERIVED}


def test_stored_schemas_match_the_contract(spark, landing, lake):
    fill(landing)
    load_batch(lake, landing)
    for name in DERIVED:
        expected = [(f.name, f.dataType) for f in TABLES[name].schema]
        assert [(f.name, f.dataType) for f in lake.table(name).schema] == expected
        parents = PARENTS[name]
        assert all(p in PARENTS or p == "raw_aqi" for p in parents)


def test_refresh_order_walks_parents_first():
    assert refresh_order("dim_date") == ["curated_aqi_dt", "curated_flatten_aqi_dt", "dim_date"]
    order = refresh_order()
    assert order == DERIVED
    for name in order:
        assert all(order.index(p) < order.index(name) for p in PARENTS[name] if p in PARENTS)


def test_tables_for_sql_users(spark, landing, lake):
    fill(landing)
    load_batch(lake, landing)
    lake.register()
    assert spark.sql("select count(*) from bronze.raw_aqi").first()[0] == 6
    assert spark.sql("select count(*) from bronze.raw_aqi_rejects").first()[0] == 5
    top = spark.sql(
        "select city, aqi from gold.fact_city_agg_day_level where measurement_date = "
        "(select max(measurement_date) from gold.fact_city_agg_day_level) and city = :city",
        args={"city": "Chennai"},
    )
    assert top.count() == 1
    assert spark.sql("show schemas like 'consumption'").count() == 1


def test_refresh_of_a_day_reads_no_other(spark, landing, lake, monkeypatch):
    """Unless a coordinate's stations change; then means move and no fact is read for it."""
    from airstrata.streaming import refresh

    for name, content, mtime in many_files(6):
        if not name.startswith("d3"):
            land(landing, name, content, mtime)
    load_batch(lake, landing)
    asked, found = [], []
    read, keys = Lake.read, refresh._moved_keys

    def listened(self, name, dates=None):
        asked.append((name, dates))
        return read(self, name, dates)

    monkeypatch.setattr(Lake, "read", listened)
    monkeypatch.setattr(refresh, "_moved_keys", lambda counts: found.append(keys(counts)) or found[-1])
    days = [dt.date(2024, 3, day) for day in (1, 2, 3)]
    refresh_dates(lake, days[1:2])
    assert found == [None]
    assert {name for name, dates in asked if dates is None} == {"location_counts"}
    assert all(set(dates) == {days[1]} for _, dates in asked if dates is not None)

    for name, content, mtime in many_files(6):
        if name.startswith("d3"):
            land(landing, name, content, mtime)
    load_batch(lake, landing, refresh=False)
    asked.clear()
    refresh_dates(lake, days[2:])
    assert found[1] is not None
    reached = {name for name, dates in asked if dates is not None and days[0] in dates}
    assert reached == {"location_hour", "city_hour_sums", "fact_city_agg_hour_level"}
    moved = {name: snapshot(lake, name) for name in DERIVED}
    refresh_all(lake)
    assert moved == {name: snapshot(lake, name) for name in DERIVED}


def test_merged_means_equal_the_star_join(spark, landing, lake):
    """Also where stations share coordinates across cities."""
    from airstrata.plans import model

    stations = [("A", "1", "Chennai"), ("B", "1", "Chennai"), ("C", "1", "Salem"), ("D", "2", "Salem")]
    for hour in ("09", "10"):
        records = [
            record(n, code, str(i * 7 % 11), hour, lat=lat, city=city)
            for i, (n, lat, city) in enumerate(stations * 2)
            for code in FULL[: 3 + i % 5]
        ]
        land(landing, f"{hour}.json", document(*records), 1000)
    load_batch(lake, landing)
    star = model.city_hour(*[lake.table(n) for n in ("fact_air_quality", "dim_date", "dim_location")])
    merged = lake.table("fact_city_agg_hour_level")
    assert sorted(map(repr, star.select(merged.columns).collect())) == sorted(map(repr, merged.collect()))


def test_questions_for_sql_users_read_one_day(spark, landing, lake):
    from airstrata.functions import register_questions

    for name, content, mtime in many_files(4):
        land(landing, name, content, mtime)
    load_batch(lake, landing)
    lake.register()
    register_questions(spark)
    day, at = "2024-03-02", "2024-03-02 10:00:00"
    hours = lake.dated("fact_city_agg_hour_level")
    tables = (lake.dated("fact_air_quality"), lake.dated("dim_date"), lake.table("dim_location"))
    asked = {
        f"city_hourly_trend('Tamil Nadu', 'Chennai', DATE'{day}')":
            consume.city_hourly_trend(hours, "Tamil Nadu", "Chennai", day),
        f"city_hour_at('Chennai', TIMESTAMP_NTZ'{at}')": consume.city_hour_lookup(hours, "Chennai", at),
        f"station_drilldown('Tamil Nadu', 'Chennai', 'A', DATE'{day}')":
            consume.station_drilldown(*tables, "Tamil Nadu", "Chennai", "A", day),
    }
    for call, expected in asked.items():
        found = spark.sql(f"SELECT * FROM {call}")
        assert sorted(found.columns) == sorted(expected.columns) and expected.count() > 0
        same = expected.select(found.columns).collect()
        assert sorted(map(repr, found.collect())) == sorted(map(repr, same))
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and DATE_PARTITION in line]
        assert scans and all(day in line.split("PartitionFilters")[1] for line in scans), plan
    top = spark.sql("SELECT * FROM top_cities_latest_day(1)")
    expected = consume.top_cities_latest_day(lake.dated("fact_city_agg_day_level"), 1)
    assert top.columns == expected.columns and top.collect() == expected.collect()


def test_sql_inserts_get_defaults_and_are_refused_without_a_time(spark, landing, lake):
    """Rows inserted by SQL users become documents of bronze, each once, and reach gold."""
    lake.register()
    text = json.dumps(document(record("A", "PM10", "50"), record("A", "CO", "5")))
    insert = "insert into bronze.raw_aqi_inserts (json_data, json_version{}) values "
    spark.sql(
        insert.format(", index_record_ts")
        + "(parse_json(:text), '1.0', timestamp_ntz'2024-03-01 10:00:00'), (parse_json(:text), '1.0', null)",
        args={"text": text},
    )
    spark.sql(insert.format("") + "(parse_json(:text), '1.0')", args={"text": text})
    spark.sql(
        insert.format(", index_record_ts, record_count")
        + "(null, '1.0', timestamp_ntz'2024-03-01 11:00:00', 4),"
        "(parse_json(:text), null, timestamp_ntz'2024-03-01 11:00:00', 4),"
        "(parse_json(:text), '1.0', timestamp_ntz'2024-03-01 11:00:00', null)",
        args={"text": text},
    )
    assert load_inserted(lake) == {DAY}
    assert load_inserted(lake) == set()
    row, = lake.table("raw_aqi").collect()
    assert (row["record_count"], row["json_version"]) == (0, "1.0")
    assert row["_stg_file_name"].startswith("insert/part-")
    assert row["_copy_data_ts"] is not None and row["_stg_file_load_ts"] is not None
    reasons = sorted(r["reject_reason"] for r in lake.rejects().collect())
    assert reasons == [
        "no index_record_ts", "no index_record_ts", "no json_data", "no json_version", "no record_count",
    ]
    fact, = lake.table("fact_air_quality").collect()
    assert (fact["pm10_avg"], fact["co_avg"]) == (50.0, 5.0)
    # A later insert for the hour replaces its document.
    late = json.dumps(document(record("A", "PM10", "70")))
    spark.sql(
        insert.format(", index_record_ts, _stg_file_load_ts")
        + "(parse_json(:text), '1.0', timestamp_ntz'2024-03-01 10:00:00', timestamp'2999-01-01')",
        args={"text": late},
    )
    assert load_inserted(lake) == {DAY}
    assert [r["pm10_avg"] for r in lake.table("fact_air_quality").collect()] == [70.0]


def test_nothing_was_inserted(lake):
    assert load_inserted(lake) == set()
