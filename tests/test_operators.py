"""Operators on small inputs, against brute force, and with hot keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.functions import surrogate_key
from airstrata.operators import (
    heavy_keys,
    spread_join,
    broadcast_if_small,
    flatten_records,
    keep_latest_rows,
    key_uniqueness,
    latest_per_key,
    member_dates,
    members,
    pivot_long_to_wide,
    rank_within_key,
    rollup_avg,
    star_join,
)
from airstrata.operators.sizing import measured_bytes
from airstrata.plans import consume, model
from airstrata.schemas import RECORDS
from airstrata.session import build_session, ensure_checkpoint_dir, stored


def hot(n=6000, seed=3):
    """Rows of which well over a third share one key; keys and orders include NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice([None, "a", "b", "c", "d"])
        at = rng.choice([None, *range(50)])
        rows.append((i, key, at))
    return rows


HOT_SCHEMA = "id long, key string, at int"


def newest_first(row):
    return (row[2] is not None, row[2] or 0, row[0])


def by_key(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=newest_first, reverse=True):
        groups[row[1]].append(row)
    return groups


def test_rank_within_key_matches_brute_force_under_skew(spark):
    rows = hot()
    df = spark.createDataFrame(rows, HOT_SCHEMA).repartition(5)
    got = {r.id: r.rank for r in rank_within_key(df, ["key"], ["at", "id"]).collect()}
    expected = {r[0]: n for g in by_key(rows).values() for n, r in enumerate(g, 1)}
    assert got == expected


def test_hot_key_is_ranked_in_several_tasks(spark):
    df = spark.createDataFrame([(i, "hot", i) for i in range(4000)], HOT_SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_within_key(df, ["key"], ["at", "id"])
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 2000


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], HOT_SCHEMA)
    ranked = rank_within_key(empty, ["key"], ["at", "id"])
    assert ranked.columns == ["id", "key", "at", "rank"] and ranked.count() == 0


def test_latest_per_key(spark):
    rows = hot()
    df = spark.createDataFrame(rows, HOT_SCHEMA).repartition(5)
    got = {tuple(r) for r in latest_per_key(df, ["key"], ["at", "id"]).collect()}
    assert got == {g[0] for g in by_key(rows).values()}


@pytest.mark.parametrize("limit", [64 << 20, 0], ids=["broadcast", "shuffle"])
def test_keep_latest_rows_both_ways(spark, limit):
    rows = hot()
    df = spark.createDataFrame(rows, HOT_SCHEMA).withColumn("payload", F.repeat(F.lit("x"), 100))
    kept = keep_latest_rows(df, ["key"], ["at"], "id", broadcast_limit=limit)
    assert {r.id for r in kept.collect()} == {g[0][0] for g in by_key(rows).values()}
    assert ("Broadcast" in kept._jdf.queryExecution().optimizedPlan().toString() or
            "strategy=broadcast" in kept._jdf.queryExecution().optimizedPlan().toString()) == (limit > 0)


def test_measured_size_counts_text(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"), F.lit(None).cast("string").alias("n"))
    assert measured_bytes(df) == 100 * (3 * 16 + 1000)
    assert measured_bytes(df.limit(0)) == 0
    small = broadcast_if_small(df, settle=False)
    large = broadcast_if_small(df, limit=1000, settle=False)
    hint = "ResolvedHint (strategy=broadcast)"
    assert hint in small._jdf.queryExecution().analyzed().toString()
    assert hint not in large._jdf.queryExecution().analyzed().toString()


def test_flatten_tolerates_odd_documents(spark):
    texts = [
        '{"records":[{"a":1,"b":{"x":2}},{"a":"t"},7,{}]}',
        '{"records":[]}',
        '{"records":{"a":1}}',
        "{}",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    flat = flatten_records(df.withColumn("d", F.parse_json("t")), "d", ["a", "b"], ["i"])
    assert Counter(tuple(r) for r in flat.collect()) == Counter(
        [(0, "1", '{"x":2}'), (0, "t", None), (0, None, None), (0, None, None)]
    )


def test_pivot_as_text_and_as_numbers(spark):
    rows = [("k", "A", "9"), ("k", "A", "10"), ("k", "B", "NA"), ("k", "B", "500"), ("k", "Z", "1"), ("m", "A", None)]
    df = spark.createDataFrame(rows, "k string, c string, v string")
    columns = {"A": "a", "B": "b", "C": "c"}
    text = pivot_long_to_wide(df, ["k"], "c", "v", columns).orderBy("k").collect()
    assert [tuple(r) for r in text] == [("k", "9", "NA", None), ("m", None, None, None)]
    numbers = pivot_long_to_wide(df, ["k"], "c", "v", columns, numeric=True).orderBy("k").collect()
    assert [tuple(r) for r in numbers] == [("k", 10, 500, None), ("m", None, None, None)]


def test_rounded_means_do_not_depend_on_order(spark):
    thirds = [1 / 3, 2 / 3, 0.5, 0.5, 0.1, 0.9]
    for shift in range(len(thirds)):
        values = [(v,) for v in thirds[shift:] + thirds[:shift]]
        df = spark.createDataFrame(values, "x double").coalesce(1)
        assert rollup_avg(df, [], ["x"], rounded=True).first()["x"] == 1


def test_members_and_dates(spark):
    at = dt.datetime(2024, 3, 1, 10)
    rows = [("KA", "B", at), ("KA", "A", at), ("KA", "A", at + dt.timedelta(days=1)), ("TN", "C", at)]
    df = spark.createDataFrame(rows, "state string, city string, measurement_time timestamp_ntz")
    assert [r[0] for r in members(df, "state", desc=True).collect()] == ["TN", "KA"]
    assert [r[0] for r in members(df, "city", state="KA").collect()] == ["A", "B"]
    assert [r[0] for r in member_dates(df, state="KA", city="A").collect()] == [
        dt.date(2024, 3, 2),
        dt.date(2024, 3, 1),
    ]
    # Values never become SQL text.
    assert members(df, "city", state="' or 1=1 --").count() == 0


def station_rows(spark, renamed=True):
    hour = dt.datetime(2024, 3, 1, 10)
    names = ["old", "new" if renamed else "old"]
    rows = [
        (hour + dt.timedelta(hours=i), "IN", "S", "C", name, 1.0, 2.0, *[float(10 * (i + 1))] * 7)
        for i, name in enumerate(names)
    ]
    df = spark.createDataFrame(
        rows,
        "index_record_ts timestamp_ntz, country string, state string, city string, station string, "
        "latitude double, longitude double, " + ", ".join(f"{m} double" for m in model.MEASURES),
    )
    for c in ("latitude", "longitude"):
        df = df.withColumn(c, F.col(c).cast("decimal(12,7)"))
    return df


@pytest.mark.parametrize("renamed", [False, True])
def test_repeated_location_key_fans_out(spark, renamed):
    wide = station_rows(spark, renamed)
    fact, dates, places = model.fact_air_quality(wide), model.dim_date(wide), model.dim_location(wide)
    joined = star_join(fact, dates, places)
    per_key = {r.location_pk: r["count"] for r in places.groupBy("location_pk").count().collect()}
    assert joined.count() == sum(per_key[r.location_fk] for r in fact.collect())
    assert joined.count() == (4 if renamed else 2)
    assert key_uniqueness(places, "location_pk").count() == (1 if renamed else 0)
    # Doubling every row of a city-hour leaves its means unchanged.
    hours = model.city_hour(fact, dates, places).orderBy("measurement_time")
    assert [r.aqi for r in hours.collect()] == [10, 20]


def test_city_means_equal_those_over_the_full_join(spark):
    """Shared, NULL and single coordinates, several cities on one coordinate, NULL measures."""
    rng = random.Random(9)
    rows = []
    for hour in range(4):
        for i in range(60):
            lat = rng.choice([None, None, 1.0, float(i)])
            values = [rng.choice([None, float(rng.randint(0, 300))]) for _ in range(7)]
            city = None if i == 5 else f"C{rng.randint(0, 3)}"
            rows.append((dt.datetime(2024, 3, 1, hour), "IN", "S", city, f"st{i}", lat, 2.0, *values))
    wide = spark.createDataFrame(
        rows,
        "index_record_ts timestamp_ntz, country string, state string, city string, station string, "
        "latitude double, longitude double, " + ", ".join(f"{m} double" for m in model.MEASURES),
    )
    for c in ("latitude", "longitude"):
        wide = wide.withColumn(c, F.col(c).cast("decimal(12,7)"))
    fact, dates, places = model.fact_air_quality(wide), model.dim_date(wide), model.dim_location(wide)
    keys = ["measurement_time", "country", "state", "city"]
    expected = rollup_avg(star_join(fact, dates, places), keys, model.GOLD_MEASURES)
    got = model.city_hour(fact, dates, places).select(*expected.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))
    draft = consume.city_hour_draft(fact, dates, places)
    assert draft.columns[:3] == ["measurement_time", "state", "city"]


def test_shared_coordinate_emits_no_pairs(spark):
    """Ten thousand stations on one coordinate: all pairs would be a hundred million rows."""
    n = 10_000
    wide = spark.range(n).select(
        F.expr("timestamp_ntz'2024-03-01 10:00:00'").alias("index_record_ts"),
        *[F.lit(v).alias(c) for c, v in (("country", "IN"), ("state", "S"))],
        F.concat(F.lit("C"), F.col("id") % 500).alias("city"),
        F.concat(F.lit("st"), "id").alias("station"),
        *[F.lit(None).cast("decimal(12,7)").alias(c) for c in ("latitude", "longitude")],
        *[(F.col("id") % 7).cast("double").alias(m) for m in model.MEASURES],
    )
    hours = model.city_hour(model.fact_air_quality(wide), model.dim_date(wide), model.dim_location(wide))
    mean = sum(i % 7 for i in range(n)) / n
    rows = hours.collect()
    assert len(rows) == 500 and {r.pm10_avg for r in rows} == {mean}


def test_drilldown_uses_the_chosen_station_and_day(spark):
    wide = station_rows(spark)
    args = (model.fact_air_quality(wide), model.dim_date(wide), model.dim_location(wide))
    drill = consume.station_drilldown(*args, "S", "C", "new", dt.date(2024, 3, 1))
    assert [(r.hour, r.station, r.aqi) for r in drill.collect()] == [(10, "new", 10), (11, "new", 20)]
    assert consume.station_drilldown(*args, "S", "C", "new", "2024-03-02").count() == 0
    assert drill.schema["latitude"].dataType == T.DecimalType(10, 7)
    assert consume.hourly_index(drill).columns == ["hour", "aqi"]
    assert consume.hourly_pollutants(drill).columns == ["hour", *model.MEASURES]
    assert consume.map_points(drill).dtypes == [("lat", "double"), ("lon", "double")]


def test_top_cities_finds_the_latest_day_itself(spark):
    day, older = dt.date(2024, 3, 2), dt.date(2024, 3, 1)
    rows = [(day, "S", "B", 5.0), (day, "S", "A", 5.0), (day, "S", "C", 9.0), (older, "S", "D", 99.0)]
    df = spark.createDataFrame(
        [(d, s, c, *[aqi] * 7, "PM25", aqi) for d, s, c, aqi in rows],
        "measurement_date date, state string, city string, "
        + ", ".join(f"{m} double" for m in model.MEASURES)
        + ", prominent_pollutant string, aqi double",
    )
    assert [r.city for r in consume.top_cities_latest_day(df).collect()] == ["C", "A", "B"]
    assert [r.city for r in consume.top_cities_latest_day(df, 2, F.lit(older)).collect()] == ["D"]


def test_dimension_parts(spark):
    at = dt.datetime(2024, 12, 31, 23)
    df = spark.createDataFrame([(at,), (at,)], "index_record_ts timestamp_ntz")
    row = model.dim_date(df).select("aqi_year", "aqi_month", "aqi_quarter", "aqi_day", "aqi_hour").collect()
    assert [tuple(r) for r in row] == [(2024, 12, 4, 31, 24)]


def test_audit_head_equals_head_of_the_full_audit(spark):
    rng = random.Random(1)
    rows = [
        (i, dt.datetime(2024, 3, 1, rng.randint(0, 5)), 1, "1", f"f{i}", dt.datetime(2024, 3, 2, 0, rng.randint(0, 9)), "m", None)
        for i in range(300)
    ]
    bronze = spark.createDataFrame(
        rows,
        "id long, index_record_ts timestamp_ntz, record_count long, json_version string, _stg_file_name string, "
        "_stg_file_load_ts timestamp, _stg_file_md5 string, _copy_data_ts timestamp",
    )
    full = consume.file_rank_audit(bronze).orderBy(F.desc("index_record_ts"), "latest_file_rank").limit(70)
    assert consume.file_rank_audit(bronze, 70).collect() == full.collect()
    assert [r.id for r in consume.bronze_ids(bronze).collect()] == list(range(300))


def test_bad_coordinate_fails_or_becomes_null(spark):
    row = (1, dt.datetime(2024, 3, 1), '{"records":[{"latitude":"north","longitude":"1.5","pollutant_id":"CO"}]}')
    bronze = spark.createDataFrame([row], "id long, index_record_ts timestamp_ntz, t string").select(
        "id",
        "index_record_ts",
        F.from_json("t", T.StructType([T.StructField("records", RECORDS)]))["records"].alias("records"),
        *[F.lit(None).cast("string").alias(c) for c in ("_stg_file_name", "_stg_file_md5")],
        *[F.current_timestamp().alias(c) for c in ("_stg_file_load_ts", "_copy_data_ts")],
    )
    with pytest.raises(PySparkException):
        model.silver_long(bronze).collect()
    kept = model.silver_long(bronze, on_bad="null").first()
    assert kept.latitude is None and float(kept.longitude) == 1.5 and kept.pollutant_id == "CO"


def test_keys_agree_between_fact_and_dimensions(spark):
    wide = station_rows(spark, renamed=False)
    fact = model.fact_air_quality(wide)
    keys = wide.select(surrogate_key("index_record_ts").alias("date_fk"))
    assert fact.select("date_fk").exceptAll(keys).count() == 0
    assert fact.select("aqi_pk").distinct().count() == 2


def test_working_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in ensure_checkpoint_dir(spark)
    copy = stored(spark.range(3).toDF("n"), "numbers")
    assert copy.inputFiles()[0].startswith(("file:" + configured, configured, "file://" + configured))
    assert build_session() is spark


def test_heavy_keys_are_those_above_an_even_share(spark):
    rows = spark.range(10_000).selectExpr("if(id % 2 = 0, 7L, if(id % 5 = 0, 9L, id)) as k", "id as v")
    heavy = heavy_keys(rows.unionByName(spark.range(500).selectExpr("cast(null as long) as k", "id as v")), "k", 8)
    assert heavy.pieces == {7: 5}
    assert heavy_keys(rows, "k", 16).pieces == {7: 9, 9: 2}
    assert heavy_keys(rows.filter("k < 0"), "k").pieces == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, how):
    left = spark.range(2000).selectExpr("if(id % 2 = 0, 7L, if(id % 11 = 0, null, id % 50)) as k", "id as v")
    right = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c"), (60, "d"), (None, "e")], "j long, w string")
    heavy = heavy_keys(left, "k", 8)
    spread = spread_join(left, right, "k", "j", heavy, how, also=F.col("w") != "b" if how == "inner" else None)
    plain = left.join(right, (F.col("k") == F.col("j")) & ((F.col("w") != "b") if how == "inner" else F.lit(True)), how)
    assert spread.columns == plain.columns
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, plain.collect()))
    with pytest.raises(ValueError):
        spread_join(left, right, "k", "j", heavy, "full")


def test_half_of_all_facts_on_one_coordinate_are_spread(spark):
    """With shuffles only, no task of the star join holds more than a few times the median."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        fact = spark.range(64_000).selectExpr(
            "id % 24 as date_fk", "if(id % 2 = 0, 7L, xxhash64(id % 1000)) as location_fk", "id as v"
        )
        dates = spark.range(24).selectExpr("id as date_pk")
        places = fact.select(F.col("location_fk").alias("location_pk")).distinct()

        def sizes(heavy):
            joined = star_join(fact, dates, places, heavy)
            counts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return sorted(r["count"] for r in counts)

        plain, spread = sizes(None), sizes(heavy_keys(fact, "location_fk"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(plain) == sum(spread) == 64_000
    assert plain[-1] > 32_000 and spread[-1] < 4 * spread[len(spread) // 2]


def test_all_intermediates_can_be_cleared(spark):
    from pathlib import Path
    from urllib.parse import urlsplit

    from airstrata.session import check_shared, clear_stored

    folder = Path(urlsplit(ensure_checkpoint_dir(spark)).path)
    kept = stored(spark.range(10), "copy")
    spark.range(10).checkpoint()
    (folder / "lake-x").mkdir()
    assert kept.count() == 10 and len(list(folder.iterdir())) >= 3
    clear_stored(spark)
    assert folder.is_dir() and not list(folder.iterdir())
    assert stored(spark.range(3)).count() == 3
    with pytest.raises(ValueError):
        check_shared("file:/home/me/warehouse", "spark://host:7077")
    check_shared("s3a://bucket/warehouse", "yarn")
    check_shared("file:/home/me/warehouse", "local[4]")
