"""Index functions, keys, timestamps and numbers."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.functions import (
    aqi_value,
    argmax_label,
    capped_count,
    clean_numeric,
    criteria,
    parse_ts,
    prominent_index,
    register_sql,
    surrogate_key,
)
from airstrata.schemas import LABELS, MEASURES

N = None
# pm25, pm10, so2, no2, nh3, co, o3 -> prominent pollutant, criteria, index
GOLDEN = [
    ((56, 70, 12, 4, 17, 47, 3), "PM10", 3, 70),
    ((89, 70, 12, 4, 17, 47, 3), "PM25", 3, 89),
    ((0, 0, 0, 0, 0, 0, 0), "PM25", 0, 0),
    ((N, N, N, N, N, N, N), "PM25", 0, 0),
    ((7, 7, 7, 7, 7, 7, 7), "PM25", 3, 7),
    ((5, 0, 1, 0, 0, 0, 0), "PM25", 2, 0),
    ((0, 0, 1, 2, 3, 4, 5), "O3", 2, 0),
    ((-1, 0, -1, -1, 0, 0, 0), "PM10", 2, 0),
    ((N, 3, N, 4, N, 0, 6), "O3", 3, 6),
]
SCHEMA = T.StructType([T.StructField(m, T.DoubleType()) for m in MEASURES])


def measures(spark, rows):
    floats = [tuple(None if v is None else float(v) for v in row) for row in rows]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(floats)], T.StructType(
        [T.StructField("i", T.IntegerType()), *SCHEMA.fields]
    ))


def test_golden_vectors(spark):
    df = measures(spark, [g[0] for g in GOLDEN]).orderBy("i")
    got = df.select(prominent_index(), criteria(), aqi_value()).collect()
    assert [tuple(r) for r in got] == [(g[1], g[2], float(g[3])) for g in GOLDEN]


def test_golden_vectors_in_sql(spark):
    register_sql(spark)
    measures(spark, [g[0] for g in GOLDEN]).createOrReplaceTempView("measures")
    arguments = ", ".join(MEASURES)
    got = spark.sql(
        f"select prominent_index({arguments}), three_sub_index_criteria({arguments}), "
        f"aqi_value({arguments}) from measures order by i"
    ).collect()
    assert [tuple(r) for r in got] == [(g[1], g[2], float(g[3])) for g in GOLDEN]
    assert spark.sql("select prominent_index(56, 70, 12, 4, 17, 47, 3)").first()[0] == "PM10"


def test_integer_arguments_round_first(spark):
    df = measures(spark, [(10.4, 10.3, 0.4, 3, 0, 0, 0), (10.3, 10.4, 0.4, 3, 0, 0, 0)]).orderBy("i")
    plain = df.select(prominent_index(), criteria()).collect()
    assert [tuple(r) for r in plain] == [("PM25", 3), ("PM10", 3)]
    rounded = df.select(
        prominent_index(integer_args=True), criteria(integer_args=True), aqi_value(integer_args=True)
    ).collect()
    assert [tuple(r) for r in rounded] == [("PM25", 2, 0.0), ("PM25", 2, 0.0)]


reading = st.one_of(st.none(), st.integers(-5, 500))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[reading] * 7), min_size=20, max_size=60))
def test_index_properties(spark, rows):
    got = measures(spark, rows).orderBy("i").select(
        prominent_index().alias("label"), criteria().alias("n"), aqi_value().alias("aqi")
    ).collect()
    for values, row in zip(rows, got):
        filled = [v or 0 for v in values]
        known = [v for v in values if v is not None]
        assert filled[LABELS.index(row.label)] == max(filled)
        assert LABELS.index(row.label) == filled.index(max(filled))
        assert 0 <= row.n <= 3
        assert row.aqi == (max(known) if row.n > 2 else 0)


def test_generic_forms(spark):
    df = spark.createDataFrame([(1, 5, 5), (None, None, -1)], "a int, b int, c int")
    got = df.select(
        argmax_label(["a", "b", "c"], ["A", "B", "C"]).alias("label"),
        capped_count([F.col("a") > 0, F.col("b") > 0, F.col("c") > 0], 2).alias("n"),
    ).collect()
    assert [tuple(r) for r in got] == [("B", 2), ("A", 0)]


def test_key_tells_null_positions_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (None, None)], "a int, b int")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 4


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    texts = [
        ("10-03-2024 02:30:00", dt.datetime(2024, 3, 10, 2, 30)),  # skipped in New York
        ("03-11-2024 01:30:00", dt.datetime(2024, 11, 3, 1, 30)),  # occurs twice there
        ("2024-03-01", None),
        ("31-02-2024 10:00:00", None),
        ("", None),
        (None, None),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string")
        got = [r[0] for r in df.orderBy("i").select(parse_ts("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [expected for _, expected in texts]


def test_clean_numeric(spark):
    texts = ["NA", None, "12", "12.5", "-0.5", "2.4"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(clean_numeric("t")).collect()]
    assert got == [0, 0, 12, 13, -1, 2]
    bad = spark.createDataFrame([("oops",)], "t string")
    assert bad.select(clean_numeric("t", on_bad="null")).first()[0] is None
    assert bad.select(clean_numeric("t", sentinels=("oops",))).first()[0] == 0
    with pytest.raises(PySparkException):
        bad.select(clean_numeric("t")).collect()
    with pytest.raises(ValueError):
        clean_numeric("t", on_bad="ignore")


def test_empty_text_is_bad_too(spark):
    df = spark.createDataFrame([("",)], "t string")
    value = df.select(clean_numeric("t", on_bad="null")).first()[0]
    assert value is None or math.isnan(value)
