"""Every registered query against its SQL in DuckDB: rows, names, values and types."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import types as T

import __spark_entry__ as driver
from airstrata.gate.duck_sql import ORACLES
from airstrata.gate.spark_queries import QUERIES

TABLES = ("nation", "customer", "events")
# Names of DuckDB types by Spark type, for columns that must agree.
DUCK_TYPES = {
    T.IntegerType(): "INTEGER",
    T.LongType(): "BIGINT",
    T.DoubleType(): "DOUBLE",
    T.StringType(): "VARCHAR",
    T.BooleanType(): "BOOLEAN",
    T.DateType(): "DATE",
    T.TimestampNTZType(): "TIMESTAMP",
}


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def canonical(value):
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def duck_type(dtype):
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return DUCK_TYPES[dtype]


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM], ids=["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    answer = duck(sf_dir).execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in answer.description}
    expected = answer.fetchall()
    assert sorted(df.columns) == sorted(described)
    assert {f.name: duck_type(f.dataType) for f in df.schema} == described
    assert bag(df.columns, df.collect()) == bag(list(described), expected)
    assert expected or sf_dir == SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.count() == 491
    assert df.filter("aqi > 0").count() == 78
