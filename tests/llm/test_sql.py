"""The queries of this subpackage against their SQL in DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from conftest import MEDIUM

from airstrata.llm.oracles import ORACLES
from airstrata.llm.queries import QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from read_parquet('{MEDIUM}/{table}.parquet')")
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    expected = answer.fetchall()
    found = QUERIES[name](spark, MEDIUM)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(expected)
    assert expected
