"""Queries that SQL can express, against that SQL on DuckDB; native ones without Python in their plans."""

import os

import duckdb
import pytest

from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import ORACLE_SQL

NATIVE = {"op3_line_dedup"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for file in os.listdir(small):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{small}/{file}'")
    return con


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan
    expected = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = sorted(map(repr, expected.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == theirs
