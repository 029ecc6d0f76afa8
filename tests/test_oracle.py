"""Every registered query against its SQL on DuckDB, with no cross join and no Python in it."""

import datetime as dt
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.oracle import ORACLE_SQL as SQL
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for file in os.listdir(small):
        con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{small}/{file}'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(names, rows, columns):
    picked = [columns.index(n) for n in names]
    return sorted((tuple(_plain(r[i]) for i in picked) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan
    got = duck.execute(SQL[name])
    columns = [c[0] for c in got.description]
    names = sorted(df.columns)
    assert names == sorted(columns)
    expected = _sorted(names, got.fetchall(), columns)
    assert _sorted(names, df.collect(), df.columns) == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
