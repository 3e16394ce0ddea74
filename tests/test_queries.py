"""Registered queries against their SQL, all with one Spark and one DuckDB session."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rowtide.plans.expected import EXPECTED
from rowtide.plans.queries import REGISTRY
from tools.check import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(EXPECTED)
    assert set(REGISTRY) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    cur = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    got = rows_of(df.columns, df.collect())
    assert got == rows_of(columns, cur.fetchall())
    assert got


def test_entry(spark):
    assert entry(spark).count() > 0
