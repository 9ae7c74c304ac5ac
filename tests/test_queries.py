"""Every registered query with an SQL statement gives the same rows as DuckDB on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def base():
    from check import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


# minutes each; check.py runs them on every call, and unit tests hold the functions behind them
LONG = {"m8_grid_adaboost", "m8_grid_linear_svc", "m8_grid_random_forest"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, base, name):
    from check import _rows

    if name in LONG and not os.environ.get("WINDVANE_LONG"):
        pytest.skip("set WINDVANE_LONG to run it")
    mine = entry.queries()[name](spark, FOLDER).toPandas()
    theirs = base.sql(entry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert _rows(mine) == _rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
