"""The driver contract: every query equals its SQL, and none of them runs Python per row."""

import duckdb
import pytest

import __spark_entry__ as driver
import workload
from check import TABLES, rows_of
from tests.conftest import SF, plan


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert workload.QUERIES.keys() == workload.ORACLES.keys()
    assert workload.QUERIES.keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    assert "Python" not in plan(df) and "CartesianProduct" not in plan(df)
    want = con.sql(driver.oracle_sql()[name]).df()
    got = df.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
