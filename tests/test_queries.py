import pytest
from compare import connect, duckdb_rows, spark_rows

import __spark_entry__ as driver
from stationflow.plans.oracle import ORACLE
from stationflow.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = spark_rows(driver.queries()[name](spark, sf_dir))
    assert got == duckdb_rows(duck, driver.oracle_sql()[name])


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["scope", "window_start", "window_end"]
    assert df.count() > 0
