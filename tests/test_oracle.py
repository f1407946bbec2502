"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from conftest import TESTDATA
from oracle_check import compare, connect

import __spark_entry__ as driver

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
