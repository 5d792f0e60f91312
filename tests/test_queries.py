"""Every registered query against its SQL in DuckDB."""

import os

import pytest
from check_queries import check, connect

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    assert check(spark, con, SF_DIR, name, driver.queries()[name], driver.oracle_sql().get(name)) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 10
