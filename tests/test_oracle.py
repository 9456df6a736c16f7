"""Every query with SQL, on the smallest tables, value by value."""

import pytest

import __spark_entry__ as spark_entry
from tests.compare import connect, differences, duckdb_rows, spark_rows
from wayfare.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, connection, name):
    got = spark_rows(spark_entry.queries()[name](spark, SF_DIR))
    assert differences(got, duckdb_rows(connection, spark_entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert spark_entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
