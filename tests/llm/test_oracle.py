"""Every query of the subpackage that has SQL, on the smallest tables, value by value."""

import pytest

import __spark_entry__ as spark_entry
from tests.compare import connect, differences, duckdb_rows, spark_rows
from wayfare.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_sql(spark, name):
    got = spark_rows(spark_entry.queries()[name](spark, SF_DIR))
    assert differences(got, duckdb_rows(connect(SF_DIR), spark_entry.oracle_sql()[name])) is None


def test_every_operator_and_the_pipeline_are_registered():
    names = set(spark_entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
