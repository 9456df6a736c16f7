import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.operators import quality as q


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "W", 0), (1, "L", -1), (2, None, 5), (None, "?", None), (None, "W", 2)], "id int, wl string, n int")


def test_each_check_counts_its_failures(df):
    report = q.quality_report(df, [
        q.not_null("id"), q.unique("id"), q.accepted_values("wl", ["W", "L"]), q.positive("n"), q.non_negative("n"),
        q.row_count_positive(), q.custom("three_named", F.count("id"), 3), q.custom("no_rows", F.count(F.lit(1)), 0),
    ])
    got = {(r.check, r.column): (r.failures, r.status) for r in report.collect()}
    assert got == {
        ("not_null", "id"): (2, "fail"), ("unique", "id"): (1, "fail"), ("accepted_values", "wl"): (1, "fail"),
        ("positive", "n"): (2, "fail"), ("non_negative", "n"): (1, "fail"),
        ("row_count_greater_than_zero", ""): (0, "pass"), ("three_named", ""): (0, "pass"), ("no_rows", ""): (1, "fail"),
    }
    with pytest.raises(ValueError, match=r"unique\(id\): 1"):
        q.require(report)
    q.require(report.filter("status = 'pass'"))


def test_empty_table(df):
    report = q.quality_report(df.filter("false"), [q.not_null("id"), q.unique("id"), q.row_count_positive()])
    assert {r.check: r.failures for r in report.collect()} == {"not_null": 0, "unique": 0, "row_count_greater_than_zero": 1}


@pytest.mark.parametrize("hours, status", [(23, "pass"), (24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 5, 5, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (dt.datetime(2020, 1, 1),)], "t timestamp")
    assert q.freshness(df, "t", now).first().status == status


def test_freshness_of_nothing(spark):
    assert q.freshness(spark.createDataFrame([], "t timestamp"), "t", "2024-01-01").first().status == "error"
