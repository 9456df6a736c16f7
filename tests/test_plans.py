"""The physical plans must keep their shape: what is read, shuffled and joined."""

import re

import pytest

import __spark_entry__ as spark_entry
from wayfare.functions import times
from wayfare.operators import games
from wayfare.plans import bindings as b
from wayfare.plans.registry import QUERIES
from wayfare.sinks import tables

SF_DIR = "/root/testdata/sf0.001"
BATCH = [n for n in QUERIES if not n.startswith(("stream_", "tip_", "line_", "category_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def count(pattern, text):
    return len(re.findall(pattern, text))


def named(spark, name):
    return plan(spark_entry.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", [n for n in BATCH if "stored" not in n and "flow" not in n])
def test_no_cross_join_and_no_python_in_the_way(spark, name):
    text = named(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("ArrowEvalPython" in text) == (name == "base_code_pandas_udf") and "BatchEvalPython" not in text


def test_projection_and_filter_reach_the_scan(spark):
    text = named(spark, "scan_projection")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in named(spark, "interval_filter")
    assert "LessThan(ts,2024-01-16T00:00)" in named(spark, "date_equality")


@pytest.mark.parametrize("name, first, last", [
    ("trips_in_month", "1999-10-01", "1999-11-01"), ("revenue_by_year_top1", "1998-01-01", "1999-01-01"),
])
def test_months_asked_for_reach_the_scan(spark, name, first, last):
    text = named(spark, name)
    assert f"GreaterThanOrEqual(l_shipdate,{first}T00:00)" in text and f"LessThan(l_shipdate,{last}T00:00)" in text


def test_origin_filters_trips_before_the_aggregate(spark):
    text = named(spark, "role_join_max")
    assert "LeftSemi" in text and text.index("HashAggregate") < text.index("LeftSemi")


def test_mart_reads_games_once(spark):
    game = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    bound = b.staged_games(spark, SF_DIR)
    assert game.columns and count(r"lineitem\.parquet", plan(bound)) == 1
    text = plan(games.home_advantage_mart(bound))
    assert count(r"lineitem\.parquet", text) == 1
    assert count(r"\n\(\d+\) Exchange\n", text) == 3


def test_deduplication_cuts_rows_before_the_shuffle(spark):
    text = named(spark, "stage_keyed_dedup")
    assert count(r"row_number\(\), 1, Partial", text) == 1 and count(r"\n\(\d+\) Exchange\n", text) == 1


def test_top_rows_need_no_full_sort(spark):
    for name in ("zone_revenue_top1", "least_frequent_zone", "max_per_day_top1", "longest_sessions_topk"):
        assert "TakeOrderedAndProject" in named(spark, name)


def test_zone_names_are_joined_after_the_first_aggregate(spark):
    text = named(spark, "trips_per_zone")
    tree = text[: text.index("\n\n")]
    assert tree.index("BroadcastHashJoin") < tree.rindex("HashAggregate")


def test_partition_pruning(spark, tmp_path):
    events = b.table(spark, SF_DIR, "events")
    tables.write_by_date(events, str(tmp_path / "d"), "ts")
    text = plan(spark.read.parquet(str(tmp_path / "d")).filter(times.in_interval("ts_date", "2024-01-03", "2024-01-05")))
    assert re.search(r"PartitionFilters: \[.*ts_date", text)
    tables.write_by_month(events, str(tmp_path / "m"), "ts")
    read = spark.read.parquet(str(tmp_path / "m"))
    assert dict(read.dtypes)["month"] == "string"


def test_partitioned_writes_can_split_a_large_value(spark):
    text = plan(tables.laid_out(b.table(spark, SF_DIR, "events"), "event_type"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_reports_check_rows_in_one_pass(spark):
    assert count(r"\n\(\d+\) Scan parquet", named(spark, "quality_report")) == 2  # one more for uniqueness
