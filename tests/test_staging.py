import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.functions import columns
from wayfare.operators import staging, topk, trips
from wayfare.schemas import INGESTED_TRIPS_LOCATED, PAYMENT_LOOKUP, ZONES

D = dt.datetime
START, END = "2024-01-01", "2024-01-02"


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([(0, "Flex Fare"), (1, "Credit card"), (2, "Cash")], PAYMENT_LOOKUP)


def located(spark, rows, kind="int"):
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int,"
                                     f"dropoff_location_id int, fare_amount double, payment_type {kind}, taxi_type string")
    assert df.columns == INGESTED_TRIPS_LOCATED.names
    return df


A, B = D(2024, 1, 1), D(2024, 1, 1, 1)


def test_distinct_keeps_what_differs(spark, lookup):
    rows = [(A, B, 1, 2, 5.0, 1, "green")] * 3 + [(A, B, 1, 2, 5.001, 1, "green"), (D(2024, 1, 2), B, 1, 2, 5.0, 1, "green")]
    staged = staging.stage_trips_distinct(located(spark, rows), lookup, START, END)
    assert sorted(r.fare_amount for r in staged.collect()) == [5.0, 5.001]


def test_keyed_takes_fares_in_cents_and_the_first_service(spark, lookup):
    rows = [(A, B, 1, 2, 5.001, 2, "yellow"), (A, B, 1, 2, 5.0, 1, "green"), (A, B, 1, 2, 5.01, 1, "green"),
            (A, B, None, 2, 5.0, None, "green"), (A, B, None, 2, 5.0, None, "yellow")]
    staged = staging.stage_trips_keyed(located(spark, rows), lookup, START, END)
    got = sorted(((r.pickup_location_id, r.fare_amount, r.taxi_type, r.payment_type_name) for r in staged.collect()), key=str)
    assert got == [(1, 5.0, "green", "Credit card"), (1, 5.01, "green", "Credit card"), (None, 5.0, "green", None)]


def test_keyed_takes_fares_that_round_to_one_amount_as_one(spark, lookup):
    rows = [(A, B, 1, 2, 1.005, 1, "green"), (A, B, 1, 2, 1.01, 1, "green"), (A, B, 1, 2, float("nan"), 1, "green")]
    staged = staging.stage_trips_keyed(located(spark, rows), lookup, START, END)
    assert staged.count() == 2


@pytest.mark.parametrize("value, name", [(None, None), ("99", None), ("abc", None), ("1", "Credit card"), (" 2 ", "Cash")])
def test_lookup_of_text_keys(spark, lookup, value, name):
    row = located(spark, [(A, B, 1, 2, 5.0, value, "green")], "string")
    found = staging.lookup_left(row, lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"])
    assert found.first().payment_type_name == name


def test_lookup_with_a_hot_key_without_broadcast(spark, lookup, tmp_path):
    lookup.write.parquet(str(tmp_path / "lookup"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))  # a file has a size the planner knows
    facts = spark.range(30000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).cast("int").alias("payment_type"), "id")

    def found():
        named = staging.lookup_left(facts, lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"])
        return named, sorted(named.groupBy("payment_type", "payment_type_name").count().collect(), key=str)

    broadcast, rows = found()
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        merged, other = found()
        assert "SortMergeJoin" in merged._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert rows == other and sum(r["count"] for r in rows) == 30000


def test_reports_of_a_group_without_fares(spark, lookup):
    rows = [(A, B, 1, 2, None, 1, "green"), (A, B, 1, 3, None, 1, "green"), (A, B, 1, 2, 2.5, 2, "green")]
    staged = staging.lookup_left(located(spark, rows), lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"])
    a = {r.payment_type_name: r for r in trips.trips_report(staged, START, END).collect()}
    b = {r.payment_type: r for r in trips.trips_report_with_average(staged, START, END).collect()}
    assert (a["Credit card"].trip_count, a["Credit card"].total_fare) == (2, 0.0)
    assert (b["Credit card"].total_fare, b["Credit card"].avg_fare) == (None, None)
    assert (a["Cash"].total_fare, b["Cash"].avg_fare) == (2.5, 2.5)


def test_combine_services_by_name(spark):
    green = spark.createDataFrame([(A, 1, 2.0, 9)], "lpep_pickup_datetime timestamp, PULocationID int, fare_amount double, ehail_fee int")
    yellow = spark.createDataFrame([(3.0, 4, A)], "fare_amount double, PULocationID int, tpep_pickup_datetime timestamp")
    both = staging.combine_services(green, yellow)
    assert both.columns == ["pickup_datetime", "PULocationID", "fare_amount", "service_type"]
    assert sorted(map(tuple, both.collect()), key=str) == [(A, 1, 2.0, "green"), (A, 4, 3.0, "yellow")]
    assert columns.common_columns(green, yellow) == ["PULocationID", "fare_amount"]


def test_fhv_needs_a_base_and_strict_numbers(spark):
    kind = "dispatching_base_num string, affiliated_base_number string, pickup_datetime string, dropoff_datetime string, pulocationid string, dolocationid int, sr_flag string"
    rows = [("B1", None, "2019-01-05 00:00:00", None, "7", 8, None), (None, "B2", None, None, None, None, None),
            ("B3", None, "2019-03-01 00:00:00", None, None, None, "1")]
    raw = spark.createDataFrame(rows, kind)
    assert staging.stage_fhv(raw).count() == 2
    row = staging.stage_fhv(raw, ("2019-01-01", "2019-02-01")).first()
    assert (row.dispatching_base_num, row.pickup_location_id, row.pickup_datetime) == ("B1", 7, D(2019, 1, 5))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_fhv(raw.withColumn("pulocationid", F.lit("x"))).collect()


def test_top_breaks_ties_and_puts_null_last(spark):
    df = spark.createDataFrame([("c", 2), ("b", 2), ("a", None), ("d", 1)], "k string, n int")
    assert [r.k for r in topk.top(df, "n", ties=["k"], k=4).collect()] == ["b", "c", "d", "a"]
    assert [r.k for r in topk.top(df, "n", ties=["k"], k=4, ascending=True).collect()] == ["d", "b", "c", "a"]
    assert topk.sample_rows(df, 2).count() == 2


def test_zones_that_share_a_name_and_text_ids(spark):
    zones = spark.createDataFrame([("56", "Corona"), ("57", "Corona"), ("7", "Astoria")], "LocationID string, Zone string")
    rides = spark.createDataFrame([(56,), (57,), (7,), (7,), (7,), (99,)], "PULocationID int")
    counts = {r.zone: r.trip_count for r in trips.trips_per_zone(rides, zones).collect()}
    assert counts == {"Corona": 2, "Astoria": 3}
    assert trips.least_frequent_zone(rides, zones).first().zone == "Corona"
    assert "Borough" in ZONES.names


def test_monthly_fact_reads(spark, ts):
    rows = [(1, ts("2020-01-05"), "green", 10.0), (1, ts("2020-12-31T23:59:59"), "green", 5.5), (2, ts("2020-02-01"), "green", 15.4),
            (2, ts("2021-01-01"), "green", 99.0), (2, ts("2020-01-01"), "yellow", 99.0), (9, ts("2020-03-01"), "green", 15.0)]
    df = spark.createDataFrame(rows, "PULocationID int, pickup_datetime timestamp, service_type string, total_amount double")
    monthly = trips.monthly_zone_revenue(df, amounts=["total_amount"], averages=[])
    zones = spark.createDataFrame([(1, "A"), (2, "B")], "LocationID int, Zone string")
    named = trips.name_zones(monthly, zones)
    assert named.count() == 6
    assert tuple(trips.top_zone_of_year(named, "green", 2020).first()) == ("A", 15.5)
    assert trips.trips_in_month(named, "green", 2020, 1).first().total_trips == 1


def test_fares_without_cents_stay_apart(spark):
    at, inf, nan = dt.datetime(2024, 1, 5, 8), float("inf"), float("nan")
    fares = [None, None, nan, nan, inf, -inf, 1e40, 2e40, 2e40, 1.001, 1.004]
    trips = spark.createDataFrame(
        [(at, at, 1, 2, f, "1", "green") for f in fares],
        "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int, dropoff_location_id int, "
        "fare_amount double, payment_type string, taxi_type string")
    lookup = spark.createDataFrame([(1, "card")], "payment_type_id int, payment_type_name string")
    got = staging.stage_trips_keyed(trips, lookup, "2024-01-01", "2024-02-01").collect()
    assert sorted(repr(r.fare_amount) for r in got) == sorted(map(repr, [None, nan, inf, -inf, 1e40, 2e40, 1.001]))
