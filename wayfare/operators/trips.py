"""Questions asked of trip tables.

Column names are arguments; the defaults are those of the public trip files.
Zone names are joined onto aggregates, never onto trips: a zone that holds a
third of the trips is one row by then, and the join is small even where the
lookup is too large to broadcast.  No join is hinted; the planner broadcasts
a side when its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.numbers import money_avg, money_sum
from wayfare.functions.times import Moment, hours_between, in_interval, in_month, in_year, month_start
from wayfare.operators.topk import top

PICKUP = "pickup_datetime"

# The amounts summed per month, and the columns averaged.
AMOUNTS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
)
AVERAGES = ("passenger_count", "trip_distance")


def count_rows(trips: DataFrame, where: Column | None = None, name: str = "trip_count") -> DataFrame:
    kept = trips if where is None else trips.filter(where)
    return kept.agg(F.count(F.lit(1)).alias(name))


def count_by(trips: DataFrame, *keys: str, name: str = "trip_count") -> DataFrame:
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_distinct(trips: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Exact; NULL is not counted.  Distinct values are found per task first."""
    return trips.agg(F.countDistinct(column).alias(name or f"distinct_{column}"))


def time_range(trips: DataFrame, pickup: str = PICKUP) -> DataFrame:
    return trips.agg(F.min(pickup).alias("min_pickup"), F.max(pickup).alias("max_pickup"))


def longest_hours(trips: DataFrame, pickup: str = PICKUP, dropoff: str = "dropoff_datetime") -> DataFrame:
    return trips.agg(F.max(hours_between(pickup, dropoff)).alias("longest_trip_hours"))


def longest_trip_day(
    trips: DataFrame, pickup: str = PICKUP, distance: str = "trip_distance", below: float = 100.0
) -> DataFrame:
    """The day with the longest trip, leaving out distances of ``below`` and more."""
    per_day = (
        trips.filter(F.col(distance) < below)
        .groupBy(F.to_date(pickup).alias("pickup_date"))
        .agg(F.max(distance).alias("max_trip_distance"))
    )
    return top(per_day, "max_trip_distance", ties=["pickup_date"])


def zone_revenue(
    trips: DataFrame, zones: DataFrame, start: Moment, end: Moment, *,
    pickup: str = PICKUP, zone: str = "PULocationID", amount: str = "total_amount",
    zone_id: str = "LocationID", zone_name: str = "Zone",
) -> DataFrame:
    """Revenue per pickup zone name over an interval."""
    per_id = (
        trips.filter(in_interval(pickup, start, end))
        .groupBy(F.col(zone).alias("zone_id")).agg(money_sum(amount).alias("amount"))
    )
    names = zones.select(F.col(zone_id).cast("long").alias("zone_id"), F.col(zone_name).alias("pickup_zone"))
    return (
        per_id.join(names, "zone_id")
        .groupBy("pickup_zone").agg(money_sum("amount").alias("total_amount_sum"))
    )


def top_zone_by_revenue(trips: DataFrame, zones: DataFrame, start: Moment, end: Moment, **columns: str) -> DataFrame:
    return top(zone_revenue(trips, zones, start, end, **columns), "total_amount_sum", ties=["pickup_zone"])


def largest_tips_from(
    trips: DataFrame, zones: DataFrame, from_zone: str, start: Moment, end: Moment, *,
    pickup: str = PICKUP, pickup_zone: str = "PULocationID", dropoff_zone: str = "DOLocationID",
    tip: str = "tip_amount", zone_id: str = "LocationID", zone_name: str = "Zone",
) -> DataFrame:
    """Largest tip per dropoff zone for trips that began in one zone.

    The zone table plays both roles.  The origin's few ids filter the trips
    before anything is aggregated; names of targets join the aggregate.
    """
    origin = zones.filter(F.col(zone_name) == from_zone).select(F.col(zone_id).alias("pu")).distinct()
    target = zones.select(F.col(zone_id).alias("do"), F.col(zone_name).alias("dropoff_zone"))
    per_target = (
        trips.filter(in_interval(pickup, start, end))
        .select(F.col(pickup_zone).alias("pu"), F.col(dropoff_zone).alias("do"), F.col(tip).alias("tip"))
        .join(origin, "pu", "left_semi")
        .groupBy("do").agg(F.max("tip").alias("tip"))
    )
    return per_target.join(target, "do").groupBy("dropoff_zone").agg(F.max("tip").alias("max_tip"))


def trips_per_zone(
    trips: DataFrame, zones: DataFrame, *, zone: str = "PULocationID",
    zone_id: str = "LocationID", zone_name: str = "Zone",
) -> DataFrame:
    """Trips per zone name; ids without a zone are left out.

    ``zones`` may come from a CSV read as text: the ids are cast.
    """
    per_id = trips.groupBy(F.col(zone).cast("long").alias("zone_id")).agg(F.count(F.lit(1)).alias("n"))
    names = zones.select(F.col(zone_id).cast("long").alias("zone_id"), F.col(zone_name).alias("zone"))
    return per_id.join(names, "zone_id").groupBy("zone").agg(F.sum("n").alias("trip_count"))


def least_frequent_zone(trips: DataFrame, zones: DataFrame, **columns: str) -> DataFrame:
    return top(trips_per_zone(trips, zones, **columns), "trip_count", ties=["zone"], ascending=True)


def monthly_zone_revenue(
    trips: DataFrame, *, zone: str = "PULocationID", pickup: str = PICKUP, service: str = "service_type",
    amounts: Sequence[str] = AMOUNTS, averages: Sequence[str] = AVERAGES,
    start: Moment | None = None, end: Moment | None = None,
) -> DataFrame:
    """Sums and averages per zone, month and service, with the number of trips.

    Whoever asks for some months only gives their bounds: a range on the raw
    time reaches the scan, a condition on the month does not.
    """
    short = {**{a: a for a in amounts}, "fare_amount": "fare"}
    if start is not None and end is not None:
        trips = trips.filter(in_interval(pickup, start, end))
    return trips.groupBy(
        F.col(zone).alias("revenue_zone"),
        month_start(pickup).alias("revenue_month"),
        F.col(service).alias("service_type"),
    ).agg(
        *[money_sum(a).alias(f"revenue_monthly_{short[a]}") for a in amounts],
        *[F.avg(a).alias(f"avg_monthly_{a}") for a in averages],
        F.count(F.lit(1)).alias("total_monthly_trips"),
    )


def name_zones(
    monthly: DataFrame, zones: DataFrame, *, zone_id: str = "LocationID", zone_name: str = "Zone"
) -> DataFrame:
    """Add ``pickup_zone``, the name of ``revenue_zone``; unknown ids keep NULL."""
    names = zones.select(F.col(zone_id).alias("revenue_zone"), F.col(zone_name).alias("pickup_zone"))
    return monthly.join(names, "revenue_zone", "left")


def top_zone_of_year(
    monthly: DataFrame, service: str, year: int, amount: str = "revenue_monthly_total_amount"
) -> DataFrame:
    """The zone with the largest revenue of a service in a year, from the monthly table."""
    per_zone = (
        monthly.filter((F.col("service_type") == service) & in_year("revenue_month", year))
        .groupBy("pickup_zone").agg(money_sum(amount).alias("total_revenue"))
    )
    return top(per_zone, "total_revenue", ties=["pickup_zone"])


def trips_in_month(monthly: DataFrame, service: str, year: int, month: int) -> DataFrame:
    kept = monthly.filter((F.col("service_type") == service) & in_month("revenue_month", year, month))
    return kept.agg(F.sum("total_monthly_trips").alias("total_trips"))


def trips_report(
    trips: DataFrame, start: Moment, end: Moment, *, pickup: str = PICKUP, fare: str = "fare_amount"
) -> DataFrame:
    """Trips and fares per day, service and payment name; 0 where no fare is known."""
    return (
        trips.filter(in_interval(pickup, start, end))
        .groupBy(F.to_date(pickup).alias("date"), "taxi_type", "payment_type_name")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            money_sum(F.coalesce(F.col(fare), F.lit(0.0))).alias("total_fare"),
        )
    )


def trips_report_with_average(
    trips: DataFrame, start: Moment, end: Moment, *, pickup: str = PICKUP, fare: str = "fare_amount"
) -> DataFrame:
    """As ``trips_report`` with the mean fare; NULL where no fare is known."""
    return (
        trips.filter(in_interval(pickup, start, end))
        .groupBy(
            F.to_date(pickup).alias("trip_date"), "taxi_type", F.col("payment_type_name").alias("payment_type")
        )
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            money_sum(fare).alias("total_fare"),
            money_avg(fare).alias("avg_fare"),
        )
    )
