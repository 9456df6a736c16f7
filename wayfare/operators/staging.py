"""From ingested rows to staged ones: unions, lookups, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from wayfare.functions.columns import common_columns, rename, tolerant_cast
from wayfare.functions.numbers import as_column, cents
from wayfare.functions.times import Moment, in_interval


def combine_services(
    green: DataFrame, yellow: DataFrame, *, labels: tuple[str, str] = ("green", "yellow")
) -> DataFrame:
    """Both services on their common columns, with ``service_type``; duplicates stay."""
    green = rename(green, {"lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime"})
    yellow = rename(yellow, {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"})
    shared = common_columns(green, yellow)
    parts = [
        df.select(*shared).withColumn("service_type", F.lit(label)) for df, label in zip((green, yellow), labels)
    ]
    return parts[0].unionByName(parts[1])


def lookup_left(
    facts: DataFrame, lookup: DataFrame, *, key: str, lookup_key: str, take: Sequence[str]
) -> DataFrame:
    """Add lookup columns by key; rows without a match, or with a key that is
    no whole number, keep NULL.

    No broadcast hint: the planner broadcasts the lookup when its size allows
    and otherwise joins by sort-merge, where AQE splits a hot key.
    """
    side = lookup.select(F.col(lookup_key).cast("long").alias("_lookup_key"), *take)
    return (
        facts.withColumn("_fact_key", tolerant_cast(facts, key, LongType()))
        .join(side, F.col("_fact_key") == F.col("_lookup_key"), "left")
        .drop("_fact_key", "_lookup_key")
    )


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in an order that should be total.

    Spark cuts every map task's rows to one per key before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows sends at most
    one row per task.
    """
    w = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*[as_column(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def stage_trips_distinct(
    trips: DataFrame, lookup: DataFrame, start: Moment, end: Moment, *, pickup: str = "pickup_datetime"
) -> DataFrame:
    """Trips of the interval without exact duplicates, with the payment's name."""
    distinct = trips.filter(in_interval(pickup, start, end)).distinct()
    return lookup_left(
        distinct, lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"]
    )


def stage_trips_keyed(trips: DataFrame, lookup: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Trips of the interval, one per times, places and fare rounded to cents.

    A fare that has no cents (NaN, infinite, beyond the numeric type) counts as
    it is, so it equals neither NULL nor another such fare.  Of several, the first by service, payment name and exact fare stays.
    """
    named = lookup_left(
        trips.filter(in_interval("pickup_datetime", start, end)),
        lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"],
    ).select(
        "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
        "fare_amount", "taxi_type", "payment_type_name",
    )
    fare = cents("fare_amount")
    return first_per_key(
        named,
        ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", fare,
         F.when(fare.isNull(), F.col("fare_amount"))],
        ["taxi_type", "payment_type_name", "fare_amount"],
    )


def stage_fhv(raw: DataFrame, window: tuple[Moment, Moment] | None = None) -> DataFrame:
    """Typed for-hire trips with a known base; ``window`` cuts a sample period.

    Casts are strict: text that is no number or time is an error.
    """
    staged = raw.filter(F.col("dispatching_base_num").isNotNull()).select(
        F.col("dispatching_base_num").cast("string"),
        F.col("affiliated_base_number").cast("string"),
        F.col("pulocationid").cast("int").alias("pickup_location_id"),
        F.col("dolocationid").cast("int").alias("dropoff_location_id"),
        F.col("pickup_datetime").cast("timestamp"),
        F.col("dropoff_datetime").cast("timestamp"),
        F.col("sr_flag").cast("string"),
    )
    return staged.filter(in_interval("pickup_datetime", *window)) if window else staged
