"""One key with a third of all rows: how even is the work of the tasks?

python -m tests.skew_trial [rows] prints, for each operator, the largest number
of records one task read from a shuffle, beside the rows it started from.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators import changes, quality, staging, trips
from wayfare.session import local_session
from wayfare.streaming import windows


def skewed(spark, rows: int) -> DataFrame:
    """Trips over a year, a third of them in zone 0 and with payment type 1."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, numPartitions=32).select(
        F.col("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id"), F.lit(31_536_000))).alias("pickup_datetime"),
        F.when(hot, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000))).alias("PULocationID"),
        F.when(hot, 1).otherwise(F.pmod(F.hash("id"), F.lit(7))).alias("payment_type"),
        (F.pmod(F.hash("id", F.lit(2)), F.lit(10_000)) / 100).alias("total_amount"),
    )


def operators(spark, df: DataFrame) -> dict[str, DataFrame]:
    zones = spark.range(100_000).select(F.col("id").alias("LocationID"), F.concat(F.lit("z"), F.col("id") % 500).alias("Zone"))
    lookup = spark.range(7).select(F.col("id").alias("payment_type_id"), F.col("id").cast("string").alias("payment_type_name"))
    monthly = df.withColumn("service_type", F.lit("green"))
    return {
        "monthly_zone_revenue": trips.monthly_zone_revenue(monthly, amounts=["total_amount"], averages=["id"]),
        "trips_per_zone": trips.trips_per_zone(df, zones),
        "count_distinct": trips.count_distinct(df, "PULocationID"),
        "first_per_key": staging.first_per_key(df, ["PULocationID"], ["pickup_datetime", "id"]),
        "lookup_left": staging.lookup_left(df, lookup, key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"]),
        "tumbling_hour": windows.revenue_per_hour(df, time="pickup_datetime"),
        "sessions": windows.sessions(df, "5 minutes", ["PULocationID"], time="pickup_datetime"),
        "duplicated_values": quality.duplicated_values(df, "PULocationID"),
        "upsert": changes.upsert(df, df.withColumn("id", F.col("id") * 2), ["id"]),
        "delete_insert": changes.delete_insert(df, df.filter("PULocationID < 50000"), ["PULocationID"]),
    }


def largest_reads(log: Path) -> tuple[int, float]:
    most, slowest = 0, 0.0
    for line in log.read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
            most = max(most, event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
            slowest = max(slowest, (event["Task Info"]["Finish Time"] - event["Task Info"]["Launch Time"]) / 1000)
    return most, slowest


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    print(f"{rows} rows, {rows // 3} of one key")
    names = None
    while names is None or names:
        folder = Path(tempfile.mkdtemp(prefix="skew-"))
        spark = local_session("skew", 8, **{
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": str(folder), "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false", "spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        })
        every = operators(spark, skewed(spark, rows))
        names = list(every) if names is None else names
        name = names.pop(0)
        begin = time.time()
        every[name].write.format("noop").mode("overwrite").save()
        spent = time.time() - begin
        spark.stop()
        most, slowest = largest_reads(next(folder.iterdir()))
        print(f"{name:22} largest shuffle read of a task {most:9} records, longest task {slowest:6.2f} s, all {spent:6.2f} s", flush=True)


if __name__ == "__main__":
    main()
