"""Windows over events, as tables and as streams, with their SQL.

A stream in append mode never writes the windows still open when its input
ends, so the SQL of those leaves out windows that end after the watermark.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import topk
from wayfare.plans import bindings as b
from wayfare.plans.registry import query, sql_money_sum
from wayfare.scratch import fresh_path
from wayfare.sinks import incremental
from wayfare.streaming import queries as streams
from wayfare.streaming import late, windows

CLOSED = "(SELECT MAX(ts) - INTERVAL 5 SECOND FROM events)"


def _plain_time(df: DataFrame) -> DataFrame:
    """Window bounds without a zone, as the test tables have them."""
    bounds = [c for c in ("window_start", "window_end") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in bounds})


def _sql_tumbling(size: str, keys: str, aggregates: str, where: str = "TRUE") -> str:
    width = f"INTERVAL {size}"
    group = "1, 2" if keys else "1"
    return f"""WITH w AS (SELECT time_bucket({width}, pickup_datetime, TIMESTAMP '1970-01-01') AS window_start,
        {keys} {aggregates} FROM {b.RIDES} GROUP BY {group})
      SELECT * FROM w WHERE {where.format(end=f'window_start + {width}')}"""


_ZONE = '"PULocationID",'
_HOURLY = f"COUNT(*) AS num_trips, {sql_money_sum('total_amount')} AS total_revenue"


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.rides(spark, sf_dir)


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = windows.with_event_time(b.ride_stream(spark, sf_dir), time="pickup_datetime")
    return windows.with_lateness(events)


# Tables


@query(_sql_tumbling("1 HOUR", _ZONE, _HOURLY))
def tumbling_hour_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = windows.revenue_per_hour(_table(spark, sf_dir), time="pickup_datetime")
    return hourly


@query(_sql_tumbling("5 MINUTE", _ZONE, "COUNT(*) AS num_trips"))
def tumbling_5min_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trips_per_window(_table(spark, sf_dir), "5 minutes", time="pickup_datetime")


@query(_sql_tumbling("1 HOUR", "", f"{sql_money_sum('tip_amount')} AS total_tip_amount"))
def tumbling_hour_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tips_per_hour(_table(spark, sf_dir), time="pickup_datetime")


_SESSIONS = """WITH marked AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 5 MINUTE THEN 0 ELSE 1 END
      AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
    sessions AS (SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL 5 MINUTE AS window_end,
      user_id AS "PULocationID", COUNT(*) AS num_trips FROM numbered GROUP BY user_id, s)"""


@query(f"{_SESSIONS} SELECT * FROM sessions")
def session_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions(_table(spark, sf_dir), "5 minutes", ["PULocationID"], time="pickup_datetime")


@query(f"""{_SESSIONS} SELECT * FROM sessions ORDER BY num_trips DESC, window_start, "PULocationID" LIMIT 5""")
def longest_sessions_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(session_zone(spark, sf_dir), "num_trips", ties=["window_start", "PULocationID"], k=5)


@query("""SELECT MIN(ts) AS window_start, MAX(ts) + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS num_trips
    FROM (SELECT *, SUM(starts) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s
      FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 1 HOUR
        THEN 0 ELSE 1 END AS starts FROM events)) GROUP BY event_type, s""")
def session_few_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of keys that each hold a fifth of the table."""
    return windows.sessions(b.table(spark, sf_dir, "events"), "1 hour", ["event_type"], time="ts")


@query(_sql_tumbling("5 MINUTE", _ZONE, "COUNT(*) AS num_trips")
       + """ ORDER BY num_trips DESC, window_start, "PULocationID" LIMIT 3""")
def busiest_windows_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(tumbling_5min_zone(spark, sf_dir), "num_trips", ties=["window_start", "PULocationID"], k=3)


@query(_sql_tumbling("1 HOUR", "", f"{sql_money_sum('tip_amount')} AS total_tip_amount")
       + " ORDER BY total_tip_amount DESC, window_start LIMIT 5")
def best_hours_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(tumbling_hour_tips(spark, sf_dir), "total_tip_amount", ties=["window_start"], k=5)


@query("SELECT COUNT(*) AS total_messages, COUNT(*) FILTER (WHERE value > 5.0) AS far_trips FROM events")
def far_trip_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.far_trips(_table(spark, sf_dir))


# Streams


def _drained(stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    return _plain_time(
        streams.drain_to_files(stream, fresh_path(spark, "sink"), fresh_path(spark, "checkpoint"))
    )


@query("""SELECT user_id AS "PULocationID", value AS trip_distance, value AS total_amount,
      date_trunc('millisecond', ts)::TIMESTAMP AS pickup_datetime FROM events""")
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = b.ride_stream(spark, sf_dir).withColumn("tpep", F.unix_millis(F.col("pickup_datetime").cast("timestamp")))
    passed = windows.pass_through(rides, "tpep", "pickup_datetime", "PULocationID", "trip_distance", "total_amount")
    out = _drained(passed)
    return out.withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz"))


@query(_sql_tumbling("1 HOUR", _ZONE, _HOURLY, f"{{end}} <= {CLOSED}"))
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.revenue_per_hour(_stream(spark, sf_dir)))


@query(_sql_tumbling("5 MINUTE", _ZONE, "COUNT(*) AS num_trips", f"{{end}} <= {CLOSED}"))
def stream_tumbling_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.trips_per_window(_stream(spark, sf_dir), "5 minutes"))


@query(_sql_tumbling("1 HOUR", "", f"{sql_money_sum('tip_amount')} AS total_tip_amount", f"{{end}} <= {CLOSED}"))
def stream_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.tips_per_hour(_stream(spark, sf_dir)))


@query(f"{_SESSIONS} SELECT * FROM sessions WHERE window_end <= {CLOSED}")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(windows.sessions(_stream(spark, sf_dir), "5 minutes", ["PULocationID"]))


@query(_sql_tumbling("1 HOUR", _ZONE, _HOURLY))
def stream_upsert_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows kept by key in a table, open ones too."""
    path = fresh_path(spark, "hourly")
    hourly = windows.revenue_per_hour(_stream(spark, sf_dir))
    streams.finish(streams.upsert_to_table(
        hourly, path, ["window_start", "PULocationID"], fresh_path(spark, "checkpoint"), drain=True
    ))
    stored = incremental.read_table(spark, path).drop("window_start_date")
    return _plain_time(stored)


@query("SELECT COUNT(*) AS far_trips FROM events WHERE value > 5.0")
def stream_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    far = b.ride_stream(spark, sf_dir).filter(F.col("trip_distance") > 5.0).select("trip_distance")
    return windows.far_trips(_drained(far)).select("far_trips")


def _record_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = windows.with_event_time(b.record_stream(spark, sf_dir), time="pickup_datetime")
    return windows.revenue_per_hour(windows.with_lateness(events))


@query(f"""WITH {b.RECORDS} SELECT hour AS window_start, user_id AS "PULocationID", COUNT(*) AS num_trips,
    {sql_money_sum('value')} AS total_revenue FROM records
    WHERE NOT lost AND hour + INTERVAL 1 HOUR <= {CLOSED} GROUP BY 1, 2""")
def stream_late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records in four batches: state is carried over, and late records of closed hours are left out."""
    return _drained(_record_hours(spark, sf_dir))


@query(f"""WITH {b.RECORDS} SELECT COUNT(*) AS dropped FROM
    (SELECT DISTINCT file, hour, user_id FROM records WHERE lost)""")
def stream_dropped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many hours of a zone came too late, from the progress of every batch.

    Spark counts what reaches the state: one row per batch, hour and zone.
    """
    counter = streams.DropCounter(spark)
    streams.finish(streams.append_to_files(
        _record_hours(spark, sf_dir), fresh_path(spark, "sink"), fresh_path(spark, "checkpoint"), drain=True))
    # One row of its own; the number was counted while the records were worked off.
    return spark.range(1).select(F.lit(counter.stop()).cast("long").alias("dropped"))


@query(f"""WITH {b.RECORDS} SELECT ts AS pickup_datetime, user_id AS "PULocationID", value AS total_amount, file AS batch
    FROM records WHERE lost""")
def stream_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that came after their hour had closed, each with the batch it came in."""
    path, events = fresh_path(spark, "late"), windows.with_event_time(b.record_stream(spark, sf_dir), time="pickup_datetime")
    streams.finish(late.late_to_files(events, path, fresh_path(spark, "checkpoint"), "1 hour", drain=True))
    kept = late.read_late(spark, path, events)
    return kept.select(F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"), "PULocationID", "total_amount",
                       F.col("batch").cast("long").alias("batch"))


class _Stopped(RuntimeError):
    """Stands for an executor or driver that is lost between two batches."""


@query(f"""WITH {b.RECORDS} SELECT hour AS window_start, user_id AS "PULocationID", COUNT(*) AS num_trips,
    {sql_money_sum('value')} AS total_revenue FROM records
    WHERE NOT lost AND hour + INTERVAL 1 HOUR <= {CLOSED} GROUP BY 1, 2""")
def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped in the third of its batches, after that batch was written, and started again from the checkpoint.

    State and offsets go on where the last complete batch ended; the batch
    that was written but not complete comes again and replaces its own rows.
    """
    path, checkpoint = fresh_path(spark, "restarted"), fresh_path(spark, "checkpoint")
    hours = _record_hours(spark, sf_dir)

    def write(batch: DataFrame, number: int, stop_at: int | None) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if number == stop_at:
            raise _Stopped(f"stopped in batch {number}")

    first = streams.for_each_batch(hours, lambda df, n: write(df, n, 2), checkpoint, drain=True)
    try:
        streams.finish(first)
    except StreamingQueryException as error:
        if "stopped in batch 2" not in str(error):
            raise
    else:
        raise AssertionError("the first run was to be stopped")
    streams.finish(streams.for_each_batch(hours, lambda df, n: write(df, n, None), checkpoint, drain=True))
    return _plain_time(spark.read.schema(hours.schema).parquet(f"{path}/batch=*"))
