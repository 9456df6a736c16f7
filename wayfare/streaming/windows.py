"""Aggregates over event-time windows; the same function serves streams and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.numbers import money_sum
from wayfare.functions.times import from_millis, parse_time

EVENT_TIME = "event_timestamp"
LATENESS = "5 seconds"


def with_event_time(
    records: DataFrame, *, millis: str | None = None, text: str | None = None, time: str | None = None
) -> DataFrame:
    """Add the event time from epoch milliseconds, text or a time column."""
    given = [c for c in (
        from_millis(millis) if millis else None,
        parse_time(text) if text else None,
        F.col(time).cast("timestamp") if time else None,
    ) if c is not None]
    if len(given) != 1:
        raise ValueError("give one of millis, text, time")
    return records.withColumn(EVENT_TIME, given[0])


def with_lateness(events: DataFrame, bound: str = LATENESS, time: str = EVENT_TIME) -> DataFrame:
    """Accept events out of order up to a bound; on a table this changes nothing."""
    return events.withWatermark(time, bound) if events.isStreaming else events


def pass_through(records: DataFrame, millis: str, name: str, *columns: str) -> DataFrame:
    """Chosen columns and the epoch milliseconds as a time; no state."""
    return records.select(*columns, from_millis(millis).alias(name))


def tumbling(
    events: DataFrame, size: str, keys: Sequence[str], aggregates: Mapping[str, Column], *,
    time: str = EVENT_TIME, with_end: bool = False,
) -> DataFrame:
    """Aggregates per fixed window of ``size`` and key; no keys means all events."""
    bounds = [F.col("window.start").alias("window_start")]
    if with_end:
        bounds.append(F.col("window.end").alias("window_end"))
    return (
        events.groupBy(F.window(time, size), *keys)
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .select(*bounds, *keys, *aggregates)
    )


def trips_per_window(events: DataFrame, size: str, zone: str = "PULocationID", **options) -> DataFrame:
    return tumbling(events, size, [zone], {"num_trips": F.count(F.lit(1))}, **options)


def revenue_per_hour(events: DataFrame, zone: str = "PULocationID", amount: str = "total_amount", **options) -> DataFrame:
    aggregates = {"num_trips": F.count(F.lit(1)), "total_revenue": money_sum(amount)}
    return tumbling(events, "1 hour", [zone], aggregates, **options)


def tips_per_hour(events: DataFrame, tip: str = "tip_amount", **options) -> DataFrame:
    return tumbling(events, "1 hour", [], {"total_tip_amount": money_sum(tip)}, **options)


def sessions(events: DataFrame, gap: str, keys: Sequence[str], *, time: str = EVENT_TIME) -> DataFrame:
    """Runs of events of one key with no pause longer than ``gap``.

    A session lasts from its first event to ``gap`` after its last; events
    exactly ``gap`` apart belong together.
    """
    if events.isStreaming:
        return (
            events.groupBy(F.session_window(time, gap), *keys)
            .agg(F.count(F.lit(1)).alias("num_trips"))
            .select(
                F.col("session_window.start").alias("window_start"),
                F.col("session_window.end").alias("window_end"), *keys, "num_trips",
            )
        )
    return _table_sessions(events, gap, keys, time)


#: Slots of the gap's length that one task puts together to sessions, for one key.
SLOTS_PER_RANGE = 4096


def _table_sessions(events: DataFrame, gap: str, keys: Sequence[str], time: str) -> DataFrame:
    """Sessions of a table, safe where one key holds most events and lasts for years.

    Events within one slot of the length of the gap are always of one session,
    so they are first reduced to count, first and last time per key and slot,
    mostly before the shuffle.  Slots are joined to sessions within ranges of
    ``SLOTS_PER_RANGE`` slots, each range by itself.  Only the first and last
    session of a range can go on beyond it: these, two rows a range, are joined
    once more along each key.
    """
    pause = F.expr(f"INTERVAL {gap}")
    width = F.unix_micros(F.timestamp_seconds(F.lit(0)) + pause) * SLOTS_PER_RANGE
    slots = events.groupBy(F.window(time, gap).alias("_slot"), *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(time).alias("_first"), F.max(time).alias("_last")
    )
    slots = slots.withColumn("_range", F.floor(F.unix_micros(F.col("_first").cast("timestamp")) / width))
    within = Window.partitionBy(*keys, "_range")
    parts = _joined(slots, pause, [*keys, "_range"]).withColumn(
        "_border", (F.min("_first").over(within) == F.col("_first")) | (F.max("_last").over(within) == F.col("_last")))
    whole = parts.filter("NOT _border").select(*keys, "_first", "_last", "_n")
    stitched = _joined(parts.filter("_border"), pause, keys).select(*keys, "_first", "_last", "_n")
    return whole.unionByName(stitched).select(
        F.col("_first").alias("window_start"), (F.col("_last") + pause).alias("window_end"), *keys,
        F.col("_n").alias("num_trips"),
    )


def _joined(parts: DataFrame, pause: Column, keys: Sequence[str]) -> DataFrame:
    """Stretches of one key joined where no more than the pause lies between them."""
    in_order = Window.partitionBy(*keys).orderBy("_first")
    before = F.lag("_last").over(in_order)
    starts = F.when(before.isNull() | (F.col("_first") > before + pause), 1).otherwise(0)
    numbered = parts.withColumn("_starts", starts).withColumn("_session", F.sum("_starts").over(in_order))
    return numbered.groupBy(*keys, "_session").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))


def far_trips(events: DataFrame, distance: str = "trip_distance", above: float = 5.0) -> DataFrame:
    """Records read, and those with a distance above a bound."""
    return events.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col(distance).cast("double") > above).alias("far_trips"),
    )
