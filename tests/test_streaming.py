import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.sinks import incremental
from wayfare.sources import streams as sources
from wayfare.streaming import late, queries, windows

D = dt.datetime
BASE = D(2025, 10, 1)


def at(minutes=0, seconds=0):
    return BASE + dt.timedelta(minutes=minutes, seconds=seconds)


def sessions_by_hand(events, gap):
    """Sessions per key, an event at a time."""
    found = []
    for key in {k for _, k in events}:
        times = sorted(t for t, k in events if k == key)
        first = last = times[0]
        n = 0
        for t in times:
            if t > last + gap:
                found.append((first, last + gap, key, n))
                first, n = t, 0
            last, n = t, n + 1
        found.append((first, last + gap, key, n))
    return sorted(found)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_table_sessions_equal_a_walk_over_events(spark, kind):
    draw = random.Random(3)
    events = [(at(seconds=draw.choice([0, 1, 299, 300, 301, 600]) * draw.randrange(60)), 0) for _ in range(400)]
    events += [(at(draw.randrange(5000), draw.randrange(60)), draw.randrange(1, 4)) for _ in range(600)]
    df = spark.createDataFrame(events, "t timestamp, k int").withColumn("t", F.col("t").cast(kind))
    got = sorted(tuple(r) for r in windows.sessions(df, "5 minutes", ["k"], time="t").collect())
    assert got == sessions_by_hand(events, dt.timedelta(minutes=5))


def test_session_ends_after_the_gap(spark):
    events = [(at(0), 1), (at(4, 59), 1), (at(9, 59), 1), (at(15), 1)]
    df = spark.createDataFrame(events, "t timestamp, k int")
    got = sorted(tuple(r) for r in windows.sessions(df, "5 minutes", ["k"], time="t").collect())
    assert got == [(at(0), at(14, 59), 1, 3), (at(15), at(20), 1, 1)]


class Feed:
    """A folder of JSON lines; every call adds a file, read as one batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        folder.mkdir()

    def add(self, *records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        file = self.folder / f"{self.n:04}.json"
        file.write_text("\n".join(lines) + "\n")
        # Files are read in the order of their times, so no two may be equal.
        os.utime(file, (1_700_000_000 + self.n,) * 2)
        self.n += 1

    def stream(self, schema):
        return sources.record_files(self.spark, str(self.folder), schema, files_per_batch=1)


def ride(time, zone=1, amount=1.0, distance=2.0):
    millis = int(time.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return dict(PULocationID=zone, DOLocationID=2, trip_distance=distance, total_amount=amount, tpep_pickup_datetime=millis)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def rides(feed):
    return sources.good_records(feed.stream(schemas.RIDE))


def test_pass_through_in_several_runs(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for minute in (1, 2):
        feed.add(ride(at(minute)), ride(at(minute, 30), zone=2))
        passed = windows.pass_through(rides(feed), "tpep_pickup_datetime", "pickup_datetime", "PULocationID", "total_amount")
        queries.drain_to_files(passed, out, checkpoint)
    got = sorted((r.pickup_datetime, r.PULocationID) for r in spark.read.parquet(out).collect())
    assert got == [(at(1), 1), (at(1, 30), 2), (at(2), 1), (at(2, 30), 2)]


def test_malformed_records_are_set_aside(spark, feed, tmp_path):
    feed.add(ride(at(1)), "{not json", '{"PULocationID": "x"}', ride(at(2)))
    parsed = feed.stream(schemas.RIDE)
    good = queries.drain_to_files(sources.good_records(parsed), str(tmp_path / "g"), str(tmp_path / "gc"))
    bad = queries.drain_to_files(sources.bad_records(parsed), str(tmp_path / "b"), str(tmp_path / "bc"))
    assert good.count() == 2
    assert {r.bad_record for r in bad.collect()} == {"{not json", '{"PULocationID": "x"}'}


def test_records_there_and_back(spark):
    df = spark.createDataFrame([(1, 2, 1.5, 2.5, 1700000000000)], schemas.RIDE)
    back = sources.good_records(sources.parse_records(sources.to_records(df), schemas.RIDE))
    assert back.collect() == df.collect()


def test_late_rows_count_while_their_window_is_open(spark, feed, tmp_path):
    feed.add(ride(at(10)), ride(at(61)))  # watermark 60:55 once this batch is done
    feed.add(ride(at(60, 20)))  # closes the first window; rows are held against it from the next batch on
    feed.add(ride(at(59)), ride(at(60, 30)))  # the first window has closed, the second has not
    feed.add(ride(at(200)))
    feed.add(ride(at(201)))
    events = windows.with_lateness(windows.with_event_time(rides(feed), millis="tpep_pickup_datetime"))
    stream = windows.revenue_per_hour(events)
    counter = queries.DropCounter(spark)
    query = queries.append_to_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), drain=True)
    queries.finish(query)
    got = sorted((r.window_start, r.num_trips) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(at(0), 1), (at(60), 3)]
    assert counter.stop() == 1


def test_text_times_with_and_without_fraction(spark):
    df = spark.createDataFrame([("2025-10-01 00:20:00",), ("2025-10-01 00:20:00.0",)], "lpep_pickup_datetime string")
    timed = windows.with_event_time(df, text="lpep_pickup_datetime")
    assert {r.event_timestamp for r in timed.collect()} == {at(20)}
    with pytest.raises(ValueError):
        windows.with_event_time(df)


def test_keyed_sink_updates_windows_over_runs(spark, feed, tmp_path):
    path, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")

    def drain():
        events = windows.with_lateness(windows.with_event_time(rides(feed), millis="tpep_pickup_datetime"))
        hourly = windows.revenue_per_hour(events)
        queries.finish(queries.upsert_to_table(hourly, path, ["window_start", "PULocationID"], checkpoint, drain=True))
        return {(r.window_start, r.PULocationID): (r.num_trips, r.total_revenue)
                for r in incremental.read_table(spark, path).collect()}

    feed.add(ride(at(10), amount=1.0), ride(at(20), amount=2.0), ride(at(10), zone=2))
    assert drain() == {(at(0), 1): (2, 3.0), (at(0), 2): (1, 1.0)}
    feed.add(ride(at(30), amount=4.0))
    feed.add(ride(at(70), amount=8.0))
    assert drain() == {(at(0), 1): (3, 7.0), (at(0), 2): (1, 1.0), (at(60), 1): (1, 8.0)}


def test_streamed_sessions_equal_those_of_the_table(spark, feed, tmp_path):
    draw = random.Random(11)
    events = sorted((at(draw.randrange(600), draw.randrange(60)), draw.randrange(3)) for _ in range(300))
    for i in range(0, 300, 75):
        feed.add(*[ride(t, zone=k) for t, k in events[i:i + 75]])
    feed.add(ride(at(5000), zone=99))
    timed = windows.with_lateness(windows.with_event_time(rides(feed), millis="tpep_pickup_datetime"))
    stream = windows.sessions(timed, "5 minutes", ["PULocationID"])
    out = queries.drain_to_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = sorted(tuple(r) for r in out.collect())
    assert got == sessions_by_hand(events, dt.timedelta(minutes=5))


def test_far_trips(spark):
    df = spark.createDataFrame([("5.0",), ("5.1",), ("12",)], "trip_distance string")
    assert tuple(windows.far_trips(df).first()) == (3, 2)


def test_a_running_query_checkpoints_and_goes_on(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for expected in (1, 2):
        feed.add(ride(at(expected)))
        passed = windows.pass_through(rides(feed), "tpep_pickup_datetime", "pickup_datetime", "PULocationID")
        query = queries.append_to_files(passed, out, checkpoint)
        query.processAllAvailable()
        query.stop()
        assert spark.read.parquet(out).count() == expected


def test_batches_are_handed_to_a_writer(spark, feed, tmp_path):
    feed.add(ride(at(1)), ride(at(2)))
    feed.add(ride(at(3)))
    path = str(tmp_path / "out")

    def write(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    passed = windows.pass_through(rides(feed), "tpep_pickup_datetime", "pickup_datetime", "PULocationID")
    queries.finish(queries.for_each_batch(passed, write, str(tmp_path / "checkpoint"), drain=True))
    counts = {r.batch: r["count"] for r in spark.read.parquet(path).groupBy("batch").count().collect()}
    assert counts == {0: 2, 1: 1}


@pytest.mark.parametrize("slots", [1, 3, 4096])
def test_sessions_across_ranges(spark, monkeypatch, slots):
    monkeypatch.setattr(windows, "SLOTS_PER_RANGE", slots)
    draw, begin = random.Random(slots), dt.datetime(2024, 1, 1)
    rows, wanted = [], []
    for key in ("a", "b", None):
        at, times = begin, []
        for _ in range(400):
            at += dt.timedelta(seconds=draw.choice([0, 1, 4, 9, 10, 11, 30]))
            times.append(at)
        rows += [(key, t) for t in times]
        runs = [[times[0], times[0], 0]]
        for t in times:
            if t - runs[-1][1] > dt.timedelta(seconds=10):
                runs.append([t, t, 0])
            runs[-1][1:] = [t, runs[-1][2] + 1]
        wanted += [(a, b + dt.timedelta(seconds=10), key, n) for a, b, n in runs]
    events = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    got = [tuple(r) for r in windows.sessions(events, "10 seconds", ["k"], time="t").collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_late_records_are_kept(spark, feed, tmp_path):
    feed.add(ride(at(10)), ride(at(61)))
    feed.add(ride(at(60, 20)))
    feed.add(ride(at(59), zone=7), ride(at(59), zone=7), ride(at(60, 30)))  # its hour ended before 60:55
    events = windows.with_event_time(rides(feed), millis="tpep_pickup_datetime")
    path, checkpoint = str(tmp_path / "late"), str(tmp_path / "checkpoint")
    assert late.read_late(spark, path, events).count() == 0
    queries.finish(late.late_to_files(events, path, checkpoint, "1 hour", drain=True))
    kept = [(r.PULocationID, r.event_timestamp, r.batch) for r in late.read_late(spark, path, events).collect()]
    assert kept == [(7, at(59), 2)] * 2
    feed.add(ride(at(5), zone=8), ride(at(61)))  # the next run goes on with the times seen so far
    queries.finish(late.late_to_files(events, path, checkpoint, "1 hour", drain=True))
    assert sorted((r.PULocationID, r.batch) for r in late.read_late(spark, path, events).collect()) == [(7, 2), (7, 2), (8, 3)]


def test_a_count_that_is_not_whole_is_an_error(spark):
    counter = queries.DropCounter(spark)
    counter.running.add("a stream that goes on")
    with pytest.raises(TimeoutError):
        counter.stop(patience=0.1)
