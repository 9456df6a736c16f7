import datetime as dt

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wayfare.operators import changes
from wayfare.sinks import incremental, manifest
from wayfare.sources.storage import Storage

D = dt.datetime
KIND = "t timestamp, k int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.select("t", "k", "v").collect()), key=str)


def frame(spark, *data):
    return spark.createDataFrame(list(data), KIND)


OLD = [(D(2024, 1, 1, 5), 1, "a"), (D(2024, 1, 2, 5), 2, "b"), (D(2024, 1, 3), 3, "c"), (None, 4, "d")]


def test_replace_interval(spark):
    new = frame(spark, (D(2024, 1, 2, 7), 9, "n"), (D(2024, 1, 3), 9, "end"), (D(2023, 12, 31), 9, "before"))
    got = changes.replace_interval(frame(spark, *OLD), new, "t", "2024-01-01", "2024-01-03")
    assert rows(got) == sorted([OLD[2], OLD[3], (D(2024, 1, 2, 7), 9, "n")], key=str)


def test_upsert(spark):
    target = frame(spark, (None, 1, "a"), (None, None, "b"), (None, 2, "c"))
    new = frame(spark, (None, None, "B"), (None, 2, "C"), (None, 3, "D"))
    once = changes.upsert(target, new, ["k"])
    assert rows(once) == sorted([(None, 1, "a"), (None, None, "B"), (None, 2, "C"), (None, 3, "D")], key=str)
    assert rows(changes.upsert(once, new, ["k"])) == rows(once)


def test_upsert_with_repeated_keys(spark):
    target = frame(spark, (None, 1, "a"))
    new = frame(spark, (D(2024, 1, 1), 1, "x"), (D(2024, 1, 2), 1, "y"))
    with pytest.raises(Exception, match="duplicate key"):
        changes.upsert(target, new, ["k"]).collect()
    assert rows(changes.upsert(target, new, ["k"], newest=[F.col("t").desc()])) == [(D(2024, 1, 2), 1, "y")]


def test_delete_insert(spark):
    target = frame(spark, (None, 1, "a"), (None, 1, "b"), (None, 2, "c"))
    new = frame(spark, (None, 1, "x"), (None, 1, "x"))
    assert rows(changes.delete_insert(target, new, ["k"])) == [(None, 1, "x"), (None, 1, "x"), (None, 2, "c")]


def stored(spark, path):
    return rows(incremental.read_table(spark, path))


def leftovers(path):
    """Folders beside the data and the versions, and version files that were not finished."""
    beside = [p.name for p in path.iterdir() if p.is_dir() and p.name not in (manifest.DATA, manifest.VERSIONS) and "=" not in p.name]
    return beside + [p.name for p in path.glob(".versions/*") if not p.name.endswith((".json", ".crc"))]


def files(path, *days):
    """Times of the live files of some days."""
    live = manifest.version(SparkSession.active(), str(path)).live
    return {p: p.stat().st_mtime_ns for d in days for p in (path / live[f"t_date={d}"]).glob("*.parquet")}


def test_stored_interval_at_the_edges(spark, tmp_path):
    table = tmp_path / "t"
    path = str(table)
    every = [(D(2024, 1, d, h), d, "old") for d in range(1, 6) for h in (3, 9, 15)]
    incremental.load(path, frame(spark, *every, (None, 0, "null")), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    # The third is emptied, the second and fourth are cut.
    new = frame(spark, (D(2024, 1, 2, 20), 2, "new"), (D(2024, 1, 4, 1), 4, "new"), (D(2024, 1, 4, 12), 4, "outside"))
    wanted = sorted(
        [r for r in every if not D(2024, 1, 2, 9) <= r[0] < D(2024, 1, 4, 9)]
        + [(None, 0, "null"), (D(2024, 1, 2, 20), 2, "new"), (D(2024, 1, 4, 1), 4, "new")], key=str)
    for _ in range(2):
        incremental.load(path, new, "t", "2024-01-02 09:00:00", "2024-01-04 09:00:00")
        assert stored(spark, path) == wanted
    assert "t_date=2024-01-03" not in manifest.version(spark, path).live and not leftovers(table)


def test_first_load_and_empty_interval(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.replace_interval(path, frame(spark, *OLD), "t", "2024-01-01", "2024-01-03")
    assert len(stored(spark, path)) == 2
    incremental.replace_interval(path, frame(spark, *OLD), "t", "2024-01-05", "2024-01-05")
    incremental.replace_interval(path, frame(spark).limit(0), "t", "2024-01-02", "2024-01-03")
    assert stored(spark, path) == [OLD[0]]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    table = tmp_path / "t"
    incremental.load(str(table), frame(spark, *OLD), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    before = files(table, "2024-01-01", "2024-01-03")
    incremental.replace_interval(str(table), frame(spark, (D(2024, 1, 2), 7, "n")), "t", "2024-01-02", "2024-01-03")
    assert before and before == files(table, "2024-01-01", "2024-01-03")


@pytest.mark.parametrize("step", ["write_partitioned", "write", "rename"])
def test_a_run_that_dies_changes_nothing_and_can_be_run_again(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    incremental.load(path, frame(spark, *OLD), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    new = frame(spark, (D(2024, 1, 1, 20), 1, "n"), (D(2024, 1, 3), 3, "n"))

    def failing(*_):
        raise OSError("killed")

    monkeypatch.setattr(incremental if step == "write_partitioned" else Storage, step, failing)
    with pytest.raises(OSError):
        incremental.replace_interval(path, new, "t", "2024-01-01 06:00:00", "2024-01-04")
    monkeypatch.undo()
    assert stored(spark, path) == sorted(OLD, key=str)
    incremental.replace_interval(path, new, "t", "2024-01-01 06:00:00", "2024-01-04")
    assert stored(spark, path) == sorted([OLD[0], (D(2024, 1, 1, 20), 1, "n"), (D(2024, 1, 3), 3, "n"), OLD[3]], key=str)
    manifest.vacuum(spark, path)
    assert not leftovers(tmp_path / "t") and len(manifest.versions(spark, path)) == 1
    assert len(stored(spark, path)) == 4


def test_a_reader_keeps_its_version_and_sees_none_in_between(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    incremental.load(path, frame(spark, *OLD), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    bound, seen = incremental.read_table(spark, path), []
    rename = Storage.rename

    def looking(self, source, target):
        seen.append(stored(spark, path))
        rename(self, source, target)
        seen.append(stored(spark, path))

    monkeypatch.setattr(Storage, "rename", looking)
    new = [(D(2024, 1, 1, 20), 1, "n"), (D(2024, 1, 3), 3, "n")]
    incremental.replace_interval(path, frame(spark, *new), "t", "2024-01-01", "2024-01-04")
    monkeypatch.undo()
    after = sorted([*new, OLD[3]], key=str)
    assert seen == [sorted(OLD, key=str), after], "one rename for any number of partitions"
    assert rows(bound) == sorted(OLD, key=str) and stored(spark, path) == after
    assert rows(incremental.read_table(spark, path, 1)) == sorted(OLD, key=str)


def test_two_writers_of_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.load(path, frame(spark, *OLD), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    old = manifest.version(spark, path)
    incremental.replace_interval(path, frame(spark), "t", "2024-01-01", "2024-01-02")
    with pytest.raises(OSError, match="there already"):
        manifest.commit(spark, path, old, old.schema, manifest.new_change(path), [])
    assert stored(spark, path) == sorted(OLD[1:], key=str)


def test_a_plain_table_is_version_zero(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, *OLD).withColumn("t_date", F.to_date("t")).write.partitionBy("t_date").parquet(path)
    assert manifest.version(spark, path).number == 0 and stored(spark, path) == sorted(OLD, key=str)
    new = (D(2024, 1, 2, 20), 2, "n")
    incremental.replace_interval(path, frame(spark, new), "t", "2024-01-02 10:00:00", "2024-01-03")
    assert stored(spark, path) == sorted([*OLD, new], key=str)
    manifest.vacuum(spark, path)
    assert stored(spark, path) == sorted([*OLD, new], key=str) and not (tmp_path / "t" / "t_date=2024-01-02").exists()


def test_stored_upsert_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")

    def day(df):
        return df.withColumn("day", F.to_date("t"))

    incremental.upsert(path, day(frame(spark, *OLD)), ["t", "k"], "day")
    new = frame(spark, (D(2024, 1, 2, 5), 2, "B"), (D(2024, 1, 2, 5), 5, "e"), (None, 4, "D"), (D(2024, 1, 9), 1, "z"))
    wanted = sorted([OLD[0], OLD[2], *map(tuple, new.collect())], key=str)
    for _ in range(2):
        incremental.upsert(path, day(new), ["t", "k"], "day")
        assert stored(spark, path) == wanted
    incremental.upsert(path, day(new.limit(0)), ["t", "k"], "day")
    assert stored(spark, path) == wanted
    with pytest.raises(ValueError, match="lack"):
        incremental.upsert(path, day(new).drop("v"), ["t", "k"], "day")


def test_stored_delete_insert_with_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a/b", 1), ("a:b c", 2), (None, 3), ("2024", 4)], "p string, n int")
    incremental.delete_insert(path, first, ["p"], "p")
    new = spark.createDataFrame([("a/b", 10), ("a/b", 11), (None, 30)], "p string, n int")
    incremental.delete_insert(path, new, ["p"], "p")
    got = sorted((tuple(r) for r in incremental.read_table(spark, path).select("p", "n").collect()), key=str)
    assert got == sorted([("a/b", 10), ("a/b", 11), (None, 30), ("a:b c", 2), ("2024", 4)], key=str)


def test_stored_upsert_moves_a_key_to_another_partition(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k int, day date, v string"
    first = [(1, dt.date(2024, 1, 1), "a"), (2, dt.date(2024, 1, 2), "b"), (None, dt.date(2024, 1, 3), "n")]
    incremental.upsert(path, spark.createDataFrame(first, kind), ["k"], "day")
    again = [(1, dt.date(2024, 1, 2), "c"), (3, dt.date(2024, 1, 9), "d"), (None, dt.date(2024, 1, 2), "m")]
    for _ in range(2):
        incremental.upsert(path, spark.createDataFrame(again, kind), ["k"], "day")
    rows = incremental.read_table(spark, path).select("k", "day", "v").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([again[0], again[1], again[2], first[1]], key=str)
    assert "day=2024-01-01" not in manifest.version(spark, path).live


def _numbered(spark, path, days):
    """A table of ten numbers a day, written by an upsert."""
    rows = [(D(2024, 1, d, h), d * 10 + h, "old") for d in range(1, days + 1) for h in range(10)]
    incremental.upsert(path, frame(spark, *rows).withColumn("t_date", F.to_date("t")), ["k"], "t_date")
    return rows


def test_only_partitions_that_may_hold_a_key_are_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    old = _numbered(spark, path, 6)
    for day in (2, 4, 6):  # whoever opens one of these fails
        live = manifest.version(spark, path).live[f"t_date=2024-01-0{day}"]
        for file in (tmp_path / "t" / live).glob("*.parquet"):
            file.write_bytes(b"no Parquet")
            file.with_name(f".{file.name}.crc").unlink()
    # 13 moves from the first day to the third, 55 stays on the fifth, 100 is new on the seventh.
    new = [(D(2024, 1, 3, 20), 13, "new"), (D(2024, 1, 5, 5), 55, "new"), (D(2024, 1, 7), 100, "new")]
    incremental.upsert(path, frame(spark, *new).withColumn("t_date", F.to_date("t")), ["k"], "t_date")
    now = manifest.version(spark, path)
    got = manifest.read(spark, path, now, folders={f"t_date=2024-01-0{d}" for d in (1, 3, 5, 7)}).drop("t_date")
    wanted = [r for r in old if r[0].day in (1, 3, 5) and r[1] not in (13, 55)] + new
    assert rows(got) == sorted(wanted, key=str)
    assert now.bounds["k"]["t_date=2024-01-03"] == (13, 39, False) and now.bounds["k"]["t_date=2024-01-02"] == (20, 29, False)
    twice = frame(spark, (D(2024, 1, 3), 31, "a"), (D(2024, 1, 5), 31, "b")).withColumn("t_date", F.to_date("t"))
    with pytest.raises(Exception, match="duplicate key"):
        incremental.upsert(path, twice, ["k"], "t_date")
    assert manifest.version(spark, path).number == now.number


def test_partitions_written_without_keys_are_measured_once(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.load(path, frame(spark, *OLD), "t", "2024-01-01", "2024-02-01", full_refresh=True)
    assert not manifest.version(spark, path).bounds
    for value in ("a", "b"):
        moved = frame(spark, (D(2024, 1, 9), OLD[0][1], value)).withColumn("t_date", F.to_date("t"))
        incremental.upsert(path, moved, ["k"], "t_date")
        now = manifest.version(spark, path)
        assert set(now.bounds["k"]) == set(now.live)
    by_key = {r[1]: r for r in OLD} | {OLD[0][1]: (D(2024, 1, 9), OLD[0][1], "b")}
    if len(by_key) == len(OLD):
        assert stored(spark, path) == sorted(by_key.values(), key=str)
    incremental.replace_interval(path, frame(spark, (D(2024, 1, 9), 77, "c")), "t", "2024-01-09", "2024-01-10")
    assert "t_date=2024-01-09" not in manifest.version(spark, path).bounds["k"], "replaced without keys: unknown again"


@pytest.mark.parametrize("kind, values", [
    ("string", ["a", "ab", "b", "é", "漢", "z" * 300]), ("date", ["1960-01-01", "2024-02-29"]),
    ("timestamp", ["1960-01-01 00:00:00.000001", "2024-02-29 12:00:00"]), ("smallint", ["-3", "0", "9"]),
    ("double", ["1.5", "2.5"])])
def test_keys_of_other_types_move(spark, tmp_path, kind, values):
    path = str(tmp_path / "t")

    def of(pairs):
        return spark.createDataFrame(pairs, "k string, p int").select(F.col("k").cast(kind).alias("k"), "p")

    keys = [*values, None]
    incremental.upsert(path, of([(k, i) for i, k in enumerate(keys)]), ["k"], "p")
    incremental.upsert(path, of([(k, len(keys) - 1 - i) for i, k in enumerate(keys)]), ["k"], "p")
    incremental.upsert(path, of([(keys[0], 99), (None, 98)]), ["k"], "p")
    wanted = of([(k, len(keys) - 1 - i) for i, k in enumerate(keys)][1:-1] + [(keys[0], 99), (None, 98)])
    got = incremental.read_table(spark, path)
    assert sorted(map(str, got.select("k", "p").collect())) == sorted(map(str, wanted.collect()))
