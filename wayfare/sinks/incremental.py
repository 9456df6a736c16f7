"""Changes to a partitioned Parquet table: only touched partitions are rewritten.

A change writes the touched partitions in their new state into a folder of its
own and then swaps the list of live folders (``manifest.py``).  No file moves,
a reader sees the table before the change or after it, and a run that dies in
between has changed nothing.  One writer at a time per table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.times import Moment, in_interval, to_moment
from wayfare.operators import changes
from wayfare.sinks import key_index, manifest
from wayfare.sinks.tables import write_partitioned
from wayfare.sources.storage import Storage

INCOMING = ".incoming"  # new rows of an upsert, written once and read twice


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table as it is now or was in a version, or None before its first write."""
    return manifest.read(spark, path, manifest.version(spark, path, version))


def _swap(
    spark: SparkSession, df: DataFrame, path: str, before: manifest.Version, partition: str, cluster: Sequence[str],
    replaced: Collection[str], key: str | None = None, bounds: dict[str, key_index.Bounds] | None = None,
) -> None:
    """Write partitions in their new state and make them the table's; those of ``replaced`` that got no row go.

    With ``key`` the bounds of the written partitions are kept beside those in ``bounds``.
    """
    change, known = manifest.new_change(path), {}
    write_partitioned(df, change, partition, cluster)
    if key is not None:
        written = spark.read.schema(df.schema).parquet(change)
        known = {key: {f: b for f, b in (bounds or {}).items() if f not in replaced} | key_index.bounds_of(written, key)}
    manifest.commit(spark, path, before, df.schema, change, replaced, known)


def replace_interval(
    path: str, new: DataFrame, key: str, start: Moment, end: Moment, *,
    partition: str | None = None, cluster: Sequence[str] = (),
) -> None:
    """Rows of ``[start, end)`` become those of ``new``; a repeat changes nothing.

    The table is partitioned by the day of ``key``, in column ``<key>_date``.
    Days wholly inside the interval are taken from ``new`` alone and never
    read; only a first or last day cut by the interval is read, for the rows
    that stay.
    """
    spark = new.sparkSession
    before = manifest.version(spark, path)
    partition = partition or f"{key}_date"
    start, end = to_moment(start), to_moment(end)
    if end <= start:
        return
    result = new.filter(in_interval(key, start, end)).withColumn(partition, F.to_date(key))
    first, last = start.date(), (end - dt.timedelta(microseconds=1)).date()
    cut = {f"{partition}={d}" for d, m in ((first, start), (last, end)) if m.time() != dt.time()}
    on_edge = manifest.read(spark, path, before, folders=cut)
    if on_edge is not None:
        result = changes.outside_interval(on_edge, key, start, end).unionByName(result)
    days = {f"{partition}={first + dt.timedelta(days=i)}" for i in range((last - first).days + 1)}
    _swap(spark, result, path, before, partition, cluster, days)


def upsert(
    path: str, new: DataFrame, keys: Sequence[str], partition: str, *,
    newest: Sequence[Column | str] | None = None, cluster: Sequence[str] = (),
) -> None:
    """Replace rows of equal key and add the others: one row per key, wherever the key lay before.

    Where the partition column is a key, a row can't change partition and only
    the partitions of the new rows are looked at.  Else keys are searched (no
    other column is read) in the partitions whose least and greatest key allow
    for one of the new rows; those bounds are measured once for each partition
    that a change wrote, and kept.
    """
    _rewrite(path, new, keys, partition, cluster, lambda old, rows: changes.upsert(old, rows, keys, newest))


def delete_insert(
    path: str, new: DataFrame, keys: Sequence[str], partition: str, cluster: Sequence[str] = ()
) -> None:
    """Drop the rows of every key value found in ``new``, in any partition, and add all new rows."""
    _rewrite(path, new, keys, partition, cluster, lambda old, rows: changes.delete_insert(old, rows, keys))


def _rewrite(
    path: str, new: DataFrame, keys: Sequence[str], partition: str, cluster: Sequence[str],
    change: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    spark = new.sparkSession
    before = manifest.version(spark, path)
    target = manifest.read(spark, path, before)
    if target is not None and set(target.columns) - set(new.columns):
        raise ValueError(f"new rows lack {sorted(set(target.columns) - set(new.columns))}")
    # Written once, so an expensive or unrepeatable input is computed once.
    incoming = f"{path}/{INCOMING}"
    new.write.mode("overwrite").parquet(incoming)
    rows = spark.read.schema(new.schema).parquet(incoming)
    places, key, bounds = rows.select(partition), None, {}
    if partition not in keys:
        key, bounds = keys[0], dict(before.bounds.get(keys[0], {}))
    if target is not None and key is not None:
        unknown = manifest.read(spark, path, before, schema=new.schema, folders=set(before.live) - set(bounds))
        if unknown is not None:
            bounds |= key_index.bounds_of(unknown, key)
        searched = key_index.candidates(rows, key, before.live, bounds)
        typed = manifest.read(spark, path, before, schema=new.schema, folders=searched)
        if typed is not None:
            held = changes.with_keys_of(typed.select(*new.columns), rows, keys)
            places = places.unionByName(held.select(partition))
    # No more values than the table has folders: what a listing would return.
    touched = [r[0] for r in places.distinct().collect()]
    if touched:
        replaced = _folders_of(before, touched)
        old = manifest.read(spark, path, before, schema=new.schema, folders=replaced)
        old = rows.filter(F.lit(False)) if old is None else old.select(*new.columns)
        _swap(spark, change(old, rows), path, before, partition, cluster, replaced, key, bounds)
    Storage(spark).delete(incoming)


def _folders_of(version: manifest.Version, values: Sequence) -> set[str]:
    """The table's folders of some partition values."""
    names = {"__HIVE_DEFAULT_PARTITION__" if v is None or v == "" else str(v).lower() if isinstance(v, bool) else str(v)
             for v in values}
    return {f for f in version.live if unquote(f.split("=", 1)[1]) in names}


def load(
    path: str, new: DataFrame, key: str, start: Moment, end: Moment, *, full_refresh: bool = False,
    cluster: Sequence[str] = (),
) -> None:
    """A run over ``[start, end)``: replace that window, or with ``full_refresh`` the whole table."""
    if full_refresh:
        replace_all(path, new.withColumn(f"{key}_date", F.to_date(key)), f"{key}_date", cluster)
    else:
        replace_interval(path, new, key, start, end, cluster=cluster)


def replace_all(path: str, new: DataFrame, partition: str, cluster: Sequence[str] = ()) -> None:
    """The table becomes ``new``; the old rows stay until all new ones are written."""
    spark = new.sparkSession
    before = manifest.version(spark, path)
    _swap(spark, new, path, before, partition, cluster, before.live)
