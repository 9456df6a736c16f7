"""New rows against a table that is already there: what the table becomes.

These functions only describe the result; ``wayfare.sinks.incremental`` writes
it, touching no more partitions than it must.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import Moment, in_interval
from wayfare.operators.staging import first_per_key


def outside_interval(df: DataFrame, key: str, start: Moment, end: Moment) -> DataFrame:
    """Rows whose key is not in ``[start, end)``; those with a NULL key too."""
    return df.filter(~F.coalesce(in_interval(key, start, end), F.lit(False)))


def replace_interval(target: DataFrame, new: DataFrame, key: str, start: Moment, end: Moment) -> DataFrame:
    """Delete the target's rows in ``[start, end)``, insert the new ones of it."""
    inside = new.filter(in_interval(key, start, end))
    return outside_interval(target, key, start, end).unionByName(inside)


def _same_keys(target: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    t, g = target.alias("t"), other.alias("g")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    return t.join(g, reduce(Column.__and__, same), how)


def _without(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys are not among ``gone``, where NULL equals NULL."""
    return _same_keys(target, gone, keys, "left_anti")


def with_keys_of(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys are among those of ``new``, where NULL equals NULL."""
    return _same_keys(target, new.select(*keys).distinct(), keys, "left_semi")


def single_per_key(new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a key comes twice.

    Only keys are counted, with map-side combine; the rows themselves are
    neither moved nor sorted for it.
    """
    again = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    named = again.agg(F.min(F.to_json(F.struct(*keys))).alias("_key")).scalar()
    return new.filter(
        F.when(named.isNotNull(), F.raise_error(F.concat(F.lit("duplicate key in new rows: "), named))).otherwise(F.lit(True))
    )


def upsert(
    target: DataFrame, new: DataFrame, keys: Sequence[str], newest: Sequence[Column | str] | None = None
) -> DataFrame:
    """New rows replace the target's rows of equal key and are added otherwise.

    A key repeated in ``new`` is an error unless ``newest`` says which row wins.
    """
    one_each = first_per_key(new, keys, newest) if newest else single_per_key(new, keys)
    return _without(target, new.select(*keys), keys).unionByName(one_each)


def delete_insert(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target's rows of every key value found in ``new``, add all new rows."""
    return _without(target, new.select(*keys).distinct(), keys).unionByName(new)

