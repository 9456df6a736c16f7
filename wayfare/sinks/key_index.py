"""Which partitions may hold a key: the least and the greatest key of each, kept with the table's versions.

The index is on the first of an upsert's keys, where that is a whole number, a
date, a time with a zone or a text.  It prunes as far as keys and partitions go
together (numbers that grow with time, days); a key spread over all partitions
leaves all of them to be searched.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longer texts are no bounds; their partition counts as one that may hold any key.
LONGEST = 256

#: Least key, greatest key, and whether there is a NULL; the first two are None where all keys are NULL.
Bounds = tuple[int | str | None, int | str | None, bool]


def ordered(column: str, kind: T.DataType) -> Column | None:
    """The key as a whole number or text that sorts as it does, or None for a type without index."""
    key = F.col(column)
    if isinstance(kind, T.IntegralType):
        return key.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key)
    return key if kind == T.StringType() else None


def bounds_of(rows: DataFrame, key: str) -> dict[str, Bounds]:
    """The bounds of every partition folder that the rows are read from: a row for each folder comes to the driver."""
    sorts = ordered(key, rows.schema[key].dataType)
    if sorts is None:
        return {}
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+=[^/]*)/[^/]+$", 1)
    found = rows.select(folder.alias("folder"), sorts.alias("k")).groupBy("folder").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), F.count_if(F.col("k").isNull()).alias("nulls"))
    return {
        unquote(r.folder): (r.low, r.high, r.nulls > 0) for r in found.toLocalIterator()
        if max((len(v) for v in (r.low, r.high) if isinstance(v, str)), default=0) <= LONGEST
    }


def may_hold(rows: DataFrame, key: str, bounds: dict[str, Bounds]) -> set[str]:
    """The folders within whose bounds at least one of the rows' keys lies.

    Each task sorts its keys and looks every folder's bounds up among them, so
    that rows and folders are never paired; it returns the folders it hit.
    """
    sorts = ordered(key, rows.schema[key].dataType)
    if sorts is None:
        return set(bounds)
    folders = sorted(bounds)
    known = [i for i, f in enumerate(folders) if bounds[f][0] is not None]
    with_null = [i for i, f in enumerate(folders) if bounds[f][2]]
    text = rows.schema[key].dataType == T.StringType()
    low, high = (np.array([bounds[folders[i]][end] for i in known], dtype=object if text else np.int64) for end in (0, 1))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = np.zeros(len(folders), dtype=bool)
        for batch in batches:
            keys = batch.column(0)
            if keys.null_count:
                hit[with_null] = True
            there = keys.drop_null()
            found = np.sort(np.array(there.to_pylist(), dtype=object) if text else there.to_numpy(zero_copy_only=False))
            if len(found) and known:
                hit[known] |= np.searchsorted(found, high, "right") > np.searchsorted(found, low, "left")
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.flatnonzero(hit), pa.int32())})

    # no more rows than the table has folders
    return {folders[r.i] for r in rows.select(sorts.alias("k")).mapInArrow(hits, "i int").distinct().collect()}


def candidates(rows: DataFrame, key: str, live: Collection[str], bounds: dict[str, Bounds]) -> set[str]:
    """Of the live folders those to be searched for the rows' keys: the ones without bounds, too."""
    inside = {f: b for f, b in bounds.items() if f in live}
    return (set(live) - set(inside)) | (may_hold(rows, key, inside) if inside else set())
