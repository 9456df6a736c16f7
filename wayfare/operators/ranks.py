"""Exact ranks of large columns: counts over ever narrower intervals, no sort of the column."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Equal intervals that a pass counts, and distinct values that the last pass may bring to the driver.
BINS, LAST = 4096, 20_000


def quantile(df: DataFrame, values: Mapping[str, Column], share: float = 0.5) -> dict[str, float | None]:
    """For each name the smallest value that ``share`` of the known values do not exceed; None without values.

    Exact at any number of rows.  All names are counted together in one job a
    pass: a pass cuts the interval of each into ``BINS`` and goes on with the
    one that holds the rank, between its own least and largest value, until
    that is one value or few enough rows are left to count each value.  The
    driver sees ``BINS`` rows a name and pass.  NaN counts as the largest.
    """
    columns = df.select(*[v.cast("double").alias(n) for n, v in values.items()])
    infinite = {"low": float("-inf"), "high": float("inf"), "none": float("nan")}

    def bounds(name: str) -> Column:
        value = F.col(f"`{name}`")
        finite = F.when(F.abs(value) < infinite["high"], value)
        return F.struct(
            F.min(finite).alias("least"), F.max(finite).alias("most"), F.count(finite).alias("n"),
            *(F.count_if(value == F.lit(x)).alias(k) for k, x in infinite.items())).alias(name)

    first = columns.agg(*map(bounds, values)).first()
    found: dict[str, float | None] = {}
    open_: dict[str, tuple[float, float, int, int]] = {}  # least and largest value, rank and rows between them
    for name in values:
        told = first[name]
        rank = math.ceil(share * (told.n + told.low + told.high + told.none)) or 1
        if rank <= told.low:
            found[name] = infinite["low"]
        elif rank <= told.low + told.n:
            open_[name] = (told.least, told.most, rank - told.low, told.n)
        else:
            beyond = rank - told.low - told.n
            found[name] = infinite["high"] if beyond <= told.high else infinite["none"] if beyond <= told.high + told.none else None
    while open_:
        for name in [n for n, (least, most, _, _) in open_.items() if least == most]:
            found[name] = open_.pop(name)[0]
        places = {n: _place(n, *o) for n, o in open_.items()}
        if places:
            _narrow(columns, places, open_)
    return {name: found[name] for name in values}


def _place(name: str, least: float, most: float, rank: int, n: int) -> Column:
    """Where a value is counted: in its interval, or by itself where few rows are left; null outside."""
    value = F.col(f"`{name}`")
    inside = value.between(least, most)
    if n <= LAST or most / 2 - least / 2 == 0:
        return F.when(inside, value)
    share = (value / 2 - least / 2) / (most / 2 - least / 2)
    return F.when(inside, F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("double"))


def _narrow(columns: DataFrame, places: dict[str, Column], open_: dict[str, tuple[float, float, int, int]]) -> None:
    """Count, and go on with the interval that holds the rank."""
    rows = columns.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), p.alias("place"), F.col(f"`{n}`").alias("value")) for n, p in places.items()])))
    counted = rows.filter(F.col("place").isNotNull()).groupBy("name", "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    by_name: dict[str, list] = {}
    for row in counted.collect():
        by_name.setdefault(row.name, []).append(row)
    for name, intervals in by_name.items():
        rank = open_[name][2]
        for row in sorted(intervals, key=lambda r: r.place):
            if rank <= row.n:
                open_[name] = (row.least, row.most, rank, row.n)
                break
            rank -= row.n
