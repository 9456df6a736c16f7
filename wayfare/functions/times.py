from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayfare.functions.numbers import as_column

Moment = dt.date | dt.datetime | str


def to_moment(value: Moment) -> dt.datetime:
    """A naive datetime in UTC from a date, a datetime or ISO text."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def moment_literal(value: Moment) -> Column:
    """A text literal; compared with a date or time column it takes that type.

    So one literal serves DATE, TIMESTAMP and TIMESTAMP_NTZ columns and the
    comparison is still pushed down to the Parquet scan.
    """
    return F.lit(to_moment(value).isoformat(sep=" "))


def in_interval(column: Column | str, start: Moment, end: Moment) -> Column:
    """``start <= column < end``; NULL times are in no interval."""
    column = as_column(column)
    return (column >= moment_literal(start)) & (column < moment_literal(end))


def on_day(column: Column | str, day: Moment) -> Column:
    """The rows of one calendar day, as a range that Parquet can skip by."""
    first = to_moment(day).replace(hour=0, minute=0, second=0, microsecond=0)
    return in_interval(column, first, first + dt.timedelta(days=1))


def in_year(column: Column | str, year: int) -> Column:
    return in_interval(column, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def in_month(column: Column | str, year: int, month: int) -> Column:
    first = dt.date(year, month, 1)
    return in_interval(column, first, (first + dt.timedelta(days=32)).replace(day=1))


def month_start(column: Column | str) -> Column:
    """First moment of the month, without a zone, whatever the column's kind of time."""
    return F.date_trunc("month", as_column(column)).cast("timestamp_ntz")


def parse_time(text: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp from text; a fraction of a second is cut off, bad text is NULL."""
    return F.try_to_timestamp(F.substring(as_column(text), 1, 19), F.lit(pattern))


def parse_date(text: Column | str) -> Column:
    """Date from text or time; bad text is NULL."""
    return as_column(text).cast("string").try_cast("date")


def from_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(as_column(millis))


def to_millis(time: Column | str) -> Column:
    return F.unix_millis(as_column(time).cast("timestamp"))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Span in hours, counted in whole seconds."""
    seconds = F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))
    return seconds.cast("double") / F.lit(3600.0)
