"""Monthly trip files: choose them by date range, read them as one table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare import schemas
from wayfare.functions.columns import cast_to, keep_present, resolve_aliases, union_by_name, with_constants
from wayfare.functions.times import Moment, in_interval, to_moment
from wayfare.sources import files

# The names one column goes by in the files of the services.
# The times of a service are the first name found.
TRIP_ALIASES: dict[str, tuple[str, ...]] = {
    "pickup_datetime": ("tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"),
    "dropoff_datetime": ("tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"),
    "payment_type": ("payment_type", "payment_type_id", "paymenttype"),
}
LOCATION_ALIASES: dict[str, tuple[str, ...]] = {
    "pickup_location_id": ("PULocationID", "pulocationid", "pickup_location_id"),
    "dropoff_location_id": ("DOLocationID", "dolocationid", "dropoff_location_id"),
}

TRIP_FILE = "{root}/{service}_tripdata_{year}-{month:02d}.parquet"


def months_between(start: Moment, end: Moment) -> Iterator[tuple[int, int]]:
    """Year and month of each month that overlaps ``[start, end)``."""
    start, end = to_moment(start), to_moment(end)
    first = dt.datetime(start.year, start.month, 1)
    while first < end:
        yield first.year, first.month
        first = (first + dt.timedelta(days=32)).replace(day=1)


def month_paths(root: str, service: str, start: Moment, end: Moment, pattern: str = TRIP_FILE) -> list[str]:
    return [
        pattern.format(root=root.rstrip("/"), service=service, year=y, month=m)
        for y, m in months_between(start, end)
    ]


def read_months(
    spark: SparkSession,
    root: str,
    service: str,
    start: Moment,
    end: Moment,
    schema: StructType,
    *,
    missing: str = "skip",
    pattern: str = TRIP_FILE,
    aliases: Mapping[str, Sequence[str]] = TRIP_ALIASES,
) -> DataFrame | None:
    """The files of one service, or None when there is none in the range.

    ``missing="skip"`` passes over months without a file, ``"error"`` does
    not.  A file that is there but cannot be read is an error either way.
    """
    if missing not in ("skip", "error"):
        raise ValueError("missing is 'skip' or 'error'")
    wanted = month_paths(root, service, start, end, pattern)
    paths = files.existing(spark, wanted)
    if missing == "error" and len(paths) < len(wanted):
        raise FileNotFoundError(", ".join(sorted(set(wanted) - set(paths))))
    if not paths:
        return None

    def several_names(columns: Sequence[str]) -> bool:
        """Which name counts is a matter of each file, so files that name a column differently stay apart."""
        return any(len(set(names).intersection(columns)) > 1 for names in aliases.values())

    runs = files.merged_runs(spark, paths, several_names)
    return union_by_name([cast_to(resolve_aliases(run, aliases), schema) for run in runs])


def ingest_trips(
    spark: SparkSession,
    root: str,
    services: Sequence[str],
    start: Moment,
    end: Moment,
    *,
    extracted_at: dt.datetime | None = None,
    missing: str = "skip",
    pattern: str = TRIP_FILE,
) -> DataFrame:
    """Raw trips of several services, cut to the columns staging needs.

    Rows stay as they are in the files: no row is dropped, bad times are NULL.
    """
    schema = schemas.INGESTED_TRIPS
    frames = []
    for service in services:
        trips = read_months(spark, root, service, start, end, schema, missing=missing, pattern=pattern)
        if trips is not None:
            frames.append(with_constants(trips, taxi_type=service))
    if not frames:
        return files.empty(spark, schema)
    stamp = F.lit(extracted_at) if extracted_at else F.current_timestamp()
    return keep_present(union_by_name(frames).withColumn("extracted_at", stamp), schema.names)


def ingest_located_trips(
    spark: SparkSession,
    root: str,
    services: Sequence[str],
    start: Moment,
    end: Moment,
    *,
    missing: str = "error",
    pattern: str = TRIP_FILE,
) -> DataFrame:
    """Trips picked up in ``[start, end)`` with both times known, all columns kept.

    This stricter variant names the locations and fails on an absent month.
    """
    schema = schemas.INGESTED_TRIPS_LOCATED
    aliases = {**TRIP_ALIASES, **LOCATION_ALIASES}
    frames = []
    for service in services:
        trips = read_months(
            spark, root, service, start, end, schema, missing=missing, pattern=pattern, aliases=aliases
        )
        if trips is not None:
            inside = trips.filter(in_interval("pickup_datetime", start, end))
            frames.append(with_constants(inside, taxi_type=service))
    if not frames:
        return files.empty(spark, schema)
    return union_by_name(frames).dropna(subset=["pickup_datetime", "dropoff_datetime"])
