"""The layered flows from raw files to reports, one call per layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions.times import Moment, in_interval, to_moment
from wayfare.operators import games, quality, staging, trips
from wayfare.sinks import incremental, tables
from wayfare.sources import files, months


def run_trips(
    spark: SparkSession, raw: str, lookup_csv: str, warehouse: str, services: Sequence[str],
    start: Moment, end: Moment, *, full_refresh: bool = False, extracted_at: dt.datetime | None = None,
) -> DataFrame:
    """Ingest, stage and report the trips of ``[start, end)``; returns the report.

    Ingested rows are appended, staged and reported ones replaced for the
    interval, so a repeated run leaves the same report.  Each layer is read
    back from its table: a lost executor costs a re-read, not the whole flow.
    """
    lookup = files.seed(spark, lookup_csv, schemas.PAYMENT_LOOKUP)
    quality.require(quality.quality_report(lookup, quality.payment_lookup_checks()))

    ingested_path, staged_path, report_path = (f"{warehouse}/{t}" for t in ("ingested", "staged", "report"))
    raw_trips = months.ingest_trips(spark, raw, services, start, end, extracted_at=extracted_at)
    tables.write_by_date(
        raw_trips, ingested_path, "pickup_datetime", mode="overwrite" if full_refresh else "append"
    )

    # A repeated run appends the same trips with a later extraction time; they
    # are one trip again, extracted first at the earliest time.
    known = [c for c in schemas.INGESTED_TRIPS.names if c != "extracted_at"]
    ingested = (
        spark.read.parquet(ingested_path)
        .filter(in_interval("pickup_datetime_date", _day(start), _day_after(end)))
        .groupBy(*known).agg(F.min("extracted_at").alias("extracted_at"))
    )
    staged = staging.stage_trips_distinct(ingested, lookup, start, end)
    incremental.load(staged_path, staged, "pickup_datetime", start, end, full_refresh=full_refresh)
    stored = incremental.read_table(spark, staged_path)
    quality.require(quality.quality_report(stored, quality.staged_trips_checks()))

    # The report's grain is the day: days the interval cuts are reported whole.
    report = trips.trips_report(
        stored.filter(in_interval("pickup_datetime_date", _day(start), _day_after(end))), _day(start), _day_after(end)
    )
    incremental.load(report_path, report, "date", _day(start), _day_after(end), full_refresh=full_refresh)
    reported = incremental.read_table(spark, report_path).drop("date_date")
    quality.require(quality.quality_report(reported, quality.trips_report_checks()))
    return reported


def _day(moment: Moment) -> dt.date:
    return to_moment(moment).date()


def _day_after(end: Moment) -> dt.date:
    """The first day not touched by an interval that ends before ``end``."""
    moment = to_moment(end)
    whole = moment.time() == dt.time()
    return moment.date() if whole else moment.date() + dt.timedelta(days=1)


def run_home_advantage(
    spark: SparkSession, game_path: str, info_path: str, warehouse: str, *, flagged_season: int = games.FLAGGED_SEASON
) -> DataFrame:
    """Clean, stage and aggregate games; returns the stored mart."""
    cleaned = games.clean_games(
        files.parquet(spark, game_path), files.parquet(spark, info_path, ["game_id", "attendance"]), flagged_season
    )
    tables.write_by_month(cleaned, f"{warehouse}/games", "game_date", ["team_abbreviation_home"])
    staged = games.stage_games(files.parquet(spark, f"{warehouse}/games"))
    quality.require(quality.quality_report(staged, quality.staged_games_checks()))
    mart = games.home_advantage_mart(staged)
    tables.write_by_integer_range(mart, f"{warehouse}/home_advantage", "season_year", 1946, 2030, ["team_abbr"])
    stored = files.parquet(spark, f"{warehouse}/home_advantage").drop("season_year_from")
    quality.require(quality.quality_report(stored, quality.home_advantage_checks()))
    return stored


def run_fhv(
    spark: SparkSession, sources: dict[str, str], warehouse: str, window: tuple[Moment, Moment] | None = None
) -> DataFrame:
    """Convert the monthly CSV files not converted yet and stage all of them."""
    root = f"{warehouse}/fhv_raw"
    tables.convert_csv(spark, sources, root, schemas.FHV_TRIPS)
    merged = files.parquet_merged(spark, [f"{root}/{name}" for name in sources])
    return staging.stage_fhv(merged, window)
