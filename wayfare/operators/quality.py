"""Checks on tables, reported as rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import Moment, moment_literal


@dataclass(frozen=True)
class Check:
    """A named test of one column; ``failures`` aggregates to a count.

    A check without ``failures`` is one for uniqueness, which needs a
    grouping of its own.
    """

    name: str
    column: str
    failures: Column | None = None


def not_null(column: str) -> Check:
    return Check("not_null", column, F.count_if(F.col(column).isNull()))


def unique(*columns: str) -> Check:
    """Failures are the values, or combinations of several columns' values, that occur more than once; those with a NULL are left out."""
    return Check("unique", ",".join(columns))


def accepted_values(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, F.count_if(~F.col(column).isin(*values)))


def positive(column: str) -> Check:
    return Check("positive", column, F.count_if(F.col(column) <= 0))


def non_negative(column: str) -> Check:
    return Check("non_negative", column, F.count_if(F.col(column) < 0))


def custom(name: str, value: Column, expected) -> Check:
    """An aggregate over the table that must equal ``expected``."""
    return Check(name, "", F.when(value == F.lit(expected), 0).otherwise(1).cast("long"))


def row_count_positive(name: str = "row_count_greater_than_zero") -> Check:
    return custom(name, F.when(F.count(F.lit(1)) > 0, 1).otherwise(0), 1)


def duplicated_values(df: DataFrame, *columns: str) -> DataFrame:
    """The values that break uniqueness, with their number of rows."""
    counts = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``check, column, failures, status``.

    All checks but those for uniqueness share a single pass over the table;
    each of the others reads its own column only.
    """
    in_one_pass = [c for c in checks if c.failures is not None]
    parts = []
    if in_one_pass:
        counted = df.agg(*[c.failures.alias(f"_{i}") for i, c in enumerate(in_one_pass)])
        rows = [
            F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), F.col(f"_{i}").alias("failures"))
            for i, c in enumerate(in_one_pass)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    for c in checks:
        if c.failures is None:
            parts.append(
                duplicated_values(df, *c.column.split(","))
                .agg(F.count(F.lit(1)).alias("failures"))
                .select(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), "failures")
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def require(report: DataFrame) -> None:
    """Raise if a check of a report failed; a report has one row per check."""
    failed = report.filter(F.col("status") != "pass").collect()
    if failed:
        raise ValueError("; ".join(f"{r.check}({r.column}): {r.failures}" for r in failed))


def freshness(
    df: DataFrame, loaded_at: str, as_of: Moment, *,
    warn_after: dt.timedelta = dt.timedelta(hours=24), error_after: dt.timedelta = dt.timedelta(hours=48),
) -> DataFrame:
    """Age of the newest row at ``as_of``: pass, warn or error; no rows is an error."""
    newest = df.agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
    now = moment_literal(as_of).cast("timestamp_ntz")

    def older_than(limit: dt.timedelta) -> Column:
        return F.col("max_loaded_at") + F.lit(limit) < now

    status = (
        F.when(F.col("max_loaded_at").isNull() | older_than(error_after), "error")
        .when(older_than(warn_after), "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", status)


def staged_games_checks() -> list[Check]:
    required = (
        "game_id", "game_date", "season_year", "team_abbr_home", "wl_home", "home_win", "is_bubble_season",
    )
    return [*map(not_null, required), unique("game_id"), accepted_values("wl_home", ["W", "L"])]


def home_advantage_checks() -> list[Check]:
    required = (
        "season_year", "team_abbr", "team_name", "is_bubble_season", "home_win_pct", "away_win_pct",
        "home_advantage_delta", "league_home_win_pct",
    )
    # The mart's claim: one row per team and season.  Its group key is finer, so a renamed team breaks the claim.
    return [*map(not_null, required), unique("team_abbr", "season_year")]


def payment_lookup_checks() -> list[Check]:
    return [not_null("payment_type_id"), unique("payment_type_id"), not_null("payment_type_name")]


def staged_trips_checks() -> list[Check]:
    no_negative_distance = custom("non_negative_trip_distance", F.count_if(F.col("trip_distance") < 0), 0)
    return [
        not_null("pickup_datetime"), non_negative("passenger_count"), non_negative("trip_distance"),
        no_negative_distance,
    ]


def trips_report_checks() -> list[Check]:
    return [non_negative("trip_count"), non_negative("total_fare")]
