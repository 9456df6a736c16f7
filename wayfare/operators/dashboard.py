"""What the dashboard shows, from the home-advantage mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.numbers import money_avg, safe_divide

FLAG = "is_bubble_season"


def sidebar_filter(
    mart: DataFrame, years: tuple[int, int] | None = None, teams: Sequence[str] = ()
) -> DataFrame:
    """Seasons from the first year to the last, both kept; no teams means all."""
    if years:
        mart = mart.filter(F.col("season_year").between(*years))
    return mart.filter(F.col("team_abbr").isin(*teams)) if teams else mart


def season_bounds(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("season_year").alias("first_season"), F.max("season_year").alias("last_season"))


def latest_names(mart: DataFrame) -> DataFrame:
    """The name each team last went by; of two in one season, the later by letter."""
    named = mart.filter(F.col("team_name").isNotNull())
    return named.groupBy("team_abbr").agg(
        F.max_by("team_name", F.struct("season_year", "team_name")).alias("team_name")
    )


def team_all_time(mart: DataFrame) -> DataFrame:
    """Home record per team over all seasons under its latest name, best first."""
    named = F.when(F.col("team_name").isNotNull(), F.struct("season_year", "team_name"))
    return (
        mart.groupBy("team_abbr")
        .agg(
            F.max(named)["team_name"].alias("team_name"),
            F.sum("home_wins").alias("home_wins"),
            F.sum("home_games").alias("home_games"),
        )
        .withColumn("home_win_pct", safe_divide("home_wins", "home_games"))
        .orderBy(F.col("home_win_pct").desc(), "team_abbr")
    )


def league_all_time(mart: DataFrame) -> DataFrame:
    """Home win share over all teams and seasons."""
    return mart.agg(safe_divide(F.sum("home_wins"), F.sum("home_games")).alias("league_avg"))


def season_series(mart: DataFrame, flagged: bool | None = None) -> DataFrame:
    """League home win share by season; only (un)flagged seasons if asked."""
    kept = mart if flagged is None else mart.filter(F.col(FLAG) == flagged)
    # The value is the same in all rows of a season, so any of them will do.
    return (
        kept.groupBy("season_year", FLAG)
        .agg(F.max("league_home_win_pct").alias("league_home_win_pct"))
        .orderBy("season_year", FLAG)
    )


def attendance_series(mart: DataFrame, since: int = 1980) -> DataFrame:
    """League attendance and home win share by season."""
    return (
        mart.filter(F.col("season_year") >= since)
        .groupBy("season_year", FLAG)
        .agg(
            F.max("league_avg_attendance").alias("league_avg_attendance"),
            F.max("league_home_win_pct").alias("league_home_win_pct"),
        )
        .orderBy("season_year", FLAG)
    )


def impact_by_team(mart: DataFrame) -> DataFrame:
    """Mean home advantage in flagged and in other seasons, for teams with both."""
    delta, flagged = F.col("home_advantage_delta"), F.col(FLAG)
    return (
        mart.groupBy("team_abbr")
        .agg(
            money_avg(F.when(~flagged, delta)).alias("normal_delta"),
            money_avg(F.when(flagged, delta)).alias("bubble_delta"),
            F.count_if(~flagged).alias("_normal"),
            F.count_if(flagged).alias("_flagged"),
        )
        .filter((F.col("_normal") > 0) & (F.col("_flagged") > 0))
        .drop("_normal", "_flagged")
        .withColumn("delta_change", F.col("bubble_delta") - F.col("normal_delta"))
        .orderBy(F.col("normal_delta").desc(), "team_abbr")
    )


def summary_metrics(mart: DataFrame) -> DataFrame:
    """One row: win shares, mean advantage, mean attendance where it is known."""
    flagged = F.col(FLAG)
    crowd = F.when(F.col("avg_attendance") > 0, F.col("avg_attendance"))
    overall = safe_divide(F.sum("home_wins"), F.sum("home_games"))
    bubble = safe_divide(
        F.sum(F.when(flagged, F.col("home_wins"))), F.sum(F.when(flagged, F.col("home_games")))
    )
    return mart.agg(
        overall.alias("overall_home_win_pct"),
        bubble.alias("bubble_home_win_pct"),
        (bubble - overall).alias("bubble_change"),
        money_avg("home_advantage_delta").alias("avg_home_advantage_delta"),
        F.avg(crowd).cast("long").alias("avg_attendance"),
    )
