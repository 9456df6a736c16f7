"""Home advantage: from raw games to the mart per team and season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from wayfare.functions.columns import tolerant_cast
from wayfare.functions.numbers import round_to_long, safe_divide, text_to_whole
from wayfare.functions.strings import clean_code, title_case
from wayfare.functions.times import parse_date

# Ids of regular seasons begin with this digit; the season
# whose games the flag marks.
REGULAR_SEASON = "2"
FLAGGED_SEASON = 2019


def clean_games(game: DataFrame, game_info: DataFrame, flagged_season: int = FLAGGED_SEASON) -> DataFrame:
    """Regular-season games with season, win flag and attendance.

    Text that is no date or number becomes NULL; games without a date, a
    result or a home team are dropped.  A game without info keeps NULL
    attendance, and one with two infos gives two rows: check that ids of
    ``game_info`` are unique.
    """
    attendance = game_info.select("game_id", tolerant_cast(game_info, "attendance", IntegerType()))
    season_id = F.col("season_id").cast("string")
    season_year = text_to_whole(F.substring("season_id", -4, 4), "int")
    regular = game.filter(season_id.startswith(REGULAR_SEASON))
    cleaned = regular.select(
        "game_id",
        parse_date("game_date").alias("game_date"),
        season_id.alias("season_id"),
        "team_id_home", "team_abbreviation_home", "team_name_home", "wl_home",
        tolerant_cast(regular, "pts_home", IntegerType()),
        "team_id_away", "team_abbreviation_away", "team_name_away", "wl_away",
        tolerant_cast(regular, "pts_away", IntegerType()),
    ).withColumns({
        "season_year": season_year,
        "home_win": F.when(F.col("wl_home") == "W", 1).otherwise(0),
        "is_bubble_season": F.when(season_year == flagged_season, True).otherwise(False),
    })
    known = cleaned.dropna(subset=["game_date", "wl_home", "team_abbreviation_home"])
    return known.join(attendance, "game_id", "left")


def stage_games(cleaned: DataFrame) -> DataFrame:
    """One row per game with the mart's names and types."""
    return cleaned.filter(
        F.col("game_date").isNotNull() & F.col("wl_home").isNotNull() & F.col("team_abbreviation_home").isNotNull()
    ).select(
        "game_id",
        F.col("game_date").cast("date"),
        F.col("season_id").cast("string"),
        F.col("season_year").cast("long"),
        F.col("team_id_home").cast("string"),
        clean_code("team_abbreviation_home").alias("team_abbr_home"),
        title_case("team_name_home").alias("team_name_home"),
        "wl_home",
        F.col("pts_home").cast("long"),
        F.col("team_id_away").cast("string"),
        clean_code("team_abbreviation_away").alias("team_abbr_away"),
        title_case("team_name_away").alias("team_name_away"),
        "wl_away",
        F.col("pts_away").cast("long"),
        F.col("home_win").cast("long"),
        F.col("is_bubble_season").cast("boolean"),
        F.col("attendance").cast("long"),
    )


def _away_win() -> Column:
    return F.when(F.col("wl_away") == "W", 1).otherwise(0)


def home_stats(games: DataFrame) -> DataFrame:
    """Home record and mean attendance per season, team, name and flag."""
    return games.groupBy(
        "season_year",
        F.col("team_abbr_home").alias("team_abbr"),
        F.col("team_name_home").alias("team_name"),
        "is_bubble_season",
    ).agg(
        F.count(F.lit(1)).alias("home_games"),
        F.sum("home_win").alias("home_wins"),
        safe_divide(F.sum("home_win"), F.count(F.lit(1))).alias("home_win_pct"),
        F.avg("attendance").alias("avg_attendance"),
    )


def away_stats(games: DataFrame) -> DataFrame:
    """Away record per season and team."""
    return games.groupBy("season_year", F.col("team_abbr_away").alias("team_abbr")).agg(
        F.count(F.lit(1)).alias("away_games"),
        F.sum(_away_win()).alias("away_wins"),
        safe_divide(F.sum(_away_win()), F.count(F.lit(1))).alias("away_win_pct"),
    )


def league_avg(home: DataFrame) -> DataFrame:
    """Season averages over ``home_stats``.

    The win share is weighted by games; attendance is the mean of team means.
    """
    return home.groupBy("season_year").agg(
        safe_divide(F.sum("home_wins"), F.sum("home_games")).alias("league_home_win_pct"),
        F.avg("avg_attendance").alias("league_avg_attendance"),
    )


def home_advantage_mart(games: DataFrame) -> DataFrame:
    """Home against away record per team and season, beside the league's.

    Equal to joining ``home_stats``, ``away_stats`` and ``league_avg``, but the
    games are read and shuffled once: they shrink to one row per season and
    pair of teams, and each such row then counts for both of its teams.  What
    follows works on at most teams x teams rows a season.  Teams with home
    games only, and rows without a team, are in the league averages but not in
    the result; a team with two names in a season has two rows.
    """
    pairs = games.filter(F.col("season_year").isNotNull()).groupBy(
        "season_year", "is_bubble_season", "team_abbr_home", "team_name_home", "team_abbr_away"
    ).agg(
        F.count(F.lit(1)).alias("games"),
        F.sum("home_win").alias("home_wins"),
        F.sum(_away_win()).alias("away_wins"),
        F.sum("attendance").alias("crowd"),
        F.count("attendance").alias("crowd_games"),
    )
    as_home = F.struct(
        F.lit(True).alias("at_home"), F.col("team_abbr_home").alias("team_abbr"),
        F.col("team_name_home").alias("team_name"), "is_bubble_season",
        F.col("games"), F.col("home_wins").alias("wins"), F.col("crowd"), F.col("crowd_games"),
    )
    as_away = F.struct(
        F.lit(False).alias("at_home"), F.col("team_abbr_away").alias("team_abbr"),
        F.lit(None).cast("string").alias("team_name"), F.lit(None).cast("boolean").alias("is_bubble_season"),
        F.col("games"), F.col("away_wins").alias("wins"),
        F.lit(None).cast("long").alias("crowd"), F.lit(0).cast("long").alias("crowd_games"),
    )
    sides = pairs.select("season_year", F.inline(F.array(as_home, as_away)))
    records = sides.groupBy("season_year", "team_abbr", "team_name", "is_bubble_season", "at_home").agg(
        F.sum("games").alias("games"),
        F.sum("wins").alias("wins"),
        safe_divide(F.sum("crowd"), F.sum("crowd_games")).alias("attendance"),
    )
    # A season's group holds one row per team, name and side: bounded by the
    # number of teams.  Both windows need one shuffle, by season.
    team = Window.partitionBy("season_year", "team_abbr")
    season = Window.partitionBy("season_year")
    home, away = F.col("at_home"), ~F.col("at_home")
    with_context = records.withColumns({
        "away_games": F.sum(F.when(away, F.col("games"))).over(team),
        "away_wins": F.sum(F.when(away, F.col("wins"))).over(team),
        "league_home_win_pct": safe_divide(
            F.sum(F.when(home, F.col("wins"))).over(season), F.sum(F.when(home, F.col("games"))).over(season)
        ),
        "league_avg_attendance": F.avg(F.when(home, F.col("attendance"))).over(season),
    })
    home_pct = safe_divide("wins", "games")
    away_pct = safe_divide("away_wins", "away_games")
    # A join on the team drops games without one; the league's averages have them.
    named = home & F.col("away_games").isNotNull() & F.col("team_abbr").isNotNull()
    return with_context.filter(named).select(
        "season_year", "team_abbr", "team_name", "is_bubble_season",
        F.col("games").alias("home_games"),
        F.col("wins").alias("home_wins"),
        F.round(home_pct, 4).alias("home_win_pct"),
        "away_games", "away_wins",
        F.round(away_pct, 4).alias("away_win_pct"),
        F.round(home_pct - away_pct, 4).alias("home_advantage_delta"),
        F.round("league_home_win_pct", 4).alias("league_home_win_pct"),
        round_to_long("attendance").alias("avg_attendance"),
        round_to_long("league_avg_attendance").alias("league_avg_attendance"),
    )
