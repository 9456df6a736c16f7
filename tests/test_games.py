import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions.numbers import round_to_long
from wayfare.operators import dashboard, games, quality
from wayfare.schemas import GAME, GAME_INFO


def game(**changes):
    row = dict(game_id="0021900001", season_id="22019", game_date="2019-10-22 00:00:00", team_id_home=1,
               team_abbreviation_home=" bos ", team_name_home="boston celtics", wl_home="W", pts_home=100, team_id_away=2,
               team_abbreviation_away="nyk", team_name_away=" new york knicks", wl_away="L", pts_away=90)
    row.update(changes)
    return tuple(row[n] for n in GAME.names)


def cleaned(spark, rows, infos=()):
    return games.clean_games(spark.createDataFrame(rows, GAME), spark.createDataFrame(list(infos), GAME_INFO))


@pytest.mark.parametrize("changes, kept", [
    ({}, 1), ({"season_id": "42019"}, 0), ({"season_id": None}, 0), ({"game_date": "soon"}, 0), ({"game_date": None}, 0),
    ({"wl_home": None}, 0), ({"wl_home": ""}, 1), ({"team_abbreviation_home": None}, 0), ({"pts_home": None}, 1),
])
def test_rows_kept(spark, changes, kept):
    assert cleaned(spark, [game(**changes)]).count() == kept


@pytest.mark.parametrize("result, win", [("W", 1), ("L", 0), ("", 0)])
def test_home_win(spark, result, win):
    assert cleaned(spark, [game(wl_home=result)]).first().home_win == win


def test_columns_of_a_cleaned_game(spark):
    row = cleaned(spark, [game(), game(game_id="2", season_id="22018")], [("2", 18000, None)]).orderBy("season_year").collect()
    assert [(r.season_year, r.is_bubble_season, r.attendance, r.game_date) for r in row] == [
        (2018, False, 18000, dt.date(2019, 10, 22)), (2019, True, None, dt.date(2019, 10, 22))]


def test_two_infos_give_two_rows_and_a_failing_check(spark):
    both = cleaned(spark, [game(game_id="1")], [("1", 5, None), ("1", 6, None)])
    assert both.count() == 2
    assert quality.quality_report(both, [quality.unique("game_id")]).first().status == "fail"


def test_staged_names(spark):
    row = games.stage_games(cleaned(spark, [game()])).first()
    assert (row.team_abbr_home, row.team_name_home, row.team_name_away, row.team_id_home) == (
        "BOS", "Boston Celtics", "New York Knicks", "1")


SEASONS = "season_year long, is_bubble_season boolean, team_abbr_home string, team_name_home string, " \
          "team_abbr_away string, wl_away string, home_win long, attendance long"


def joined_mart(stg):
    """The mart as three aggregates and two joins."""
    home, away = games.home_stats(stg), games.away_stats(stg)
    every = home.join(away, ["season_year", "team_abbr"]).join(games.league_avg(home), "season_year")
    return every.select(
        "season_year", "team_abbr", "team_name", "is_bubble_season", "home_games", "home_wins",
        F.round("home_win_pct", 4).alias("home_win_pct"), "away_games", "away_wins",
        F.round("away_win_pct", 4).alias("away_win_pct"),
        F.round(F.col("home_win_pct") - F.col("away_win_pct"), 4).alias("home_advantage_delta"),
        F.round("league_home_win_pct", 4).alias("league_home_win_pct"),
        round_to_long("avg_attendance").alias("avg_attendance"),
        round_to_long("league_avg_attendance").alias("league_avg_attendance"),
    )


def test_mart_equals_the_joins_on_uneven_data(spark):
    draw = random.Random(5)
    rows = []
    for _ in range(3000):
        season = draw.choice([None, 2018, 2019, 2019, 2020])
        home = draw.choice(["A", "B", "C", "C", "C", "HOMEONLY", None])
        name = draw.choice(["old", "new"]) if home == "B" else None if home == "C" else home
        away = draw.choice(["A", "B", "C", None, "AWAYONLY"])
        won = draw.random() < 0.6
        crowd = None if season == 2019 else draw.choice([None, 1000, 17000])
        rows.append((season, season == 2019, home, name, away, "L" if won else "W", int(won), crowd))
    stg = spark.createDataFrame(rows, SEASONS)
    one_pass, joined = games.home_advantage_mart(stg), joined_mart(stg)
    assert one_pass.columns == joined.columns
    got, wanted = (sorted(map(tuple, df.collect()), key=str) for df in (one_pass, joined))
    assert got == wanted
    assert {r[1] for r in got} == {"A", "B", "C"}
    assert {r[2] for r in got if r[1] == "B"} == {"old", "new"}
    assert all(r[12] is None and r[13] is None for r in got if r[0] == 2019)


def test_weighted_share_and_mean_of_means(spark):
    rows = [(2020, False, "A", "A", "B", "L", 1, 10)] * 3 + [(2020, False, "B", "B", "A", "W", 0, 20)]
    mart = games.home_advantage_mart(spark.createDataFrame(rows, SEASONS))
    assert {(r.league_home_win_pct, r.league_avg_attendance) for r in mart.collect()} == {(0.75, 15)}


MART = "season_year long, team_abbr string, team_name string, is_bubble_season boolean, home_games long, home_wins long, " \
       "home_advantage_delta double, league_home_win_pct double, avg_attendance long, league_avg_attendance long"


@pytest.fixture
def mart(spark):
    return spark.createDataFrame([
        (1979, "A", "Old", False, 10, 6, 0.1, 0.6, None, None), (2018, "A", "New", False, 10, 8, 0.2, 0.7, 100, 100),
        (2019, "A", None, True, 10, 5, 0.0, 0.5, 0, 0), (2018, "B", "Bees", False, 30, 15, 0.3, 0.7, 201, 100),
        (2019, "C", "Sea", True, 5, 5, 0.4, 0.5, 0, 0),
    ], MART)


def test_tiles(mart):
    teams = [tuple(r) for r in dashboard.team_all_time(mart).collect()]
    assert teams == [("C", "Sea", 5, 5, 1.0), ("A", "New", 19, 30, 19 / 30), ("B", "Bees", 15, 30, 0.5)]
    assert {tuple(r) for r in dashboard.latest_names(mart).collect()} == {("A", "New"), ("B", "Bees"), ("C", "Sea")}
    assert dashboard.league_all_time(mart).first().league_avg == 39 / 65
    assert [tuple(r) for r in dashboard.season_series(mart).collect()] == [(1979, False, 0.6), (2018, False, 0.7), (2019, True, 0.5)]
    assert [r.season_year for r in dashboard.season_series(mart, flagged=True).collect()] == [2019]
    assert [r.season_year for r in dashboard.attendance_series(mart).collect()] == [2018, 2019]
    assert [tuple(r) for r in dashboard.impact_by_team(mart).collect()] == [("A", 0.15, 0.0, -0.15)]
    assert tuple(dashboard.season_bounds(mart).first()) == (1979, 2019)


def test_summary(mart):
    row = dashboard.summary_metrics(mart).first()
    assert (row.overall_home_win_pct, row.bubble_home_win_pct, row.avg_attendance) == (39 / 65, 10 / 15, 150)
    assert row.avg_home_advantage_delta == 0.2
    calm = dashboard.summary_metrics(mart.filter("NOT is_bubble_season AND avg_attendance IS NULL")).first()
    assert (calm.bubble_home_win_pct, calm.bubble_change, calm.avg_attendance) == (None, None, None)


def test_sidebar(mart):
    assert dashboard.sidebar_filter(mart).count() == 5
    assert dashboard.sidebar_filter(mart, (2018, 2019)).count() == 4
    assert dashboard.sidebar_filter(mart, (2018, 2019), ["A"]).count() == 2
