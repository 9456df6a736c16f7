"""The home-advantage layers and the dashboard's aggregates, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import dashboard, games, quality
from wayfare.plans import bindings as b
from wayfare.plans.registry import query, sql_money_sum

CLEANED = f"""cleaned AS (SELECT g.game_id, TRY_CAST(substr(game_date, 1, 10) AS DATE) AS game_date, season_id,
    team_id_home, team_abbreviation_home, team_name_home, wl_home, TRY_CAST(pts_home AS INTEGER) AS pts_home,
    team_id_away, team_abbreviation_away, team_name_away, wl_away, TRY_CAST(pts_away AS INTEGER) AS pts_away,
    TRY_CAST(right(season_id, 4) AS INTEGER) AS season_year,
    CASE WHEN wl_home = 'W' THEN 1 ELSE 0 END AS home_win,
    TRY_CAST(right(season_id, 4) AS INTEGER) = {b.FLAGGED_YEAR} AS is_bubble_season,
    TRY_CAST(attendance AS INTEGER) AS attendance
  FROM {b.RAW_GAMES} g LEFT JOIN {b.GAME_INFO} i ON g.game_id = i.game_id
  WHERE starts_with(season_id, '2') AND TRY_CAST(substr(game_date, 1, 10) AS DATE) IS NOT NULL
    AND wl_home IS NOT NULL AND team_abbreviation_home IS NOT NULL)"""


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.clean_games(b.raw_games(spark, sf_dir), b.game_info(spark, sf_dir), b.FLAGGED_YEAR)


@query(f"WITH {CLEANED} SELECT * FROM cleaned")
def clean_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


def sql_title(column: str) -> str:
    # The names' words are lower case, split by blank, hyphen and full stop.
    return (
        f"replace(replace(replace(trim({column}), 'grand', 'Grand'), 'nation', 'Nation'), ' no.', ' No.')"
    )


@query(f"""WITH {CLEANED} SELECT game_id, game_date, season_id, CAST(season_year AS BIGINT) AS season_year,
    CAST(team_id_home AS VARCHAR) AS team_id_home, upper(trim(team_abbreviation_home)) AS team_abbr_home,
    {sql_title('team_name_home')} AS team_name_home, wl_home, CAST(pts_home AS BIGINT) AS pts_home,
    CAST(team_id_away AS VARCHAR) AS team_id_away, upper(trim(team_abbreviation_away)) AS team_abbr_away,
    {sql_title('team_name_away')} AS team_name_away, wl_away, CAST(pts_away AS BIGINT) AS pts_away,
    CAST(home_win AS BIGINT) AS home_win, is_bubble_season, CAST(attendance AS BIGINT) AS attendance
  FROM cleaned""")
def stage_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.stage_games(_cleaned(spark, sf_dir))


@query(f"WITH {b.STAGED_GAMES}, {b.HOME_STATS} SELECT * FROM home_stats")
def home_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.home_stats(b.staged_games(spark, sf_dir))


@query(f"WITH {b.STAGED_GAMES}, {b.AWAY_STATS} SELECT * FROM away_stats")
def away_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.away_stats(b.staged_games(spark, sf_dir))


@query(f"""WITH {b.STAGED_GAMES}, {b.HOME_STATS} SELECT season_year,
    SUM(home_wins) / NULLIF(SUM(home_games), 0) AS league_home_win_pct,
    ROUND(AVG(avg_attendance), 6) AS league_avg_attendance FROM home_stats GROUP BY season_year""")
def league_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = games.league_avg(games.home_stats(b.staged_games(spark, sf_dir)))
    return averages.withColumn("league_avg_attendance", F.round("league_avg_attendance", 6))


@query(f"WITH {b.MART} SELECT * FROM mart")
def home_advantage_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.home_advantage_mart(b.staged_games(spark, sf_dir))


@query(f"""WITH {b.MART}, latest AS (SELECT team_abbr, team_name FROM mart WHERE team_name IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY team_abbr ORDER BY season_year DESC, team_name DESC) = 1)
  SELECT team_abbr, l.team_name, CAST(SUM(home_wins) AS BIGINT) AS home_wins,
    CAST(SUM(home_games) AS BIGINT) AS home_games, SUM(home_wins) / NULLIF(SUM(home_games), 0) AS home_win_pct
  FROM mart LEFT JOIN latest l USING (team_abbr) GROUP BY 1, 2""")
def team_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.team_all_time(home_advantage_mart(spark, sf_dir))


@query(f"WITH {b.MART} SELECT SUM(home_wins) / NULLIF(SUM(home_games), 0) AS league_avg FROM mart")
def league_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.league_all_time(home_advantage_mart(spark, sf_dir))


@query(f"""WITH {b.MART} SELECT team_abbr, team_name FROM mart WHERE team_name IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY team_abbr ORDER BY season_year DESC, team_name DESC) = 1""")
def latest_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.latest_names(home_advantage_mart(spark, sf_dir))


@query(f"""WITH {b.MART} SELECT season_year, is_bubble_season, MAX(league_home_win_pct) AS league_home_win_pct
    FROM mart GROUP BY 1, 2""")
def season_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.season_series(home_advantage_mart(spark, sf_dir))


@query(f"""WITH {b.MART} SELECT season_year, is_bubble_season, MAX(league_avg_attendance) AS league_avg_attendance,
    MAX(league_home_win_pct) AS league_home_win_pct FROM mart WHERE season_year >= 1997 GROUP BY 1, 2""")
def attendance_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.attendance_series(home_advantage_mart(spark, sf_dir), since=1997)


def _sql_mean(condition: str) -> str:
    delta = f"CASE WHEN {condition} THEN home_advantage_delta END"
    return f"{sql_money_sum(f'({delta})')} / NULLIF(COUNT({delta}), 0)"


@query(f"""WITH {b.MART}, per_team AS (SELECT team_abbr, {_sql_mean('NOT is_bubble_season')} AS normal_delta,
    {_sql_mean('is_bubble_season')} AS bubble_delta FROM mart GROUP BY 1)
  SELECT *, bubble_delta - normal_delta AS delta_change FROM per_team
  WHERE normal_delta IS NOT NULL AND bubble_delta IS NOT NULL""")
def impact_by_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.impact_by_team(home_advantage_mart(spark, sf_dir))


@query(f"""WITH {b.MART}, m AS (SELECT SUM(home_wins) / NULLIF(SUM(home_games), 0) AS overall_home_win_pct,
    SUM(home_wins) FILTER (WHERE is_bubble_season) / NULLIF(SUM(home_games) FILTER (WHERE is_bubble_season), 0)
      AS bubble_home_win_pct, {_sql_mean('TRUE')} AS avg_home_advantage_delta,
    CAST(TRUNC(AVG(avg_attendance) FILTER (WHERE avg_attendance > 0)) AS BIGINT) AS avg_attendance FROM mart)
  SELECT *, bubble_home_win_pct - overall_home_win_pct AS bubble_change FROM m""")
def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.summary_metrics(home_advantage_mart(spark, sf_dir))


@query(f"""WITH {b.MART} SELECT * FROM mart WHERE season_year BETWEEN 1996 AND 1999
    AND team_abbr IN ('NATION_3', 'NATION_11')""")
def sidebar_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.sidebar_filter(home_advantage_mart(spark, sf_dir), (1996, 1999), ["NATION_3", "NATION_11"])


@query(f"WITH {b.MART} SELECT MIN(season_year) AS first_season, MAX(season_year) AS last_season FROM mart")
def season_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.season_bounds(home_advantage_mart(spark, sf_dir))


def _sql_not_null(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'not_null' AS \"check\", '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM t"
        for c in columns)


def _sql_unique(columns: str) -> str:
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(","))
    return f"""SELECT 'unique', '{columns}', COUNT(*) FROM
      (SELECT {columns} FROM t WHERE {known} GROUP BY ALL HAVING COUNT(*) > 1)"""


_STATUS = "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r"
_MART_COLUMNS = ["season_year", "team_abbr", "team_name", "is_bubble_season", "home_win_pct", "away_win_pct",
                 "home_advantage_delta", "league_home_win_pct"]


@query(f"""WITH {b.MART}, t AS (SELECT * FROM mart), r AS ({_sql_not_null(_MART_COLUMNS)}
    UNION ALL {_sql_unique('team_abbr,season_year')}) {_STATUS}""")
def mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart's own set of checks, its grain among them."""
    return quality.quality_report(home_advantage_mart(spark, sf_dir), quality.home_advantage_checks())


_RENAMED = f"""{b.STAGED_GAMES.replace('stg_games AS', 'first_names AS')},
stg_games AS (SELECT * REPLACE (CASE WHEN team_abbr_home = 'NATION_3' AND home_win = 1 THEN 'a new name'
    ELSE team_name_home END AS team_name_home) FROM first_names), {b.MART_OF_STAGED}"""


@query(f"""WITH {_RENAMED}, t AS (SELECT * FROM mart), r AS ({_sql_not_null(_MART_COLUMNS)}
    UNION ALL {_sql_unique('team_abbr,season_year')}) {_STATUS}""")
def renamed_mart_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A team that goes by two names within a season has two rows there: the mart's claim fails."""
    renamed = F.when((F.col("team_abbr_home") == "NATION_3") & (F.col("home_win") == 1), "a new name")
    staged = b.staged_games(spark, sf_dir).withColumn("team_name_home", renamed.otherwise(F.col("team_name_home")))
    return quality.quality_report(games.home_advantage_mart(staged), quality.home_advantage_checks())


_GAME_COLUMNS = ["game_id", "game_date", "season_year", "team_abbr_home", "wl_home", "home_win", "is_bubble_season"]


@query(f"""WITH {CLEANED}, t AS (SELECT *, upper(trim(team_abbreviation_home)) AS team_abbr_home FROM cleaned),
  r AS ({_sql_not_null(_GAME_COLUMNS)} UNION ALL {_sql_unique('game_id')}
    UNION ALL SELECT 'accepted_values', 'wl_home', COUNT(*) FILTER (WHERE wl_home NOT IN ('W', 'L')) FROM t) {_STATUS}""")
def staged_games_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(stage_games(spark, sf_dir), quality.staged_games_checks())
