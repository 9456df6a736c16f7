"""The test tables in the part of trips, zones, payments, games and rides.

Each stand-in is a projection of whole tables, with its SQL twin beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.schemas import ddl
from wayfare.scratch import fresh_path
from wayfare.sources.streams import good_records, parquet_files, record_files, to_records


# Declared, so that no job reads file footers before the query itself.
TABLES = {
    "region": ddl("r_regionkey int, r_name string"),
    "nation": ddl("n_nationkey int, n_name string, n_regionkey int"),
    "customer": ddl("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": ddl("s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    "part": ddl("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": ddl("""o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string"""),
    "lineitem": ddl("""l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz"""),
    "events": ddl("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trips: shipped = picked up, price = fare, tax = tip; totals have fractions of a cent."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_shipdate") + F.expr("make_dt_interval(0, l_linenumber, CAST(l_quantity AS INT), 0)"))
        .alias("dropoff_datetime"),
        (F.col("l_suppkey") % 25).alias("PULocationID"),
        (F.col("l_partkey") % 25).alias("DOLocationID"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_tax").alias("tip_amount"),
        F.col("l_discount").alias("tolls_amount"),
        F.col("l_discount").alias("improvement_surcharge"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_amount"),
        F.col("l_tax").alias("congestion_surcharge"),
        F.col("l_linenumber").cast("string").alias("payment_type"),
        F.col("l_linestatus").alias("service_type"),
        F.col("l_returnflag").alias("taxi_type"),
    )


TRIPS = """(SELECT
    l_suppkey AS "VendorID", l_shipdate AS pickup_datetime,
    l_shipdate + to_hours(l_linenumber) + to_minutes(CAST(l_quantity AS BIGINT)) AS dropoff_datetime,
    l_suppkey % 25 AS "PULocationID", l_partkey % 25 AS "DOLocationID",
    l_linenumber AS passenger_count, l_quantity AS trip_distance, l_extendedprice AS fare_amount,
    l_discount AS extra, l_tax AS mta_tax, l_tax AS tip_amount, l_discount AS tolls_amount,
    l_discount AS improvement_surcharge, l_extendedprice * (1 - l_discount) AS total_amount, l_tax AS congestion_surcharge,
    CAST(l_linenumber AS VARCHAR) AS payment_type, l_linestatus AS service_type, l_returnflag AS taxi_type
  FROM lineitem) AS trips"""


def located_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as the stricter ingest hands them on; some agree in all but the service.  Fares have three decimals."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_shipdate") + F.expr("make_dt_interval(0, l_linenumber, 0, 0)")).alias("dropoff_datetime"),
        (F.col("l_suppkey") % 25).alias("pickup_location_id"),
        F.col("l_linenumber").alias("dropoff_location_id"),
        (F.col("l_quantity") + F.col("l_linenumber") * 0.003).alias("fare_amount"),
        F.col("l_linenumber").cast("string").alias("payment_type"),
        F.col("l_returnflag").alias("taxi_type"),
    )


LOCATED_TRIPS = """(SELECT
    l_shipdate AS pickup_datetime, l_shipdate + to_hours(l_linenumber) AS dropoff_datetime,
    l_suppkey % 25 AS pickup_location_id, l_linenumber AS dropoff_location_id,
    l_quantity + l_linenumber * CAST(0.003 AS DOUBLE) AS fare_amount,
    CAST(l_linenumber AS VARCHAR) AS payment_type, l_returnflag AS taxi_type
  FROM lineitem) AS trips"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone")
    )


ZONES = """(SELECT n_nationkey AS "LocationID", r_name AS "Borough", n_name AS "Zone"
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as payment types; trips have payment types without a name too."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("payment_type_id"), F.col("r_name").alias("payment_type_name")
    )


PAYMENTS = "(SELECT r_regionkey AS payment_type_id, r_name AS payment_type_name FROM region)"


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw games, numbers and dates as text."""
    home, away = F.col("o_custkey") % 25, (F.col("o_custkey") + F.col("o_orderkey") % 24 + 1) % 25

    def named(prefix: str, team: Column) -> Column:
        return F.concat(F.lit(prefix), team.cast("string"), F.lit(" "))

    kind = F.when(F.startswith("o_orderpriority", F.lit("4")), "4").otherwise("2")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("game_id"),
        F.concat(kind, F.year("o_orderdate").cast("string")).alias("season_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("game_date"),
        home.alias("team_id_home"),
        named(" t", home).alias("team_abbreviation_home"),
        named(" grand-nation no.", home).alias("team_name_home"),
        F.when(F.col("o_orderstatus") == "F", "W").when(F.col("o_orderstatus") == "O", "L").alias("wl_home"),
        F.floor(F.col("o_totalprice") / 1000).cast("string").alias("pts_home"),
        away.alias("team_id_away"),
        named(" t", away).alias("team_abbreviation_away"),
        named(" grand-nation no.", away).alias("team_name_away"),
        F.when(F.col("o_orderstatus") == "O", "W").when(F.col("o_orderstatus") == "F", "L").alias("wl_away"),
        F.col("o_orderpriority").alias("pts_away"),
    )


RAW_GAMES = """(SELECT
    CAST(o_orderkey AS VARCHAR) AS game_id,
    CASE WHEN o_orderpriority LIKE '4%' THEN '4' ELSE '2' END || year(o_orderdate) AS season_id,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS game_date,
    o_custkey % 25 AS team_id_home,
    ' t' || (o_custkey % 25) || ' ' AS team_abbreviation_home,
    ' grand-nation no.' || (o_custkey % 25) || ' ' AS team_name_home,
    CASE o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN 'L' END AS wl_home,
    CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS pts_home,
    (o_custkey + o_orderkey % 24 + 1) % 25 AS team_id_away,
    ' t' || ((o_custkey + o_orderkey % 24 + 1) % 25) || ' ' AS team_abbreviation_away,
    ' grand-nation no.' || ((o_custkey + o_orderkey % 24 + 1) % 25) || ' ' AS team_name_away,
    CASE o_orderstatus WHEN 'O' THEN 'W' WHEN 'F' THEN 'L' END AS wl_away,
    o_orderpriority AS pts_away
  FROM orders)"""


def game_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance as text; games of one priority have none."""
    return (
        table(spark, sf_dir, "orders")
        .filter(~F.startswith("o_orderpriority", F.lit("3")))
        .select(
            F.col("o_orderkey").cast("string").alias("game_id"),
            F.floor(F.col("o_totalprice") / 10).cast("string").alias("attendance"),
        )
    )


GAME_INFO = """(SELECT CAST(o_orderkey AS VARCHAR) AS game_id,
    CAST(CAST(FLOOR(o_totalprice / 10) AS BIGINT) AS VARCHAR) AS attendance
  FROM orders WHERE o_orderpriority NOT LIKE '3%')"""

FLAGGED_YEAR = 1998

#: The nation whose games have no team at its side.
NO_TEAM = "NATION_24"


def staged_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as staged games: supplier's nation at home to the customer's."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    home = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.nullif("n_name", F.lit(NO_TEAM)).alias("home"))
    away = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.nullif("n_name", F.lit(NO_TEAM)).alias("away"))
    hosts = supplier.join(home, "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "home")
    guests = customer.join(away, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "away")
    visits = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(guests, "o_custkey")
    season = F.year("l_shipdate").cast("long")
    return (
        lineitem.join(visits, "l_orderkey").join(hosts, "l_suppkey")
        .select(
            season.alias("season_year"),
            F.col("home").alias("team_abbr_home"),
            F.col("home").alias("team_name_home"),
            F.col("away").alias("team_abbr_away"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("home_win"),
            F.when(F.col("l_returnflag") == "A", "W").otherwise("L").alias("wl_away"),
            (season == FLAGGED_YEAR).alias("is_bubble_season"),
            F.col("l_quantity").cast("long").alias("attendance"),
        )
    )


STAGED_GAMES = f"""stg_games AS (SELECT
    CAST(year(l_shipdate) AS BIGINT) AS season_year,
    NULLIF(h.n_name, '{NO_TEAM}') AS team_abbr_home, NULLIF(h.n_name, '{NO_TEAM}') AS team_name_home,
    NULLIF(a.n_name, '{NO_TEAM}') AS team_abbr_away,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS home_win,
    CASE WHEN l_returnflag = 'A' THEN 'W' ELSE 'L' END AS wl_away,
    year(l_shipdate) = {FLAGGED_YEAR} AS is_bubble_season,
    CAST(l_quantity AS BIGINT) AS attendance
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation h ON s_nationkey = h.n_nationkey
  JOIN customer ON o_custkey = c_custkey JOIN nation a ON c_nationkey = a.n_nationkey)"""

# Every game counts once for each side; the marts are aggregates over one side or the other.
SIDES = """sides AS (
  SELECT season_year, UNNEST([TRUE, FALSE]) AS at_home, UNNEST([team_abbr_home, team_abbr_away]) AS team_abbr,
    UNNEST([team_name_home, NULL]) AS team_name, UNNEST([is_bubble_season, NULL]) AS is_bubble_season,
    UNNEST([home_win = 1, COALESCE(wl_away = 'W', FALSE)]) AS won, UNNEST([attendance, NULL]) AS crowd
  FROM stg_games)"""

_RECORD = """COUNT(*) AS {0}_games, COUNT(*) FILTER (WHERE won) AS {0}_wins, AVG(won::INTEGER) AS {0}_win_pct"""

HOME_STATS = f"""{SIDES}, home_stats AS (SELECT season_year, team_abbr, team_name, is_bubble_season,
    {_RECORD.format('home')}, AVG(crowd) AS avg_attendance FROM sides WHERE at_home GROUP BY 1, 2, 3, 4)"""

AWAY_STATS = f"""{SIDES}, away_stats AS (SELECT season_year, team_abbr, {_RECORD.format('away')}
  FROM sides WHERE NOT at_home GROUP BY 1, 2)"""

MART_OF_STAGED = f"""{HOME_STATS}, {AWAY_STATS.removeprefix(SIDES + ', ')},
seasons AS (SELECT *, SUM(home_wins) OVER season / SUM(home_games) OVER season AS league_pct,
    AVG(avg_attendance) OVER season AS league_crowd FROM home_stats WINDOW season AS (PARTITION BY season_year)),
mart AS (SELECT s.season_year, s.team_abbr, team_name, is_bubble_season, home_games, home_wins, away_games, away_wins,
    ROUND(home_win_pct, 4) AS home_win_pct, ROUND(away_win_pct, 4) AS away_win_pct,
    ROUND(home_win_pct - away_win_pct, 4) AS home_advantage_delta, ROUND(league_pct, 4) AS league_home_win_pct,
    ROUND(avg_attendance)::BIGINT AS avg_attendance, ROUND(league_crowd)::BIGINT AS league_avg_attendance
  FROM seasons s, away_stats a WHERE s.season_year = a.season_year AND s.team_abbr = a.team_abbr)"""

MART = f"{STAGED_GAMES}, {MART_OF_STAGED}"


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rides: user = zone, value = amount and distance."""
    return table(spark, sf_dir, "events").select(*_ride())


def _ride() -> list[Column]:
    return [
        F.col("ts").alias("pickup_datetime"),
        F.col("user_id").alias("PULocationID"),
        F.col("value").alias("trip_distance"),
        F.col("value").alias("total_amount"),
        F.col("value").alias("tip_amount"),
    ]


def ride_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rides as a stream of files."""
    return parquet_files(spark, f"{sf_dir}/events*.parquet", TABLES["events"]).select(*_ride())


#: Days that each file of the record stream covers, which records come late, and by how many files.
DAYS_PER_FILE, LATE_EVERY, LATE_FILES, FILES = 8, 50, 2, 4

#: Parts of each file of the record stream, which arrive together: as many tasks write and read them.
PARTS = 4


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rides as JSON texts in files that arrive one after another, some records two files late."""
    events = table(spark, sf_dir, "events")
    due = F.least(F.floor((F.dayofmonth("ts") - 1) / DAYS_PER_FILE), F.lit(FILES - 1))
    late = F.when(F.col("event_id") % LATE_EVERY == 0, LATE_FILES).otherwise(0)
    records = events.select(
        F.least(due + late, F.lit(FILES - 1)).alias("file"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("pickup_micros"),
        F.col("user_id").alias("PULocationID"), F.col("value").alias("total_amount"),
    )
    path = fresh_path(spark, "records")
    for number in range(FILES):
        # their times of writing give the order; the parts of one make one batch
        arriving = records.filter(F.col("file") == number).drop("file")
        to_records(arriving).repartition(PARTS).write.mode("append").text(path)
    parsed = record_files(spark, path, RECORD, files_per_batch=PARTS)
    return good_records(parsed).withColumn("pickup_datetime", F.timestamp_micros("pickup_micros"))


RECORD = ddl("pickup_micros long, PULocationID long, total_amount double")

# A record is lost if its hour ended before the watermark that its batch is held
# against: five seconds before the latest time of all files but the last two.
RECORDS = f"""arriving AS (SELECT ts, user_id, value, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS hour,
    LEAST(LEAST((day(ts) - 1) // {DAYS_PER_FILE}, {FILES - 1})
      + {LATE_FILES} * CAST(event_id % {LATE_EVERY} = 0 AS INTEGER), {FILES - 1})
      AS file FROM events),
  latest AS (SELECT file, MAX(MAX(ts)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS before
    FROM arriving GROUP BY file),
  records AS (SELECT a.*, before IS NOT NULL AND hour + INTERVAL 1 HOUR <= before - INTERVAL 5 SECOND AS lost
    FROM arriving a JOIN latest USING (file))"""


RIDES = """(SELECT ts AS pickup_datetime, user_id AS "PULocationID", value AS trip_distance,
    value AS total_amount, value AS tip_amount FROM events) AS rides"""
