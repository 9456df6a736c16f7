"""Scans, filters, joins and aggregates over trips, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import columns, numbers, strings, times
from wayfare.operators import quality, staging, topk, trips
from wayfare.plans import bindings as b
from wayfare.plans.registry import query, sql_money_sum
from wayfare.schemas import ddl
from wayfare.sources import files, streams

START, END = "1997-01-01", "1999-01-01"


# Scans and row-wise operators


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_returnflag"])


@query(f"SELECT * FROM {b.RIDES} WHERE pickup_datetime >= '2024-01-10' AND pickup_datetime < '2024-01-20 12:00:00'")
def interval_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = b.rides(spark, sf_dir)
    return rides.filter(times.in_interval("pickup_datetime", "2024-01-10", "2024-01-20 12:00:00"))


@query("SELECT COUNT(*) AS trip_count FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def date_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_rows(b.rides(spark, sf_dir), times.on_day("pickup_datetime", "2024-01-15"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE starts_with(o_orderpriority, '2')")
def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.filter(F.startswith("o_orderpriority", F.lit("2")))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_tax <> 0 AND l_quantity <= 10 AND l_extendedprice > 1000""")
def comparison_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = b.table(spark, sf_dir, "lineitem")
    kept = (F.col("l_tax") != 0) & (F.col("l_quantity") <= 10) & (F.col("l_extendedprice") > 1000)
    return lineitem.filter(kept).select("l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
      TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number,
      TRY_CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS number FROM orders""")
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        numbers.text_to_whole(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        numbers.text_to_whole("o_orderpriority").alias("not_a_number"),
        numbers.text_to_whole(F.col("o_orderkey").cast("string")).alias("number"),
    )


@query(f"SELECT * FROM {b.RAW_GAMES} AS g WHERE wl_home IS NOT NULL AND game_date IS NOT NULL")
def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.raw_games(spark, sf_dir).dropna(subset=["wl_home", "game_date"])


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
      CASE WHEN year(l_shipdate) = 1998 THEN TRUE ELSE FALSE END AS flagged FROM lineitem""")
def conditional_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
        F.when(times.in_year("l_shipdate", 1998), True).otherwise(False).alias("flagged"),
    )


@query("""SELECT ts AS pickup_datetime, user_id AS pickup_location_id, value AS fare_amount,
      'green' AS taxi_type FROM events""")
def canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases resolved, a constant added, the preferred columns kept in order."""
    events = columns.rename(b.table(spark, sf_dir, "events"), {"ts": "lpep_pickup_datetime"})
    canonical = columns.resolve_aliases(events, {
        "pickup_datetime": ("tpep_pickup_datetime", "lpep_pickup_datetime"),
        "pickup_location_id": ("PULocationID", "user_id"),
        "fare_amount": ("fare_amount", "value"),
    })
    return columns.keep_present(
        columns.with_constants(canonical, taxi_type="green"),
        ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "fare_amount", "taxi_type"],
    )


@query("""SELECT CAST(starts_with(filename, 'lineitem') AS INTEGER) AS is_lineitem, COUNT(*) AS n
    FROM (SELECT 'lineitem.parquet' AS filename FROM lineitem UNION ALL SELECT 'orders.parquet' FROM orders)
    GROUP BY 1""")
def file_lineage_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [
        files.with_file_name(b.table(spark, sf_dir, t)).select("filename") for t in ("lineitem", "orders")
    ]
    flag = F.startswith("filename", F.lit("lineitem")).cast("int").alias("is_lineitem")
    return columns.union_by_name(named).groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT COUNT(*) AS trip_count FROM orders")
def file_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a scan over two tables' files, the rows of one file."""
    both = spark.read.option("mergeSchema", True).parquet(f"{sf_dir}/orders.parquet", f"{sf_dir}/customer.parquet")
    return trips.count_rows(files.from_files_starting(both, "orders"))


@query("SELECT COUNT(*) AS trip_count, COUNT(DISTINCT o_custkey) AS customers FROM orders")
def wildcard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = files.external_table(spark, "wayfare_orders_files", f"{sf_dir}/order*.parquet")
    return table.agg(F.count(F.lit(1)).alias("trip_count"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT event_type AS service_type, COUNT(*) AS n FROM events GROUP BY event_type")
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    files.register(spark, {"wayfare_events": b.table(spark, sf_dir, "events")})
    return spark.sql("SELECT event_type AS service_type, COUNT(*) AS n FROM wayfare_events GROUP BY event_type")


@query("""SELECT o_orderkey, 'B' || lpad(CAST(o_orderkey AS VARCHAR), 5, '0') AS base_number,
      CASE WHEN o_orderkey % 7 = 0 THEN 's/' WHEN o_orderkey % 3 = 0 THEN 'a/' ELSE 'e/' END
        || lpad(lower(to_hex(o_orderkey)), CAST(greatest(3, length(to_hex(o_orderkey))) AS INTEGER), '0') AS base_id
    FROM orders""")
def base_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.format_string("B%05d", "o_orderkey").alias("base_number"),
    )
    return orders.withColumn("base_id", strings.base_code("base_number"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 's/' WHEN o_orderkey % 3 = 0 THEN 'a/' ELSE 'e/' END
        || lpad(lower(to_hex(o_orderkey)), CAST(greatest(3, length(to_hex(o_orderkey))) AS INTEGER), '0') AS base_id
    FROM orders""")
def base_code_pandas_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", strings.base_code_udf(F.format_string("B%05d", "o_orderkey")).alias("base_id"))


@query("""SELECT p_partkey, upper(trim(' ' || p_name || ' ')) AS code,
      array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title,
      array_to_string(list_transform(string_split(lower(p_brand), '#'), lambda w: upper(w[1]) || w[2:]), '#') AS brand,
      substr(p_type, 1, 3) AS head, substr(p_type, -4, 4) AS tail FROM part""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "part").select(
        "p_partkey",
        strings.clean_code(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("code"),
        strings.title_case("p_name").alias("title"),
        strings.title_case("p_brand").alias("brand"),
        F.substring("p_type", 1, 3).alias("head"),
        F.substring("p_type", -4, 4).alias("tail"),
    )


@query("""SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('month', ts)::TIMESTAMP AS month,
      year(ts) AS y, month(ts) AS m, epoch_us(ts) // 1000 AS millis, date_trunc('millisecond', ts)::TIMESTAMP AS from_millis,
      date_trunc('second', ts)::TIMESTAMP AS parsed, CAST(NULL AS TIMESTAMP) AS unparsed FROM events""")
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date("ts").alias("day"),
        times.month_start("ts").alias("month"),
        F.year("ts").alias("y"),
        F.month("ts").alias("m"),
        times.to_millis("ts").alias("millis"),
        times.from_millis(times.to_millis("ts")).cast("timestamp_ntz").alias("from_millis"),
        times.parse_time(text).cast("timestamp_ntz").alias("parsed"),
        times.parse_time("props").cast("timestamp_ntz").alias("unparsed"),
    )


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      '{"event_id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS record FROM events""")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The event's number goes into the text, so that a record is all there is.
    events = b.table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"event_id":'), "event_id", F.lit(","), F.expr("substring(props, 2)"))
    parsed = streams.good_records(streams.parse_records(events.select(text.alias("value")), ddl("event_id long, k long")))
    return parsed.withColumn("record", streams.record_of("event_id", "k"))


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_quantity, 0) AS unit_price,
      l_tax / NULLIF(l_discount, 0) AS ratio, COALESCE(NULLIF(l_tax, 0), -1.0) AS tax,
      CAST(ROUND(l_extendedprice) AS BIGINT) AS whole FROM lineitem""")
def number_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.safe_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        numbers.safe_divide("l_tax", "l_discount").alias("ratio"),
        F.coalesce(F.nullif("l_tax", F.lit(0.0)), F.lit(-1.0)).alias("tax"),
        numbers.round_to_long("l_extendedprice").alias("whole"),
    )


# Counts, extremes and top rows


@query("SELECT COUNT(*) AS trip_count FROM lineitem")
def count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_rows(b.trips(spark, sf_dir))


@query(f"""SELECT COUNT(*) AS short_trip_count FROM {b.TRIPS}
    WHERE pickup_datetime >= '{START}' AND pickup_datetime < '{END}' AND trip_distance <= 10""")
def filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = times.in_interval("pickup_datetime", START, END) & (F.col("trip_distance") <= 10)
    return trips.count_rows(b.trips(spark, sf_dir), where, "short_trip_count")


@query("SELECT COUNT(*) AS zero_fare_cnt FROM lineitem WHERE l_tax = 0")
def zero_fare_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_rows(b.trips(spark, sf_dir), F.col("tip_amount") == 0, "zero_fare_cnt")


@query(f"SELECT service_type, COUNT(*) AS trip_count FROM {b.TRIPS} GROUP BY service_type")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_by(b.trips(spark, sf_dir), "service_type")


@query("SELECT c_mktsegment AS name, COUNT(*) AS player_count FROM customer GROUP BY 1")
def name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = b.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"))
    return trips.count_by(players, "name", name="player_count")


@query(f"""SELECT COUNT(DISTINCT "VendorID") AS distinct_vendors FROM {b.TRIPS}
    WHERE dropoff_datetime >= '{START}' AND dropoff_datetime < '{END}'""")
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = b.trips(spark, sf_dir).filter(times.in_interval("dropoff_datetime", START, END))
    return trips.count_distinct(kept, "VendorID", "distinct_vendors")


@query("SELECT MIN(ts) AS min_pickup, MAX(ts) AS max_pickup FROM events")
def min_max_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.time_range(b.rides(spark, sf_dir))


@query(f"""SELECT MAX((epoch(dropoff_datetime)::BIGINT - epoch(pickup_datetime)::BIGINT) / 3600.0::DOUBLE)
    AS longest_trip_hours FROM {b.TRIPS}""")
def longest_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.longest_hours(b.trips(spark, sf_dir))


@query("""SELECT CAST(ts AS DATE) AS pickup_date, MAX(value) AS max_trip_distance FROM events
    WHERE value < 100 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def max_per_day_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.longest_trip_day(b.rides(spark, sf_dir))


@query(f"""SELECT z."Zone" AS pickup_zone, {sql_money_sum('total_amount')} AS total_amount_sum
    FROM {b.TRIPS} JOIN {b.ZONES} z ON "PULocationID" = "LocationID"
    WHERE pickup_datetime >= '1998-03-18' AND pickup_datetime < '1998-03-19'
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def zone_revenue_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.top_zone_by_revenue(b.trips(spark, sf_dir), b.zones(spark, sf_dir), "1998-03-18", "1998-03-19")


_LARGEST_TIPS = f"""SELECT zd."Zone" AS dropoff_zone, MAX(tip_amount) AS max_tip
    FROM {b.TRIPS} JOIN {b.ZONES} zp ON "PULocationID" = zp."LocationID"
    JOIN {b.ZONES} zd ON "DOLocationID" = zd."LocationID"
    WHERE zp."Zone" = 'NATION_7' AND pickup_datetime >= '{START}' AND pickup_datetime < '{END}'
    GROUP BY 1"""


@query(_LARGEST_TIPS)
def role_join_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.largest_tips_from(b.trips(spark, sf_dir), b.zones(spark, sf_dir), "NATION_7", START, END)


@query(_LARGEST_TIPS + " ORDER BY max_tip DESC, dropoff_zone LIMIT 1")
def role_join_max_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top(role_join_max(spark, sf_dir), "max_tip", ties=["dropoff_zone"])


@query(f"""SELECT z."Zone" AS zone, COUNT(*)::BIGINT AS trip_count FROM {b.RIDES}
    JOIN {b.ZONES} z ON "PULocationID" = "LocationID" GROUP BY 1""")
def trips_per_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_per_zone(b.rides(spark, sf_dir), b.zones(spark, sf_dir))


@query(f"""SELECT z."Zone" AS zone, COUNT(*)::BIGINT AS trip_count FROM {b.TRIPS}
    JOIN {b.ZONES} z ON "PULocationID" = "LocationID" GROUP BY 1 ORDER BY 2, 1 LIMIT 1""")
def least_frequent_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.least_frequent_zone(b.trips(spark, sf_dir), b.zones(spark, sf_dir))


# Amounts that are not finite, and some far beyond any money; all sums of doubles here are exact, so plain ones serve.
_EDGE_AMOUNT = """CASE WHEN l_suppkey % 7 = 1 AND l_linenumber = 1 THEN CAST('Infinity' AS DOUBLE)
    WHEN l_suppkey % 7 = 2 AND l_linenumber <= 2 THEN CAST('Infinity' AS DOUBLE) * (3 - 2 * l_linenumber)
    WHEN l_suppkey % 7 = 3 AND l_linenumber = 1 THEN CAST('NaN' AS DOUBLE)
    WHEN l_suppkey % 7 = 4 THEN l_quantity * CAST(1125899906842624 AS DOUBLE) * CAST(1125899906842624 AS DOUBLE)
    WHEN l_suppkey % 7 = 5 THEN l_quantity * CAST(1125899906842624 AS DOUBLE) * 4
    ELSE l_quantity / 4 END"""


@query(f"""SELECT l_suppkey % 7 AS kind, SUM({_EDGE_AMOUNT}) AS total, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def money_sum_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums with infinite, undefined and very large amounts, as a sum of doubles has them."""
    amounts = b.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 7).alias("kind"), F.expr(_EDGE_AMOUNT).alias("amount"))
    return amounts.groupBy("kind").agg(numbers.money_sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT LEAST(COUNT(*), 100) AS n FROM {b.TRIPS}")
def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a look at a table shows."""
    return trips.count_rows(topk.sample_rows(b.trips(spark, sf_dir), 100), name="n")


# The monthly table and reads of it

_MONTHLY = f"""SELECT "PULocationID" AS revenue_zone, date_trunc('month', pickup_datetime)::TIMESTAMP AS revenue_month,
    service_type, {sql_money_sum('fare_amount')} AS revenue_monthly_fare,
    {sql_money_sum('extra')} AS revenue_monthly_extra, {sql_money_sum('mta_tax')} AS revenue_monthly_mta_tax,
    {sql_money_sum('tip_amount')} AS revenue_monthly_tip_amount,
    {sql_money_sum('tolls_amount')} AS revenue_monthly_tolls_amount,
    {sql_money_sum('improvement_surcharge')} AS revenue_monthly_improvement_surcharge,
    {sql_money_sum('total_amount')} AS revenue_monthly_total_amount,
    {sql_money_sum('congestion_surcharge')} AS revenue_monthly_congestion_surcharge,
    AVG(passenger_count) AS avg_monthly_passenger_count, AVG(trip_distance) AS avg_monthly_trip_distance,
    COUNT(*) AS total_monthly_trips FROM {b.TRIPS} GROUP BY 1, 2, 3"""


@query(_MONTHLY)
def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.monthly_zone_revenue(b.trips(spark, sf_dir))


def _named_months(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    monthly = trips.monthly_zone_revenue(b.trips(spark, sf_dir), start=start, end=end)
    return trips.name_zones(monthly, b.zones(spark, sf_dir))


_NAMED = f"""WITH monthly AS ({_MONTHLY}), named AS (SELECT m.*, z."Zone" AS pickup_zone
    FROM monthly m LEFT JOIN {b.ZONES} z ON revenue_zone = "LocationID")"""


@query(f"""{_NAMED} SELECT pickup_zone, {sql_money_sum('revenue_monthly_total_amount')} AS total_revenue
    FROM named WHERE service_type = 'O' AND year(revenue_month) = 1998
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def revenue_by_year_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.top_zone_of_year(_named_months(spark, sf_dir, "1998-01-01", "1999-01-01"), "O", 1998)


@query(f"""{_NAMED} SELECT CAST(SUM(total_monthly_trips) AS BIGINT) AS total_trips FROM named
    WHERE service_type = 'O' AND year(revenue_month) = 1999 AND month(revenue_month) = 10""")
def trips_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_in_month(_named_months(spark, sf_dir, "1999-10-01", "1999-11-01"), "O", 1999, 10)


# Staging and reports


@query("""SELECT ts AS pickup_datetime, user_id, value, 'green' AS service_type FROM events
    UNION ALL SELECT o_orderdate, o_custkey, o_totalprice, 'yellow' FROM orders""")
def combine_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = columns.rename(b.table(spark, sf_dir, "events"), {"ts": "lpep_pickup_datetime"})
    yellow = columns.rename(
        b.table(spark, sf_dir, "orders"),
        {"o_orderdate": "tpep_pickup_datetime", "o_custkey": "user_id", "o_totalprice": "value"},
    )
    return staging.combine_services(green, yellow)


@query("""SELECT event_id, value, CAST(NULL AS VARCHAR) AS status FROM events
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def union_differing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select("event_id", "value")
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("event_id"),
        F.col("o_orderstatus").alias("status"),
    )
    return columns.union_by_name([events, orders])


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = b.table(spark, sf_dir, "lineitem")
    return lineitem.select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


_STAGED_A = f"""SELECT d.*, payment_type_name FROM (SELECT DISTINCT * FROM {b.LOCATED_TRIPS}
    WHERE pickup_datetime >= '{START}' AND pickup_datetime < '{END}') d
    LEFT JOIN {b.PAYMENTS} p ON TRY_CAST(d.payment_type AS BIGINT) = p.payment_type_id"""


def _staged_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trips_distinct(b.located_trips(spark, sf_dir), b.payments(spark, sf_dir), START, END)


@query(_STAGED_A)
def stage_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_a(spark, sf_dir)


_STAGED_B = f"""SELECT DISTINCT ON (pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
      ROUND(fare_amount, 2)) pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, fare_amount,
      taxi_type, payment_type_name
    FROM {b.LOCATED_TRIPS} LEFT JOIN {b.PAYMENTS} p ON TRY_CAST(payment_type AS BIGINT) = p.payment_type_id
    WHERE pickup_datetime >= '{START}' AND pickup_datetime < '{END}'
    ORDER BY taxi_type NULLS FIRST, payment_type_name NULLS FIRST, fare_amount"""


def _staged_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_trips_keyed(b.located_trips(spark, sf_dir), b.payments(spark, sf_dir), START, END)


@query(_STAGED_B)
def stage_keyed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_b(spark, sf_dir)


@query("""SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key with few keys, so that each key holds much of the table."""
    events = b.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return staging.first_per_key(events, ["event_type"], [F.col("value").desc(), "event_id"])


@query(f"""SELECT CAST(c.c_name AS VARCHAR) AS dispatching_base_num, c.c_mktsegment AS affiliated_base_number,
      CAST(c.c_nationkey AS INTEGER) AS pickup_location_id, CAST(o.o_custkey AS INTEGER) AS dropoff_location_id,
      o.o_orderdate AS pickup_datetime, o.o_orderdate AS dropoff_datetime, o.o_orderstatus AS sr_flag
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0
    WHERE c.c_name IS NOT NULL AND o.o_orderdate >= '{START}' AND o.o_orderdate < '{END}'""")
def stage_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = b.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    orders = b.table(spark, sf_dir, "orders")
    raw = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("c_name").alias("dispatching_base_num"), F.col("c_mktsegment").alias("affiliated_base_number"),
        F.col("c_nationkey").cast("string").alias("pulocationid"), F.col("o_custkey").alias("dolocationid"),
        F.col("o_orderdate").alias("pickup_datetime"), F.col("o_orderdate").alias("dropoff_datetime"),
        F.col("o_orderstatus").alias("sr_flag"),
    )
    staged = staging.stage_fhv(raw, (START, END))
    return staged.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")})


@query(f"""SELECT t.*, payment_type_name FROM {b.LOCATED_TRIPS.replace('AS trips', 'AS t')}
    LEFT JOIN {b.PAYMENTS} p ON TRY_CAST(t.payment_type AS BIGINT) = p.payment_type_id""")
def lookup_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.lookup_left(
        b.located_trips(spark, sf_dir), b.payments(spark, sf_dir),
        key="payment_type", lookup_key="payment_type_id", take=["payment_type_name"],
    )


@query(f"""WITH staged AS ({_STAGED_A}) SELECT CAST(pickup_datetime AS DATE) AS date, taxi_type, payment_type_name,
    COUNT(*) AS trip_count, {sql_money_sum('COALESCE(fare_amount, 0)')} AS total_fare FROM staged
    GROUP BY 1, 2, 3""")
def trips_report_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_report(_staged_a(spark, sf_dir), START, END)


@query(f"""WITH staged AS ({_STAGED_B}) SELECT CAST(pickup_datetime AS DATE) AS trip_date, taxi_type,
    payment_type_name AS payment_type, COUNT(*) AS trip_count, {sql_money_sum('fare_amount')} AS total_fare,
    {sql_money_sum('fare_amount')} / NULLIF(COUNT(fare_amount), 0) AS avg_fare FROM staged GROUP BY 1, 2, 3""")
def trips_report_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_report_with_average(_staged_b(spark, sf_dir), START, END)


# Checks


@query(f"""WITH t AS (SELECT * FROM {b.TRIPS}), r AS (
    SELECT 'not_null' AS "check", 'pickup_datetime' AS "column",
      COUNT(*) FILTER (WHERE pickup_datetime IS NULL) AS failures FROM t
    UNION ALL SELECT 'non_negative', 'trip_distance', COUNT(*) FILTER (WHERE trip_distance < 0) FROM t
    UNION ALL SELECT 'positive', 'tip_amount', COUNT(*) FILTER (WHERE tip_amount <= 0) FROM t
    UNION ALL SELECT 'accepted_values', 'taxi_type', COUNT(*) FILTER (WHERE taxi_type NOT IN ('A', 'R')) FROM t
    UNION ALL SELECT 'row_count_greater_than_zero', '', CASE WHEN COUNT(*) > 0 THEN 0 ELSE 1 END FROM t
    UNION ALL SELECT 'fares_below_bound', '', CASE WHEN MAX(fare_amount) < 1 THEN 0 ELSE 1 END FROM t
    UNION ALL SELECT 'unique', 'pickup_datetime', COUNT(*) FROM
      (SELECT pickup_datetime FROM t WHERE pickup_datetime IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1))
    SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(b.trips(spark, sf_dir), [
        quality.not_null("pickup_datetime"), quality.non_negative("trip_distance"), quality.positive("tip_amount"),
        quality.accepted_values("taxi_type", ["A", "R"]), quality.row_count_positive(),
        quality.custom("fares_below_bound", F.max("fare_amount") < 1, True), quality.unique("pickup_datetime"),
    ])


@query("SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_values(b.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("""SELECT MAX(ts) AS max_loaded_at, CASE WHEN MAX(ts) + INTERVAL 48 HOUR < TIMESTAMP '2024-02-01 12:00:00'
      THEN 'error' WHEN MAX(ts) + INTERVAL 24 HOUR < TIMESTAMP '2024-02-01 12:00:00' THEN 'warn' ELSE 'pass' END
      AS status FROM events""")
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(b.table(spark, sf_dir, "events"), "ts", "2024-02-01 12:00:00")
