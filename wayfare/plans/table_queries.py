"""Round trips through files, and changes to stored tables, with their SQL.

Each query writes what it needs to a new folder below the shared one and
returns a read of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import times
from wayfare.operators import changes, staging, topk, trips
from wayfare.plans import bindings as b
from wayfare.plans.registry import query
from wayfare.scratch import fresh_path
from wayfare.schemas import PAYMENT_LOOKUP, ddl
from wayfare.sinks import incremental, tables
from wayfare.sources import files, months

ORDER_TEXT = ddl("""o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp_ntz, o_orderpriority string""")
ORDER_COLUMNS = ORDER_TEXT.names


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


def _orders_csv(spark: SparkSession, sf_dir: str, **options: str) -> str:
    path = fresh_path(spark, "orders-csv")
    _orders(spark, sf_dir).write.options(header=True, **options).csv(path)
    return path


# Files


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, printf('%.2f', o_totalprice) AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate, o_orderpriority FROM orders""")
def csv_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column as the text that stands in the file; amounts were written with two decimals."""
    path = fresh_path(spark, "orders-csv")
    amounts = F.format_string("%.2f", "o_totalprice")
    _orders(spark, sf_dir).withColumn("o_totalprice", amounts).write.options(header=True).csv(path)
    return files.csv_strings(spark, path)


@query(f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def csv_gzip_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.csv_typed(spark, _orders_csv(spark, sf_dir, compression="gzip"), ORDER_TEXT, spread=8)


@query("""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = files.csv_inferred(spark, _orders_csv(spark, sf_dir))
    return read.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("SELECT CAST(c_custkey AS INTEGER) AS payment_type_id, c_name AS payment_type_name FROM customer")
def seed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "seed")
    b.table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.option("header", True).csv(path)
    return files.seed(spark, path, PAYMENT_LOOKUP)


@query("SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders per year and month, read as one table."""
    root = fresh_path(spark, "tree")
    orders = b.table(spark, sf_dir, "orders")
    dated = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    dated.hint("rebalance", F.col("year"), F.col("month")).write.partitionBy("year", "month").parquet(root)
    keys = F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    return files.parquet_tree(spark, root).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS kind FROM orders
    UNION ALL SELECT event_id, CAST(CAST(FLOOR(value) AS BIGINT) AS DOUBLE), event_type FROM events""")
def merged_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders whose columns differ in name and in type."""
    left, right = fresh_path(spark, "merge-left"), fresh_path(spark, "merge-right")
    orders, events = b.table(spark, sf_dir, "orders"), b.table(spark, sf_dir, "events")
    orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")).write.parquet(left)
    events.select(
        F.col("event_id").alias("id"), F.floor("value").alias("amount"), F.col("event_type").alias("kind")
    ).write.parquet(right)
    return files.parquet_merged(spark, [left, right], ddl("id long, amount double, kind string"))


EXTRACTED = "2024-03-01 06:00:00"


@query(f"""SELECT ts AS pickup_datetime, CAST(user_id AS INTEGER) AS passenger_count, value AS trip_distance,
      value AS fare_amount, 'green' AS taxi_type, TIMESTAMP '{EXTRACTED}' AS extracted_at
    FROM events WHERE ts >= '2024-01-01' AND ts < '2024-02-01'
    UNION ALL SELECT l_shipdate, l_linenumber, l_quantity, l_extendedprice, 'yellow', TIMESTAMP '{EXTRACTED}'
    FROM lineitem WHERE l_shipdate >= '1998-02-01' AND l_shipdate < '1998-04-01'""")
def month_range_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files of two services; a range of each, absent months skipped."""
    root = fresh_path(spark, "months")
    green = b.table(spark, sf_dir, "events").select(
        F.col("ts").alias("lpep_pickup_datetime"), F.col("user_id").alias("passenger_count"),
        F.col("value").alias("trip_distance"), F.col("value").alias("fare_amount"),
    )
    yellow = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"), F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"), F.col("l_extendedprice").alias("fare_amount"),
    )
    for rows, service, time, month, following in (
        (green, "green", "lpep_pickup_datetime", "2024-01-01", "2024-02-01"),
        (yellow, "yellow", "tpep_pickup_datetime", "1998-02-01", "1998-03-01"),
        (yellow, "yellow", "tpep_pickup_datetime", "1998-03-01", "1998-04-01"),
    ):
        path = months.month_paths(root, service, month, following)[0]
        rows.filter(times.in_interval(time, month, following)).write.parquet(path)
    at = dt.datetime.fromisoformat(EXTRACTED)
    found = months.ingest_trips(spark, root, ["green"], "2023-12-01", "2024-03-01", extracted_at=at).unionByName(
        months.ingest_trips(spark, root, ["yellow"], "1997-12-01", "1998-04-01", extracted_at=at))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "extracted_at")})


_LOCATED_RANGE = "1998-02-10 06:00:00", "1998-03-20"


@query(f"""SELECT l_shipdate AS pickup_datetime, l_shipdate + INTERVAL 1 HOUR AS dropoff_datetime,
      CAST(l_suppkey % 25 AS INTEGER) AS pickup_location_id, CAST(l_partkey % 25 AS INTEGER) AS dropoff_location_id,
      l_extendedprice + extra AS fare_amount, l_linenumber AS payment_type, taxi_type
    FROM lineitem, (VALUES ('green', 0), ('yellow', 1)) AS services(taxi_type, extra)
    WHERE l_linenumber <> 3 AND l_shipdate >= '{_LOCATED_RANGE[0]}' AND l_shipdate < '{_LOCATED_RANGE[1]}'""")
def located_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stricter ingest: two services, every month there, rows without a drop-off time left out."""
    root = fresh_path(spark, "located")
    lineitem = b.table(spark, sf_dir, "lineitem")
    hour = F.col("l_shipdate") + F.expr("INTERVAL 1 HOUR")
    for service, prefix, extra in (("green", "l", 0), ("yellow", "t", 1)):
        rows = lineitem.select(
            F.col("l_shipdate").alias(f"{prefix}pep_pickup_datetime"),
            F.when(F.col("l_linenumber") != 3, hour).alias(f"{prefix}pep_dropoff_datetime"),
            (F.col("l_suppkey") % 25).alias("PULocationID"), (F.col("l_partkey") % 25).alias("DOLocationID"),
            (F.col("l_extendedprice") + extra).alias("fare_amount"), F.col("l_linenumber").alias("payment_type"),
        )
        for month, following in (("1998-02-01", "1998-03-01"), ("1998-03-01", "1998-04-01")):
            path = months.month_paths(root, service, month, following)[0]
            rows.filter(times.in_interval(f"{prefix}pep_pickup_datetime", month, following)).write.parquet(path)
    found = months.ingest_located_trips(spark, root, ["green", "yellow"], *_LOCATED_RANGE)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")})


@query("SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1")
def view_over_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view created over a written table and asked in SQL; a second write of the table is refused."""
    path = fresh_path(spark, "orders")
    tables.write_parquet(_orders(spark, sf_dir), path)
    try:
        tables.write_parquet(_orders(spark, sf_dir).limit(0), path)
    except AnalysisException:
        pass  # the default mode keeps what is there
    view = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_view(files.parquet(spark, path), view)
    return spark.sql(f"SELECT o_orderstatus, COUNT(*) AS n FROM {view} GROUP BY 1")


@query("SELECT c_custkey AS payment_type_id, c_name AS payment_type_name FROM customer")
def empty_then_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table of a declared schema, and the rows that join it."""
    schema = ddl("payment_type_id long, payment_type_name string")
    rows = b.table(spark, sf_dir, "customer").toDF(*["payment_type_id", "payment_type_name", "a", "b", "c"])
    return files.empty(spark, schema).unionByName(rows.select(*schema.names))


@query("SELECT o_orderstatus, COUNT(*) AS n, MAX(o_totalprice) AS largest FROM orders GROUP BY 1")
def parquet_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "spread")
    tables.write_parquet(_orders(spark, sf_dir), path, mode="overwrite", files=24)
    grouped = files.parquet(spark, path, ["o_orderstatus", "o_totalprice"]).groupBy("o_orderstatus")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest"))


@query(f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def csv_to_parquet_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converted once; the second call finds the folder done."""
    target, sources = fresh_path(spark, "converted"), {"orders": _orders_csv(spark, sf_dir)}
    tables.convert_csv(spark, sources, target, ORDER_TEXT)
    tables.convert_csv(spark, sources, target, ORDER_TEXT)
    return files.parquet(spark, f"{target}/orders")


# Partitioned tables


@query("""SELECT strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS quantity
    FROM lineitem WHERE l_shipdate >= '1997-02-01' AND l_shipdate < '1998-02-01' GROUP BY 1""")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per month, clustered, of which a year is read."""
    path = fresh_path(spark, "by-month")
    tables.write_by_month(b.table(spark, sf_dir, "lineitem"), path, "l_shipdate", ["l_suppkey"])
    year = files.parquet(spark, path).filter(F.col("month").between("1997-02", "1998-01"))
    return year.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("quantity")
    )


@query("""SELECT COUNT(DISTINCT user_id) AS distinct_vendors FROM events
    WHERE ts >= '2024-01-03' AND ts < '2024-01-16'""")
def date_partitioned_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per day, of which two weeks are read."""
    path = fresh_path(spark, "by-date")
    tables.write_by_date(b.table(spark, sf_dir, "events"), path, "ts", ["user_id"])
    weeks = files.parquet(spark, path).filter(times.in_interval("ts_date", "2024-01-03", "2024-01-16"))
    return trips.count_distinct(weeks, "user_id", "distinct_vendors")


@query("""SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, COUNT(*) AS n FROM lineitem
    WHERE year(l_shipdate) BETWEEN 1997 AND 1999 GROUP BY 1""")
def integer_range_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-year")
    seasons = b.table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("season_year"))
    tables.write_by_integer_range(seasons, path, "season_year", 1946, 2030, ["l_suppkey"])
    years = F.col("season_year").between(1997, 1999) & F.col("season_year_from").between(1997, 1999)
    kept = files.parquet(spark, path).filter(years)
    return kept.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, -o_totalprice AS o_totalprice, o_orderdate, o_orderpriority FROM orders")
def table_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created from a query, replaced by another, emptied and filled again."""
    orders, where = _orders(spark, sf_dir), fresh_path(spark, "table")
    name = where.rsplit("/", 1)[1].replace("-", "_")  # as unique as the folder: runs on one catalog don't meet
    tables.create_table(orders.select("o_orderkey"), name, location=where)
    tables.create_table(orders, name, location=where)
    negative = orders.withColumn("o_totalprice", -F.col("o_totalprice")).select(*reversed(ORDER_COLUMNS))
    return tables.truncate_insert(negative, name)


# Incremental changes.  The new rows are the whole table again, altered.


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")


def _store_events(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "events")
    tables.write_by_date(_events(spark, sf_dir), path, "ts", ["event_id"])
    return path


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return incremental.read_table(spark, path).select("event_id", "ts", "event_type", "value")


_OLD = "SELECT event_id, ts, event_type, value FROM events"
_WINDOW = "ts >= '2024-01-05 06:30:00' AND ts < '2024-01-20'"
_FIRST, _LAST = "2024-01-05 06:30:00", "2024-01-20"

_REPLACED = f"""{_OLD} WHERE NOT ({_WINDOW})
    UNION ALL SELECT event_id, ts, 'again' AS event_type, value + 1 FROM events WHERE {_WINDOW}"""


def _again(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).withColumns({"event_type": F.lit("again"), "value": F.col("value") + 1})


@query(_REPLACED)
def replace_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.replace_interval(_events(spark, sf_dir), _again(spark, sf_dir), "ts", _FIRST, _LAST)


@query(_REPLACED)
def replace_interval_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In a table partitioned by day, run twice, the first day cut by the interval."""
    path = _store_events(spark, sf_dir)
    for _ in range(2):
        incremental.replace_interval(path, _again(spark, sf_dir), "ts", _FIRST, _LAST, cluster=["event_id"])
    return _stored(spark, path)


@query(_REPLACED.replace("value + 1", "value").replace("'again' AS event_type", "event_type"))
def full_refresh_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows first, then one interval again: nothing changes."""
    path = fresh_path(spark, "refresh")
    incremental.load(path, _events(spark, sf_dir), "ts", _FIRST, _LAST, full_refresh=True)
    incremental.load(path, _events(spark, sf_dir), "ts", _FIRST, _LAST)
    return _stored(spark, path)


def _doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event under twice its number: half of them replace, half are added."""
    return _events(spark, sf_dir).withColumns({"event_id": F.col("event_id") * 2, "value": -F.col("value")})


@query(f"""{_OLD} WHERE event_id NOT IN (SELECT event_id * 2 FROM events)
    UNION ALL SELECT event_id * 2, ts, event_type, -value FROM events""")
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.upsert(_events(spark, sf_dir), _doubled(spark, sf_dir), ["event_id"])


@query(f"""WITH latest AS (SELECT user_id AS event_id, ts, event_type, value FROM events
      QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1)
    {_OLD} WHERE event_id NOT IN (SELECT event_id FROM latest) UNION ALL SELECT * FROM latest""")
def upsert_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows that repeat keys: the newest one of each counts."""
    events = b.table(spark, sf_dir, "events")
    new = events.select(
        F.col("user_id").alias("event_id"), "ts", "event_type", "value", F.col("event_id").alias("number")
    )
    newest = staging.first_per_key(new, ["event_id"], [F.col("ts").desc(), "number"]).drop("number")
    return changes.upsert(_events(spark, sf_dir), newest, ["event_id"])


@query("SELECT event_id, ts, event_type, -value AS value FROM events")
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows replaced in a table partitioned by day, twice."""
    path = _store_events(spark, sf_dir)
    new = _events(spark, sf_dir).withColumns({"value": -F.col("value"), "ts_date": F.to_date("ts")})
    for _ in range(2):
        incremental.upsert(path, new, ["event_id", "ts"], "ts_date")
    return _stored(spark, path)


@query(f"""{_OLD} WHERE event_id % 3 <> 0
    UNION ALL SELECT event_id, ts + INTERVAL 2 DAY, event_type, -value FROM events WHERE event_id % 3 = 0""")
def upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the keys come again two days later: the old rows leave their partitions."""
    path = _store_events(spark, sf_dir)
    moved = _events(spark, sf_dir).filter("event_id % 3 = 0").withColumns(
        {"ts": F.col("ts") + F.expr("INTERVAL 2 DAYS"), "value": -F.col("value")})
    moved = moved.withColumn("ts_date", F.to_date("ts"))
    for _ in range(2):
        incremental.upsert(path, moved, ["event_id"], "ts_date")
    return _stored(spark, path)


_DELETE_INSERT = f"""{_OLD} WHERE event_type NOT IN ('view', 'click')
    UNION ALL SELECT event_id, ts, 'view', value FROM events UNION ALL SELECT event_id, ts, 'click', value FROM events"""


@query(_DELETE_INSERT)
def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key values with a fifth of all rows each."""
    kinds = F.explode(F.array(F.lit("view"), F.lit("click"))).alias("event_type")
    new = _events(spark, sf_dir).select("event_id", "ts", kinds, "value")
    return changes.delete_insert(_events(spark, sf_dir), new, ["event_type"])


@query(_DELETE_INSERT)
def delete_insert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-type")
    tables.write_partitioned(_events(spark, sf_dir), path, "event_type")
    kinds = F.explode(F.array(F.lit("view"), F.lit("click"))).alias("event_type")
    new = _events(spark, sf_dir).select("event_id", "ts", kinds, "value")
    incremental.delete_insert(path, new, ["event_type"], "event_type")
    return _stored(spark, path)


@query(_OLD)
def append_then_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended twice, one row per key kept."""
    path = fresh_path(spark, "appended")
    for mode in ("overwrite", "append"):
        tables.write_parquet(_events(spark, sf_dir), path, mode=mode)
    return staging.first_per_key(files.parquet(spark, path), ["event_id"], ["ts", "event_type", "value"])


@query("SELECT LEAST(COUNT(*), 5) AS taken, LEAST(COUNT(*), 5) AS found FROM events")
def sample_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any five rows, looked up again: as many as asked for, each of them a row of the table."""
    events = b.table(spark, sf_dir, "events")
    taken = topk.sample_rows(events.select("event_id", "ts"), 5)
    back = events.select(F.col("event_id").alias("id"), F.col("ts").alias("at"))
    return taken.join(back, (F.col("event_id") == F.col("id")) & F.col("ts").eqNullSafe(F.col("at")), "left").agg(
        F.count(F.lit(1)).alias("taken"), F.count("id").alias("found"))
