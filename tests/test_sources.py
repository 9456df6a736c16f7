import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.schemas import ddl
from wayfare.plans import flows
from wayfare.sources import files, months
from wayfare.sinks import tables

D = dt.datetime


def test_month_range():
    assert list(months.months_between("2024-11-15", "2025-02-01")) == [(2024, 11), (2024, 12), (2025, 1)]
    assert list(months.months_between("2024-01-31 23:00:00", dt.date(2024, 2, 1))) == [(2024, 1)]
    assert list(months.months_between("2024-02-01", "2024-02-01")) == []
    assert months.month_paths("/r/", "green", "2024-01-01", "2024-02-01") == ["/r/green_tripdata_2024-01.parquet"]


@pytest.fixture
def raw(spark, tmp_path):
    root = str(tmp_path / "raw")
    yellow = [(D(2024, 1, 31, 23), D(2024, 2, 1), 1, 2.0, 5.0, 1, 7, 8), (None, D(2024, 1, 1), 1, 2.0, 5.0, 1, 7, 8)]
    kind = "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count {}, trip_distance double, " \
           "fare_amount double, payment_type {}, PULocationID int, DOLocationID long"
    spark.createDataFrame(yellow, kind.format("int", "int")).write.parquet(f"{root}/yellow_tripdata_2024-01.parquet")
    later = spark.createDataFrame([(D(2024, 3, 1), D(2024, 3, 1), 2, 1.0, 2.0, 3, 7, 8)], kind.format("long", "long"))
    later.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(f"{root}/yellow_tripdata_2024-03.parquet")
    green = spark.createDataFrame([(D(2024, 2, 1), D(2024, 2, 2), 4, "cash")],
                                  "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, pulocationid int, payment_type string")
    green.write.parquet(f"{root}/green_tripdata_2024-02.parquet")
    return root


def test_ingest_skips_missing_months_and_settles_types(spark, raw):
    df = months.ingest_trips(spark, raw, ["yellow", "green"], "2024-01-01", "2024-04-01", extracted_at=D(2024, 5, 1))
    assert df.columns == schemas.INGESTED_TRIPS.names
    rows = {(r.taxi_type, r.pickup_datetime, r.passenger_count, r.payment_type, r.extracted_at) for r in df.collect()}
    assert rows == {
        ("yellow", D(2024, 1, 31, 23), 1, 1, D(2024, 5, 1)), ("yellow", None, 1, 1, D(2024, 5, 1)),
        ("yellow", D(2024, 3, 1), 2, 3, D(2024, 5, 1)), ("green", D(2024, 2, 1), None, None, D(2024, 5, 1)),
    }


def test_ingest_without_any_file_has_the_columns(spark, raw):
    df = months.ingest_trips(spark, raw, ["fhv"], "2024-01-01", "2024-04-01")
    assert df.columns == schemas.INGESTED_TRIPS.names and df.count() == 0


def test_strict_ingest(spark, raw):
    with pytest.raises(FileNotFoundError, match="yellow_tripdata_2024-02"):
        months.ingest_located_trips(spark, raw, ["yellow"], "2024-01-01", "2024-04-01")
    df = months.ingest_located_trips(spark, raw, ["yellow"], "2024-01-31", "2024-02-01")
    row = df.first()
    assert df.count() == 1 and (row.pickup_location_id, row.dropoff_location_id, row.taxi_type) == (7, 8, "yellow")


def test_a_corrupt_file_is_an_error(spark, tmp_path):
    (tmp_path / "yellow_tripdata_2024-01.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        months.ingest_trips(spark, str(tmp_path), ["yellow"], "2024-01-01", "2024-02-01").collect()


def test_csv_readers(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\nx,Queens,\"Jamaica, Bay\",\n")
    assert {f.dataType.simpleString() for f in files.csv_strings(spark, str(path)).schema} == {"string"}
    typed = files.csv_typed(spark, str(path), schemas.ZONES).collect()
    assert [(r.LocationID, r.Zone) for r in typed] == [(1, "Newark Airport"), (None, "Jamaica, Bay")]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.seed(spark, str(path), schemas.ZONES).collect()
    path.write_text("a,b\n1,2024-01-01 00:00:00\n2,\n")
    assert [t for _, t in files.csv_inferred(spark, str(path)).dtypes] == ["int", "timestamp"]
    assert [f.dataType.simpleString() for f in files.propose_schema(spark, str(path), rows=1)] == ["int", "timestamp"]


def test_convert_only_what_is_not_done(spark, tmp_path):
    for name in ("m1", "m2"):
        (tmp_path / f"{name}.csv").write_text("a,b\n1,x\n")
    sources = {n: str(tmp_path / f"{n}.csv") for n in ("m1", "m2")}
    target, kind = str(tmp_path / "out"), ddl("a int, b string")
    assert tables.convert_csv(spark, {"m1": sources["m1"]}, target, kind) == ["m1"]
    assert tables.convert_csv(spark, sources, target, kind) == ["m2"]
    assert files.parquet_merged(spark, [f"{target}/m1", f"{target}/m2"]).count() == 2


def test_write_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(10)
    tables.write_parquet(df, path, files=3)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        tables.write_parquet(df, path)
    tables.write_parquet(df, path, mode="append")
    assert spark.read.parquet(path).count() == 20
    tables.write_parquet(df, path, mode="overwrite", files=1)
    assert spark.read.parquet(path).count() == 10


def test_integer_range_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_by_integer_range(spark.range(0, 50).withColumnRenamed("id", "n"), path, "n", 10, 40, step=10)
    counts = {r.n_from: r["count"] for r in spark.read.parquet(path).groupBy("n_from").count().collect()}
    assert counts == {10: 10, 20: 10, 30: 10, None: 20}
    tables.write_by_integer_range(spark.range(0, 50).withColumnRenamed("id", "n"), path, "n", 10, 13)
    rows = {(r.n_from, r.n) for r in spark.read.parquet(path).collect()}
    assert rows == {(n if 10 <= n < 13 else None, n) for n in range(50)}


def test_views_and_sql(spark):
    df = spark.range(5)
    assert tables.create_view(df, "wayfare_five").count() == 5
    assert files.query(spark, "SELECT count(*) AS n FROM {numbers}", numbers=df).first().n == 5
    assert files.empty(spark, schemas.ZONES).columns == schemas.ZONES.names


def test_rows_of_files_by_prefix(spark, tmp_path):
    for name, rows in (("yellow_2020", 3), ("yellow_2021", 4)):
        spark.range(rows).coalesce(1).write.parquet(str(tmp_path / name))
        next((tmp_path / name).glob("part-*.parquet")).rename(tmp_path / f"{name}.parquet")
    df = spark.read.parquet(str(tmp_path / "yellow_2020.parquet"), str(tmp_path / "yellow_2021.parquet"))
    assert files.from_files_starting(df, "yellow_2020").count() == 3
    assert {r.filename for r in files.with_file_name(df).collect()} == {"yellow_2020.parquet", "yellow_2021.parquet"}


def test_hire_vehicle_flow(spark, tmp_path):
    head = "dispatching_base_num,affiliated_base_number,pickup_datetime,dropoff_datetime,pulocationid,dolocationid,sr_flag\n"
    (tmp_path / "m1.csv").write_text(head + "B1,B2,2019-01-05 10:00:00,2019-01-05 10:20:00,7,8,\n,,2019-01-05 10:00:00,,,,\n")
    (tmp_path / "m2.csv").write_text(head + "B3,,2019-02-01 00:00:00,2019-02-01 00:10:00,,9,1\n")
    sources = {n: str(tmp_path / f"{n}.csv") for n in ("m1", "m2")}
    staged = flows.run_fhv(spark, sources, str(tmp_path / "warehouse"))
    got = sorted((r.dispatching_base_num, r.pickup_location_id, r.pickup_datetime) for r in staged.collect())
    assert got == [("B1", 7, D(2019, 1, 5, 10)), ("B3", None, D(2019, 2, 1))]
    sample = flows.run_fhv(spark, sources, str(tmp_path / "warehouse"), ("2019-01-01", "2019-02-01"))
    assert sample.count() == 1


def _footer_jobs(spark, read):
    """What ``read`` returns and how many Spark jobs it took."""
    group = f"footers-{id(read)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = read()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_footers_of_any_number_of_files_are_one_job(spark, tmp_path):
    for i in range(12):
        spark.range(1).select("id", F.lit(i).alias(f"only_{i}")).write.parquet(str(tmp_path / f"m{i}"))
    paths = [str(tmp_path / f"m{i}") for i in range(12)]
    runs, jobs = _footer_jobs(spark, lambda: files.merged_runs(spark, paths))
    assert (len(runs), jobs) == (1, 1)
    assert sorted(runs[0].columns) == sorted(["id", *[f"only_{i}" for i in range(12)]])


def test_files_that_do_not_merge_stay_apart(spark, tmp_path):
    for i, kind in enumerate(["int", "int", "string", "double", "double"]):
        spark.range(2).select(F.col("id").cast(kind).alias("n"), F.lit(i).alias("file")).write.parquet(str(tmp_path / f"m{i}"))
    paths = [str(tmp_path / f"m{i}") for i in range(5)]
    got = files.parquet_merged(spark, paths, ddl("n long"))
    assert sorted((r.file, r.n) for r in got.collect()) == [(i, n) for i in range(5) for n in (0, 1)]
    (tmp_path / "m2" / "part-0.parquet").write_text("no Parquet")
    with pytest.raises(Exception, match="m2"):
        files.parquet_merged(spark, paths, ddl("n long"))


def test_each_file_has_its_own_name_for_a_column(spark, tmp_path):
    columns = [("lpep_pickup_datetime",), ("pickup_datetime",), ("tpep_pickup_datetime", "lpep_pickup_datetime")]
    for month, names in enumerate(columns, 1):
        df = spark.createDataFrame([tuple(f"2024-0{month}-0{k + 1} 00:00:00" if k or month < 3 else None
                                          for k in range(len(names)))], ", ".join(f"{n} string" for n in names))
        df.write.parquet(str(tmp_path / f"green_tripdata_2024-0{month}.parquet"))
    got = months.read_months(spark, str(tmp_path), "green", "2024-01-01", "2024-04-01", ddl("pickup_datetime timestamp"))
    # The third file's first name counts, though it is NULL and the other name has a time.
    assert {str(r[0]) for r in got.select("pickup_datetime").collect()} == {"2024-01-01 00:00:00", "2024-02-01 00:00:00", "None"}
