"""Plain writes of Parquet folders, tables and relational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.sources import files
from wayfare.sources.storage import Storage


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None) -> None:
    """Write a folder of Parquet files.

    ``files`` asks for that many through a shuffle.  Unlike ``coalesce`` this
    leaves the stages before the write as wide as they are; one file is for
    reports that are small by then.
    """
    (df.repartition(files) if files else df).write.mode(mode).parquet(path)


def laid_out(df: DataFrame, partition: str, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows arranged for a write partitioned by one column.

    Rebalancing brings the rows of a partition value together for few, large
    files, and AQE splits a value that is too large for one task.  Sorting by
    the cluster columns lets readers skip row groups by their min and max.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def write_partitioned(
    df: DataFrame, path: str, partition: str, cluster: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    laid_out(df, partition, cluster).write.mode(mode).partitionBy(partition).parquet(path)


def write_by_date(df: DataFrame, path: str, time: str, cluster: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Partition by the calendar day of a time column, in column ``<time>_date``."""
    dated = df.withColumn(f"{time}_date", F.to_date(time))
    write_partitioned(dated, path, f"{time}_date", cluster, mode)


def write_by_month(df: DataFrame, path: str, time: str, cluster: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Partition by the month of a date or time column, in column ``month`` as ``2024-01``."""
    write_partitioned(df.withColumn("month", F.date_format(time, "yyyy-MM")), path, "month", cluster, mode)


def write_by_integer_range(
    df: DataFrame, path: str, column: str, low: int, high: int, cluster: Sequence[str] = (), step: int = 1,
    mode: str = "overwrite",
) -> None:
    """Partition by an integer column, in steps from ``low`` up to but not including ``high``.

    The partition column is ``<column>_from``, the first value of the step.
    Values out of range and NULL share its NULL partition; the column itself
    keeps every value.
    """
    value = F.col(column)
    first = (F.floor((value - low) / step) * step + low).cast("int")
    inside = (value >= low) & (value < high)
    ranged = df.withColumn(f"{column}_from", F.when(inside, first))
    write_partitioned(ranged, path, f"{column}_from", [column, *cluster], mode)


def create_table(
    df: DataFrame, name: str, partition: str | None = None, cluster: Sequence[str] = (), location: str | None = None
) -> DataFrame:
    """Create or replace a Parquet table from a query, and return it.

    With a location the files go there, otherwise into the warehouse.
    """
    writer = (laid_out(df, partition, cluster) if partition else df).write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def truncate_insert(df: DataFrame, name: str) -> DataFrame:
    """Replace the rows of a table and keep its schema; columns go by name."""
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def convert_csv(
    spark: SparkSession, sources: dict[str, str], target: str, schema: StructType, *, spread: int | None = None
) -> list[str]:
    """Convert CSV files to Parquet folders ``target/<name>``; skip those done.

    ``sources`` maps names to CSV paths.  A folder counts as done once Spark
    has marked its write as successful.  Returns the names converted.
    """
    storage, converted = Storage(spark), []
    for name, path in sources.items():
        folder = f"{target.rstrip('/')}/{name}"
        if storage.exists(f"{folder}/_SUCCESS"):
            continue
        write_parquet(files.csv_typed(spark, path, schema, spread=spread), folder, mode="overwrite")
        converted.append(name)
    return converted


def load_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """Write to a relational table, one connection per task; needs its driver.

    ``overwrite`` creates the table, later loads use ``append``.
    """
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, **options).save()
