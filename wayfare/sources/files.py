"""File scans: CSV, Parquet, directories, seeds, registered tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfare.functions.columns import cast_to, union_by_name
from wayfare.sources.storage import Storage

Paths = str | Sequence[str]


def _list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def csv_strings(spark: SparkSession, paths: Paths) -> DataFrame:
    """CSV with a header line; every column is text."""
    return spark.read.option("header", True).csv(_list(paths))


def csv_typed(
    spark: SparkSession, paths: Paths, schema: StructType, *, spread: int | None = None, mode: str = "PERMISSIVE"
) -> DataFrame:
    """CSV, plain or gzipped, with a declared schema; bad values are NULL.

    A gzipped file cannot be split, so one task reads it whole; ``spread``
    deals its rows out round-robin for the stages behind the read.
    """
    df = spark.read.schema(schema).option("header", True).option("mode", mode).csv(_list(paths))
    return df.repartition(spread) if spread else df


def csv_inferred(spark: SparkSession, paths: Paths, *, sample: float = 1.0) -> DataFrame:
    """CSV whose types are found by reading (a share of) it once beforehand."""
    return spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", sample).csv(_list(paths))


def propose_schema(spark: SparkSession, paths: Paths, *, rows: int = 1000) -> StructType:
    """Types found in the first rows of a CSV: a draft for a declared schema."""
    head = spark.read.text(_list(paths)).limit(rows + 1)
    lines = [r.value for r in head.collect()]  # bounded by ``rows``
    return (
        spark.read.option("header", True).option("inferSchema", True)
        .csv(spark.sparkContext.parallelize(lines, 1)).schema
    )


def parquet(spark: SparkSession, paths: Paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; with ``columns`` only these are read from the files."""
    df = spark.read.parquet(*_list(paths))
    return df.select(*columns) if columns else df


def parquet_tree(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files below a root, at any depth.

    Folder names such as ``year=2020`` yield no columns here; use ``parquet``
    on the root to get them and to prune by them.
    """
    return spark.read.option("recursiveFileLookup", True).parquet(root)


def parquet_merged(spark: SparkSession, paths: Paths, schema: StructType | None = None) -> DataFrame:
    """Files with differing columns as one frame, matched by name.

    Without ``schema`` the files may differ in columns but not in a column's
    type.  With it they may differ in both: the columns it names are cast.
    Files that merge share one scan, so the plan grows with the number of type
    changes and not with the number of files.
    """
    if schema is None:
        return _merged(spark, _list(paths))
    return union_by_name([cast_to(run, schema) for run in merged_runs(spark, _list(paths))])


def _merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def merged_runs(
    spark: SparkSession, paths: Sequence[str], apart: Callable[[Sequence[str]], bool] = lambda names: False
) -> list[DataFrame]:
    """Files with differing columns and types as few scans, each of neighbours in the list that merge by name.

    One Spark job reads the footers of all files in its tasks and merges their
    schemas there.  Where two files give one column different types, or where
    ``apart`` says that columns must not come together, the list is halved:
    jobs grow with the number of places at which the files change, not with
    the number of files.  A file that can't be read is an error.
    """
    try:
        run = _merged(spark, paths)
    except (Py4JJavaError, PySparkException) as error:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    else:
        if len(paths) == 1 or not apart(run.columns):
            return [run]
    middle = len(paths) // 2
    return merged_runs(spark, paths[:middle], apart) + merged_runs(spark, paths[middle:], apart)


def external_table(spark: SparkSession, name: str, pattern: str) -> DataFrame:
    """A named view over the Parquet files that match a wildcard path."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` USING parquet OPTIONS (path '{pattern}')")
    return spark.table(name)


def with_file_name(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the name of the file each row came from."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def from_files_starting(df: DataFrame, prefix: str) -> DataFrame:
    """Rows of the files whose name begins with ``prefix``.

    The condition is on file metadata, so other files are not opened.
    """
    return df.filter(F.startswith(F.col("_metadata.file_name"), F.lit(prefix)))


def seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A lookup table kept as a CSV file; a malformed line is an error."""
    return csv_typed(spark, path, schema, mode="FAILFAST")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def register(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Name frames for use in ``spark.sql``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over the given frames, named in it as ``{name}``."""
    return spark.sql(text, **frames)


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table.  Give ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, or one task reads all of it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    storage = Storage(spark)
    return [p for p in paths if storage.exists(p)]
