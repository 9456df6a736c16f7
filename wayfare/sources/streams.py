"""Stream scans: JSON records on a topic, or files arriving in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BAD_RECORD = "bad_record"


def parse_records(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Typed columns from JSON text; ``bad_record`` holds the text that is no such record."""
    text = F.col(value).cast("string")
    with_slot = StructType([*schema.fields]).add(BAD_RECORD, "string")
    parsed = F.from_json(text, with_slot, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD})
    return raw.select(parsed.alias("r")).select("r.*")


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def bad_records(parsed: DataFrame) -> DataFrame:
    """The quarantine: texts that did not parse."""
    return parsed.filter(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def record_of(*columns: str) -> Column:
    """The columns of a row as one JSON text."""
    return F.to_json(F.struct(*columns))


def to_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, in column ``value``: what a topic sink takes."""
    return df.select(record_of(*df.columns).alias("value"))


def topic(
    spark: SparkSession, servers: str, name: str, schema: StructType, *, offsets: str = "earliest", **options: str
) -> DataFrame:
    """JSON records of a Kafka topic as a stream; needs the Kafka package."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", name)
        .option("startingOffsets", offsets).options(**options).load()
    )
    return parse_records(raw, schema)


def topic_drained(spark: SparkSession, servers: str, name: str, schema: StructType, **options: str) -> DataFrame:
    """All records a Kafka topic holds now, as a static frame."""
    raw = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", name)
        .option("startingOffsets", "earliest").option("endingOffsets", "latest").options(**options).load()
    )
    return parse_records(raw, schema)


def record_files(
    spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of JSON arriving as text files, parsed as on a topic."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_records(reader.text(path), schema)


def parquet_files(
    spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving in a folder or matching a wildcard."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
