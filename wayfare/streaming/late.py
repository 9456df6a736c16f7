"""Late records, kept: what windowed aggregates leave out goes to a table of its own, record by record."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wayfare.sources.storage import Storage
from wayfare.streaming.queries import for_each_batch
from wayfare.streaming.windows import EVENT_TIME, LATENESS

#: Below the table's folder: the latest event time up to each batch, a small file each.
SEEN, LATE = ".seen", "late"

#: A batch's late records are told by the watermark that the batch before it began with, so by the events up to two back.
BEHIND = 2

#: Before any event.
NEVER = -(2**62)


def late_to_files(
    events: DataFrame, path: str, checkpoint: str, size: str, *, time: str = EVENT_TIME, bound: str = LATENESS,
    drain: bool = False,
) -> StreamingQuery:
    """Write the events whose window of ``size`` had closed when they came, whole and each once.

    A window has closed when its end is not after the latest event time of the
    batches up to the last but one, less ``bound``: the events that
    ``windows.tumbling`` leaves out of a stream in the same batches.  A batch
    that comes again replaces its own files.  An event without a time is in no
    window and so not late.  Batches are read once: the latest event time is
    measured while late records are written.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        closed = _seen(spark, path, number - BEHIND)
        watching = Observation()
        watched = batch.observe(watching, F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("latest"))
        placed = watched.withColumn("_end", F.window(time, size)["end"].cast("timestamp"))
        less = F.timestamp_micros(F.lit(closed)) - F.expr(f"INTERVAL {bound}") if closed > NEVER else F.lit(dt.datetime.min)
        late = placed.filter(F.col("_end") <= less).drop("_end")
        late.write.mode("overwrite").parquet(f"{path}/{LATE}/batch={number}")
        latest = watching.get["latest"]
        _remember(spark, path, number, max(_seen(spark, path, number - 1), NEVER if latest is None else latest))

    return for_each_batch(events, write, checkpoint, drain=drain)


def _seen(spark: SparkSession, path: str, number: int) -> int:
    """The latest event time up to a batch, in microseconds."""
    return int(Storage(spark).read(f"{path}/{SEEN}/{number:012d}")) if number >= 0 else NEVER


def _remember(spark: SparkSession, path: str, number: int, micros: int) -> None:
    storage, place = Storage(spark), f"{path}/{SEEN}/{number:012d}"
    if storage.exists(place):
        return  # of an earlier attempt at the same batch, so the same
    draft = f"{path}/{SEEN}/.{uuid.uuid4().hex}"
    storage.write(draft, str(micros))
    storage.rename(draft, place)


def read_late(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """The late records so far with the number of the batch they came in, by the columns of ``events``."""
    schema = T.StructType([*events.schema.fields, T.StructField("batch", T.IntegerType())])
    if not Storage(spark).exists(f"{path}/{LATE}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/{LATE}").parquet(f"{path}/{LATE}")
