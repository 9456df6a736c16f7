"""Starting streams: sinks that append and sinks that keep one row per key."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from wayfare.session import prepare_streams
from wayfare.sinks import incremental

CHECKPOINT_INTERVAL = "10 seconds"


def _triggered(writer: DataStreamWriter, checkpoint: str, drain: bool) -> DataStreamWriter:
    """``drain`` works off what is there and stops; else a batch every ten seconds.

    Offsets and state are in the checkpoint after each batch, so a restart
    goes on where the last complete batch ended.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=CHECKPOINT_INTERVAL)


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, *, partition: str | None = None, drain: bool = False
) -> StreamingQuery:
    """Append results to a Parquet folder, each row once.

    Windows are written when the watermark has passed their end.
    """
    prepare_streams(stream.sparkSession)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition:
        writer = writer.partitionBy(partition)
    return _triggered(writer, checkpoint, drain).start()


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
    mode: str = "append", drain: bool = False,
) -> StreamingQuery:
    """Hand each batch of results to ``write``, as for a relational sink.

    A batch may be handed over again after a failure.
    """
    prepare_streams(stream.sparkSession)
    return _triggered(stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint, drain).start()


def upsert_to_table(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, *,
    window: str = "window_start", mode: str = "update", drain: bool = False,
) -> StreamingQuery:
    """Keep one row per key in a table partitioned by the day of its windows.

    In ``update`` mode open windows are there too and change as events come
    in.  A batch that is repeated writes the same rows.  Sessions cannot be
    updated: use ``append`` for them.
    """
    day = f"{window}_date"

    def write(batch: DataFrame, _: int) -> None:
        incremental.upsert(path, batch.withColumn(day, F.to_date(window)), keys, day)

    return for_each_batch(stream, write, checkpoint, mode=mode, drain=drain)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; a failure in it is raised here."""
    query.awaitTermination()
    return query


class DropCounter(StreamingQueryListener):
    """Adds up the rows that the session's streams leave out because their window had closed.

    Every progress report is counted as it comes: a query itself keeps only
    the last of them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.dropped, self.running = spark, 0, set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self.running.add(event.id)

    def onQueryProgress(self, event) -> None:
        self.dropped += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running.discard(event.id)

    def stop(self, patience: float = 30.0) -> int:
        """The rows so far, after the reports of all queries; an error if one has not ended or reported in time."""
        until = time.monotonic() + patience
        while self.running and time.monotonic() < until:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        if self.running:
            raise TimeoutError(f"{len(self.running)} streams have not ended: the count would not be whole")
        return self.dropped


def drain_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Work off a stream into a folder and read that folder."""
    spark: SparkSession = stream.sparkSession
    finish(append_to_files(stream, path, checkpoint, drain=True))
    return spark.read.schema(stream.schema).parquet(path)
