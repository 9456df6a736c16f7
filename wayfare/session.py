"""Session settings the operators are written against."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a cluster alike.  Sizes that depend on
# the cluster (executor memory, shuffle partitions) stay with the caller.
COMMON = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # AQE coalesces small shuffle partitions, splits skewed join partitions and
    # turns a sort-merge join into a broadcast one once a side's size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python call sites in error messages; looking one up for every column
    # makes wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

STREAMING = {
    # Merge the sessions of one map task before the shuffle, so a hot key
    # reaches its state partition as sessions, not as single events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Window state larger than the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare_streams(spark: SparkSession) -> None:
    """Set what streams need where the session's owner has not decided."""
    for key, value in STREAMING.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def local_session(app: str = "wayfare", cpus: int | None = None, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**COMMON, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
