"""Where written intermediate tables and stream checkpoints go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder: on a
    cluster such a folder would be seen by one machine only.  It goes when
    Python ends; what lies in a named folder is its owner's to clear, since
    lazy results may still read it.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="wayfare-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set(CHECKPOINT_DIR, own)
    return spark.conf.get(CHECKPOINT_DIR)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
