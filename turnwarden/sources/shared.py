"""Where jobs may put tables that other tasks read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    It is set here only where it is unset and the session is a local one, as in tests; a cluster without it is an
    error, because a folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="turnwarden-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df, purpose: str, **options):
    """``df`` written to the shared folder and read back: lineage is cut and survives lost executors. ``options`` are the writer's."""
    path = new_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
