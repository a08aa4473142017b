"""Session settings for local runs. On a cluster the submitter's settings are used as they are."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, app: str = "turnwarden") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS") or os.cpu_count()
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Patterns are costly per byte, so small shuffles are not folded into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Patterns cost far more per byte than reading, so even small tables are read in several pieces.
        .config("spark.sql.files.maxPartitionBytes", "1m").config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.driver.memory", os.environ.get("TURNWARDEN_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
