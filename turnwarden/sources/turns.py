"""Turn, tool-call and document sources, batch and streaming. Schemas are given, never inferred, on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONVERSATION_SCHEMA = "conv_id long, turn long, role string, text string"
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
TURN_SCHEMA = "turn_id long, ts timestamp, session_id string, user_id string, run_id string, text string"


#: The session setting behind ``parallelism``; unset, tables are read as they are stored.
PARALLELISM = "turnwarden.read.parallelism"


def read_table(spark: SparkSession, folder: str, name: str, parallelism: int | None = None) -> DataFrame:
    """A table, as many tasks as it has row groups. ``parallelism`` deals the rows of a table with fewer row groups than that out to
    so many tasks, of the columns that are used; tables of many row groups need none of it."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    tasks = parallelism or int(spark.conf.get(PARALLELISM, "0"))
    return table.repartition(tasks) if tasks else table


def stream_table(spark: SparkSession, folder: str, name: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """The files of a table as a stream: ``<folder>/<name>.parquet``, a file or a folder of files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A glob path, because a stream over a plain path must be a folder.
    return reader.option("pathGlobFilter", "*.parquet").parquet(f"{folder.rstrip('/')}/{name}.parquet*")


def session_name(value: Column) -> Column:
    """``cli-`` and eight hex digits, the same for the same value."""
    return F.concat(F.lit("cli-"), F.substring(F.sha2(value.cast("string"), 256), 1, 8))
