"""Start, drain and read back streaming queries; checkpoints and outputs live in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from turnwarden.sources.shared import new_folder


def start_to_files(stream: DataFrame, folder: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append") \
        .option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one, of the same cluster and catalog, whose streams keep their state in RocksDB."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def drain(stream: DataFrame, purpose: str, reader: SparkSession | None = None) -> DataFrame:
    """Process everything that is there now and return what was written, as a table (of the session ``reader``)."""
    spark = reader or stream.sparkSession
    out, checkpoint = new_folder(spark, purpose), new_folder(spark, f"{purpose}-checkpoint")
    start_to_files(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], purpose: str, mode: str = "append") -> None:
    """Process everything that is there now, batch by batch. ``handle`` must give the same result when repeated."""
    checkpoint = new_folder(stream.sparkSession, f"{purpose}-checkpoint")
    (stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
