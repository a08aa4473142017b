"""Sliding-window admission on a stream: the batch operator on every micro-batch, over a small table of what was admitted before.

The state is a table (user, at) of at most ``max_requests`` newest admitted times per user. A micro-batch reads the table of the
batch before it, puts those times in front of its own requests as carried rows, and lets the batch operator decide: sorted and folded by
partition, hot users cut into stretches. No user's requests are gathered, whatever their share of a batch. Requests of a batch
are taken in (time, id) order; what an earlier batch decided stays decided.

Outcome and state of a batch are written to folders with its number, so a batch that is run again replaces its own and reads the
same state as before. Times that no request can see any more, and states that no batch can need again, are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.operators.ordered import GROUP_ROWS
from turnwarden.operators.rate_limit import decide, requests
from turnwarden.sources.shared import new_folder, remove
from turnwarden.streaming.run import drain_batches

STATE = "user string, at long"


class Admission:
    """A ``foreachBatch`` handler that admits the requests of a stream and keeps outcome and state below ``folder``.

    ``late_seconds`` is how far behind the newest request one may still arrive; times older than that and the window go.
    """

    def __init__(self, folder: str, id_column: str, user: str, ts: str, max_requests: int = fixed.RATE_MAX_REQUESTS,
                 window_seconds: float = fixed.RATE_WINDOW_SECONDS, late_seconds: float = 3600, group_rows: int = GROUP_ROWS):
        self.folder, self.columns, self.most, self.group_rows = folder, (id_column, user, ts), max_requests, group_rows
        self.window, self.late = int(round(window_seconds * 1_000_000)), int(late_seconds * 1_000_000)

    def state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What was admitted up to the end of a batch."""
        if batch_id < 0:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(f"{self.folder}/state/batch_id={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        asked, before = requests(batch, *self.columns).persist(), self.state(spark, batch_id - 1)
        try:
            kind = asked.schema["id"].dataType
            carried = before.select("user", "at", F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("tag"), F.lit(True).alias("carried"))
            # Only users who ask now need their earlier times.
            carried = carried.join(asked.select("user").distinct(), "user", "left_semi")
            decided = decide(asked.unionByName(carried), self.most, self.window, self.group_rows)
            path = f"{self.folder}/decided/batch_id={batch_id}"
            decided.write.mode("overwrite").parquet(path)
            decided = spark.read.schema(decided.schema).parquet(path)
            known = decided.filter("admitted").select("user", "at").unionByName(before)
            newest = known.agg(F.max("at")).first()[0] or 0
            place = F.row_number().over(Window.partitionBy("user").orderBy(F.col("at").desc()))
            kept = known.filter(F.col("at") >= newest - self.window - self.late).withColumn("n", place).filter(F.col("n") <= self.most)
            kept.select("user", "at").write.mode("overwrite").parquet(f"{self.folder}/state/batch_id={batch_id}")
        finally:
            asked.unpersist()
        remove(spark, f"{self.folder}/state/batch_id={batch_id - 2}")


def admitted(spark: SparkSession, folder: str) -> DataFrame:
    """(id, user, admitted) of all requests decided so far."""
    return spark.read.parquet(f"{folder}/decided").select("id", "user", "admitted")


def rate_limit_stream(stream: DataFrame, id_column: str, user: str, ts: str, max_requests: int = fixed.RATE_MAX_REQUESTS,
                      window_seconds: float = fixed.RATE_WINDOW_SECONDS, late_seconds: float = 3600, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Admit everything that is there now: (id, user, admitted) for each request of the stream."""
    folder = new_folder(stream.sparkSession, "admission")
    drain_batches(stream, Admission(folder, id_column, user, ts, max_requests, window_seconds, late_seconds, group_rows), "admission")
    return admitted(stream.sparkSession, folder)
