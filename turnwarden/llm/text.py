"""Words and small helpers shared by the operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnwarden.sources.shared import remove, settle

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
#: Bits of the map that chooses rows by their keys; beyond a quarter of as many keys, rows are joined without it.
BITS = 1 << 24


def words(text: Column) -> Column:
    """The maximal runs of other characters than ``GAP``, in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def computed_once(df: DataFrame, keep, columns) -> DataFrame:
    """``df`` with ``columns`` taken through a one-row generator.

    The optimizer moves filters below projections by copying the expressions they name. It does not move them below what
    generates the column, so a filter on ``columns`` never computes them again, while one on ``keep`` still reaches the scan.
    """
    return df.select(*keep, F.explode(F.array(F.struct(*columns))).alias("_once")).select(*keep, "_once.*")


def numbered(df: DataFrame, order: list[Column], name: str, purpose: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the given order, without gathering the rows in one task.

    Rows are dealt out by ranges of ``order`` and written; each range counts its rows, and only these counts (one per range)
    pass through the driver.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), purpose)
    offsets, total = [], 0
    for row in ranged.groupBy("_range").count().orderBy("_range").collect():
        offsets.append((row["_range"], total))
        total += row["count"]
    starts = spark.createDataFrame(offsets, "_range int, _start long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn(
        name, F.col("_start") + F.col("_place")).drop("_range", "_start", "_place")


def bit_place(*key: str) -> Column:
    """The place of a key in a bit map."""
    return F.xxhash64(*key).bitwiseAND(F.lit(BITS - 1))


def bit_words(keys: DataFrame, *key: str) -> DataFrame | None:
    """The words of a bit map of the places of ``keys``: ``_w``, number, and ``_b``, bits; at most ``BITS`` / 64 rows. None if the keys are
    too many for it."""
    if keys.count() > BITS // 4:
        return None
    return keys.select(bit_place(*key).alias("p")).select(F.shiftright("p", 6).alias("_w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("_b")) \
        .groupBy("_w").agg(F.bit_or("_b").alias("_b"))


def parted(df: DataFrame, keys: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: the rows whose key is (or, seldom, seems to be) one of ``keys``, and the rows whose key is none, which need not be
    shuffled to find that out. If the keys are too many for a bit map, the second part is empty."""
    words = bit_words(keys, *key)
    if words is None:
        return df, df.limit(0)
    marked = df.withColumn("_p", bit_place(*key)).join(F.broadcast(words), F.shiftright("_p", 6) == F.col("_w"), "left")
    seen = F.expr("coalesce(shiftright(_b, cast(_p & 63 as int)) & 1, 0) = 1")
    return marked.filter(seen).select(*df.columns), marked.filter(~seen).select(*df.columns)


def released(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder; shuffle files that only it needed can go at once instead of when the driver's
    memory happens to be collected."""
    out = settle(df, purpose)
    del df
    gc.collect()
    out.sparkSession._jvm.System.gc()
    return out


def forgotten(*tables: DataFrame) -> None:
    """Remove the folders of settled ``tables`` that nothing will read again: what was made of them is written itself."""
    for table in tables:
        for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
            remove(table.sparkSession, folder)
