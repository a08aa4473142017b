"""Ordered work per key when one key may hold a large share of all rows.

A window over a key runs in one task. Keys with more rows than ``group_rows`` are therefore cut, along the ordering
column, into stretches of about that size. The cut points are quantiles of the key's own values, written to the shared
folder so that a recomputed task sees the same stretches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwarden.sources.shared import settle

GROUP_ROWS = 5_000_000


def cut_hot_keys(df: DataFrame, key: str, order: str, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Split ``df`` into (rows of ordinary keys, rows of hot keys with a ``stretch`` number), or (df, None).

    ``order`` must be numeric. Stretches are numbered without gaps from 0 and rows with equal ``order`` share one.
    The NULL key is a key like any other.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > group_rows)
    largest = sizes.agg(F.max("_rows")).first()[0]
    if largest is None:
        return df, None
    pieces = -(-largest // group_rows) + 1
    hot_keys = settle(sizes.select(F.col(key).alias("_hot")), "hot-keys")
    hot = df.join(hot_keys, F.col(key).eqNullSafe(F.col("_hot")), "left_semi")
    cold = df.join(hot_keys, F.col(key).eqNullSafe(F.col("_hot")), "left_anti")
    fractions = [i / pieces for i in range(1, pieces)]
    cuts = settle(hot.groupBy(F.col(key).alias("_hot")).agg(
        F.array_sort(F.array_distinct(F.percentile_approx(order, fractions, 10 * pieces + 10_000))).alias("_cuts")),
        "cut-points")
    hot = (hot.join(cuts, F.col(key).eqNullSafe(F.col("_hot")))
           .withColumn("stretch", F.size(F.filter("_cuts", lambda c: c < F.col(order))))
           .drop("_hot", "_cuts"))
    return cold, hot


def over_neighbours(df: DataFrame, key: str, order: str, columns: Callable[[WindowSpec], dict[str, Column]],
                    before: int = 0, after: int = 0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead within ``key``.

    ``columns`` gets the window (partitioned and ordered) and returns the columns to add. Each stretch of a hot key
    receives copies of the nearest rows of its neighbours, which are dropped again once the window has been computed,
    so the result is the same as with one window per key. ``order`` must be unique within the key.
    """
    cold, hot = cut_hot_keys(df, key, order, group_rows)
    plain = cold.withColumns(columns(W.partitionBy(key).orderBy(order)))
    if hot is None:
        return plain
    copies = []
    for reach, direction in ((before, 1), (after, -1)):
        if reach:
            edge = W.partitionBy(key, "stretch").orderBy(F.col(order).desc() if direction > 0 else F.col(order).asc())
            copies.append(
                hot.withColumn("_rank", F.row_number().over(edge)).filter(F.col("_rank") <= reach).drop("_rank")
                .withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(reach))))
                .withColumn("stretch", F.col("stretch") + F.col("_step") * direction).drop("_step")
                .filter("stretch >= 0"))
    rows = hot.withColumn("_copy", F.lit(False))
    for c in copies:
        rows = rows.unionByName(c.withColumn("_copy", F.lit(True)))
    rows = rows.withColumns(columns(W.partitionBy(key, "stretch").orderBy(order)))
    return plain.unionByName(rows.filter(~F.col("_copy")).drop("_copy", "stretch"))
