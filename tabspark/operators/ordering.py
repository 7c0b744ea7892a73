"""Running totals in a global sort order without pulling a whole group into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.lineage import checkpoint

# Rows one window task may hold; above this the sort is range-partitioned.
ROWS_PER_WINDOW = 1_000_000


def running_totals(df: DataFrame, group: str, order: list[str], weight: Column, rows: int | None = None,
                   rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """Adds ``before``: the sum of ``weight`` over rows sorted earlier in the same group.

    Give rows that are unique per (group, order), e.g. distinct values with their counts. Up to a
    million rows this is a plain window. Beyond that the rows are range-partitioned by (group, order),
    checkpointed so that the partition number is a stored fact (a retried task cannot change it), and
    totals of earlier partitions of the group are added to a window inside each partition.
    """
    rows = df.count() if rows is None else rows
    weighted = df.withColumn("_w", weight)
    if rows <= rows_per_window:
        w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return weighted.withColumn("before", F.coalesce(F.sum("_w").over(w), F.lit(0))).drop("_w")
    parts = math.ceil(rows / rows_per_window)
    placed = checkpoint(weighted.repartitionByRange(parts, group, *order).withColumn("_p", F.spark_partition_id()))
    wide = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(group, "_p").agg(F.sum("_w").alias("_t"))
               .withColumn("_off", F.coalesce(F.sum("_t").over(wide), F.lit(0))).drop("_t"))
    # At most one row per partition and group border: bounded by `parts` plus the number of groups.
    inner = Window.partitionBy(group, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(F.broadcast(offsets), [group, "_p"])
            .withColumn("before", F.col("_off") + F.coalesce(F.sum("_w").over(inner), F.lit(0)))
            .drop("_w", "_p", "_off"))


def average_ranks(counts: DataFrame, rows: int | None = None, rows_per_window: int = ROWS_PER_WINDOW) -> DataFrame:
    """Adds ``rank``, the 1-based average rank of a value within its feature, to (feature, value, n) rows."""
    ranked = running_totals(counts, "feature", ["value"], F.col("n"), rows, rows_per_window)
    return ranked.withColumn("rank", F.col("before") + (F.col("n") + 1) / 2.0).drop("before")
