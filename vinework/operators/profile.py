"""Exact order statistics of a measure, for any number and size of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage


def latency_profile(events: DataFrame, value: str, *groups: str) -> DataFrame:
    """``n, p50, p99, mean, min, max`` of a measure, per group if groups are given.

    p50 is the median; p99 is the value at position int(0.99 n) of the sorted
    values, which is the maximum for up to 100 values. A group may be larger
    than a task: equal values are counted first, the counts are ranged by group
    and value over all tasks, and positions follow from per-task totals.
    """
    keys = list(groups) or ["_all"]
    rows = events if groups else events.withColumn("_all", F.lit(0))
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
    counts = counts.agg(F.count(F.lit(1)).alias("_n"))
    # The task number must not change between reads, so the ranged rows are written.
    ranged = counts.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id())
    ranged = cut_lineage(ranged, "ranged")
    totals = ranged.groupBy(*keys).agg(
        (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    per_part = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_in_part"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.select(
        *keys, "_part",
        F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_in_part").over(Window.partitionBy(*keys)).alias("n"),
    )
    inside = Window.partitionBy(*keys, "_part").orderBy("_v")
    placed = ranged.withColumn("_inside", F.sum("_n").over(inside)).join(per_part, [*keys, "_part"])
    placed = placed.withColumn("_upto", F.col("_before") + F.col("_inside"))
    n = F.col("n")
    ranks = placed.groupBy(*keys).agg(
        F.first("n").alias("n"),
        _value_at(F.floor((n - 1) / 2)).alias("_low"),
        _value_at(F.ceil((n - 1) / 2)).alias("_high"),
        _value_at(F.least(F.floor(n * 0.99), n - 1)).alias("p99"),
    )
    out = totals.join(ranks, keys)
    return out.select(*groups, "n", ((F.col("_low") + F.col("_high")) / 2).alias("p50"), "p99", "mean", "min", "max")


def _value_at(position: Column) -> Column:
    """Value at a 0-based position: the first whose running count exceeds it."""
    return F.min(F.when(F.col("_upto") > position, F.col("_v")))
