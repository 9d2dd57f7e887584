"""Approximate distinct counts and quantiles from sketches that are stored per batch and merged.

A sketch has a bounded size per group, is built with partial results per task,
and merging the sketches of batches gives the sketch of all their rows. So a
statistic over years of batches reads one small row per batch and group, and a
new batch adds its rows without reading the old ones. The exact plans are
``count(distinct)`` and :func:`vinework.operators.profile.latency_profile`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12  # logarithm of the number of registers of a distinct sketch
K = 200  # size of a quantile sketch


def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error of a distinct count that three of a thousand counts exceed, at three standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def rank_error(k: int = K) -> float:
    """Error of the rank of a quantile that one of a hundred quantiles exceeds, by the formula published with the sketch."""
    return 2.296 / k**0.9723


def distinct_sketches(rows: DataFrame, groups: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """``*groups, sketch``: distinct values per group; null values do not count."""
    known = rows.filter(F.col(value).isNotNull())
    return known.groupBy(*groups).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def distinct_counts(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``*groups, estimate`` over all sketches of a group; groups without values are absent."""
    merged = sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("_s"))
    return merged.select(*groups, F.hll_sketch_estimate("_s").alias("estimate"))


def quantile_sketches(rows: DataFrame, groups: Sequence[str], value: str, k: int = K) -> DataFrame:
    """``*groups, sketch``: order statistics per group; nulls and NaN do not count."""
    number = F.col(value).cast("double")
    known = rows.filter(number.isNotNull() & ~F.isnan(number))
    return known.groupBy(*groups).agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, groups: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """``*groups, n, rank, estimate``: a row per asked rank (0 to 1) over all sketches of a group."""
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    asked = F.array(*(F.lit(float(r)) for r in ranks))
    found = F.arrays_zip(asked.alias("rank"), F.kll_sketch_get_quantile_double("_s", asked).alias("estimate"))
    each = merged.select(*groups, F.kll_sketch_get_n_double("_s").alias("n"), F.explode(found).alias("_q"))
    return each.select(*groups, "n", F.col("_q.rank").alias("rank"), F.col("_q.estimate").alias("estimate"))


class SketchTable:
    """Sketches on disk, one folder per batch; writing a batch again replaces it."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        """``schema`` names the group columns and their types."""
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = f"{schema}, sketch binary, batch string"

    def put(self, batch: str, sketches: DataFrame) -> None:
        sketches.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        """All batches; a filter on ``batch`` reads only its folders."""
        return self.spark.read.schema(self.schema).parquet(self.path)
