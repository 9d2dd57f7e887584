"""Keyed Parquet tables whose upserts rewrite only the touched buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.runtime import cut_lineage, delete_folder, folder_exists


class BucketedTable:
    """Parquet folder partitioned by a hash bucket of its key.

    Writes use dynamic partition overwrite: new files of the touched buckets
    replace the old ones when the job commits, so a failed job changes
    nothing. Each bucket keeps one marker row with a null key; without it a
    bucket whose last row was deleted would not be overwritten. A large bucket is
    written by several tasks; choose the number of buckets so that an upsert
    rewrites little that it does not change.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 256) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.columns = self.schema.fieldNames()
        self.stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])

    def exists(self) -> bool:
        return folder_exists(self.spark, self.path)

    def create(self, replace: bool = False) -> BucketedTable:
        """Create the table unless it exists; ``replace`` empties it first."""
        if replace or not self.exists():
            markers = self._markers(self.spark.range(self.buckets).select(F.col("id").cast("int").alias("bucket")))
            markers.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.path)
        return self

    def drop(self) -> None:
        delete_folder(self.spark, self.path)

    def read(self) -> DataFrame:
        return self._stored().filter(F.col(self.keys[0]).isNotNull()).select(*self.columns)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(self.buckets).cast("bigint"))
        return df.withColumn("bucket", bucket.cast("int"))

    def matching(self, keys: DataFrame) -> DataFrame:
        """Stored rows whose key occurs in ``keys``; reads only their buckets."""
        wanted = cut_lineage(self.with_bucket(keys.select(*self.keys)), "keys")
        old = self._stored().filter(F.col("bucket").isin(self._numbers(wanted)))
        return old.join(wanted, ["bucket", *self.keys], "left_semi").select(*self.columns)

    @staticmethod
    def _numbers(rows: DataFrame) -> list[int]:
        # At most one small number per bucket comes to the driver.
        return [r.bucket for r in rows.select("bucket").distinct().collect()]

    def put(self, rows: DataFrame) -> None:
        """Insert rows, replacing rows with the same key. Keys are unique in ``rows``."""
        fresh = cut_lineage(self.with_bucket(rows.select(*self.columns)), "put")
        self._rewrite(fresh, fresh)

    def remove(self, keys: DataFrame) -> None:
        """Delete the rows whose key occurs in ``keys``; unknown keys are fine."""
        gone = cut_lineage(self.with_bucket(keys.select(*self.keys).distinct()), "remove")
        self._rewrite(gone, None)

    def _rewrite(self, touched: DataFrame, fresh: DataFrame | None) -> None:
        numbers = self._numbers(touched)
        if not numbers:
            return
        old = self._stored().filter(F.col("bucket").isin(numbers)).filter(F.col(self.keys[0]).isNotNull())
        kept = old.join(touched.select("bucket", *self.keys), ["bucket", *self.keys], "left_anti")
        kept = kept.select(*self.columns, "bucket")
        if fresh is not None:
            kept = kept.unionByName(fresh.select(*self.columns, "bucket"))
        markers = self._markers(touched.select("bucket").distinct())
        (
            kept.unionByName(markers).hint("rebalance", "bucket")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket").parquet(self.path)
        )

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(self.path)

    def _markers(self, numbers: DataFrame) -> DataFrame:
        blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return numbers.select(*blanks, "bucket")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key. Spark keeps one row per key and task before it shuffles."""
    by_recency = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return rows.withColumn("_n", F.row_number().over(by_recency)).filter(F.col("_n") == 1).drop("_n")
