import pytest
from pyspark.sql import functions as F

from vinework.operators import sketches


def test_merged_batches_equal_one_batch(spark, tmp_path):
    rows = spark.range(20000).select((F.col("id") % 3).alias("g"), (F.col("id") * F.col("id") % 7001).alias("v"), (F.col("id") % 7).alias("b"))
    store = sketches.SketchTable(spark, str(tmp_path), "g bigint")
    for b in range(7):
        store.put(str(b), sketches.distinct_sketches(rows.filter(F.col("b") == b), ["g"], "v"))
    store.put("3", sketches.distinct_sketches(rows.filter("b = 3"), ["g"], "v"))  # written again, not counted twice
    found = {r.g: r.estimate for r in sketches.distinct_counts(store.read(), ["g"]).collect()}
    whole = {r.g: r.estimate for r in sketches.distinct_counts(sketches.distinct_sketches(rows, ["g"], "v"), ["g"]).collect()}
    exact = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    assert found == pytest.approx(whole, rel=0.02)
    assert all(abs(found[g] - n) <= n * sketches.distinct_error() for g, n in exact.items())
    assert "PartitionFilters: [isnotnull(batch" in store.read().filter("batch = '1'")._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_exact_and_nulls_do_not_count(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", None), ("b", None), ("c", float("nan")), ("c", 5.0)], "g string, v double")
    text = rows.filter("g <> 'c'").withColumn("v", F.col("v").cast("string"))
    counts = sketches.distinct_counts(sketches.distinct_sketches(text, ["g"], "v"), ["g"])
    assert {r.g: r.estimate for r in counts.collect()} == {"a": 2}
    found = sketches.quantiles(sketches.quantile_sketches(rows, ["g"], "v"), ["g"], [0.0, 1.0])
    assert {(r.g, r["rank"], r.n, r.estimate) for r in found.collect()} == {("a", 0.0, 3, 1.0), ("a", 1.0, 3, 2.0), ("c", 0.0, 1, 5.0), ("c", 1.0, 1, 5.0)}


def test_no_rows(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert sketches.quantiles(sketches.quantile_sketches(none, ["g"], "v"), ["g"], [0.5]).count() == 0
