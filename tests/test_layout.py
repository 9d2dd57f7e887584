import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vinework.sources.layout import cluster_by_properties, cluster_by_property


def files_read(path, ranges):
    """Files whose statistics can't rule out a row with all properties in their ranges."""
    n = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        stats = {meta.row_group(0).column(i).path_in_schema: [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)] for i in range(meta.num_columns)}
        n += all(any(s.min <= high and s.max >= low for s in stats[prop]) for prop, (low, high) in ranges.items())
    return n


def test_two_properties_read_fewer_files_than_one_order(spark, tmp_path):
    nodes = spark.range(20000).select("id", (F.col("id") * 7919 % 1000).alias("a"), F.sin("id").alias("b"), F.concat(F.lit("n"), F.col("id") % 50).alias("s"))
    cluster_by_property(nodes, "a", str(tmp_path / "one"), files=64)
    cluster_by_properties(nodes, ["a", "b"], str(tmp_path / "both"), files=64)
    box = {"a": (100, 250), "b": (0.2, 0.3)}
    one, both = files_read(tmp_path / "one", box), files_read(tmp_path / "both", box)
    assert both <= one / 2
    # The second property alone, which a single order can't help with at all.
    assert files_read(tmp_path / "one", {"b": (0.2, 0.3)}) == 64 and files_read(tmp_path / "both", {"b": (0.2, 0.3)}) <= 20
    assert spark.read.parquet(str(tmp_path / "both")).count() == 20000


def test_strings_nulls_and_equal_values(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else f"{'abc'[i % 3]}{i}", float(i % 2), None) for i in range(300)]
    nodes = spark.createDataFrame(rows, "id bigint, s string, v double, d date")
    cluster_by_properties(nodes, ["s", "v", "d"], str(tmp_path / "z"), files=4, bits=5)
    stored = spark.read.parquet(str(tmp_path / "z"))
    assert sorted(map(tuple, stored.collect())) == sorted(rows) and stored.columns == nodes.columns
    with pytest.raises(ValueError, match="62 bits"):
        cluster_by_properties(nodes, ["s"] * 9, str(tmp_path / "no"))
    cluster_by_properties(nodes.limit(0), ["v"], str(tmp_path / "empty"))
