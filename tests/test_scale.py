"""Plans under skew: a hot key must be split, and hot groups pre-aggregated."""

import contextlib

import pytest
from pyspark.sql import functions as F

from vinework.functions.text import SIMPLE
from vinework.operators import fulltext, merge
from vinework.operators.pattern import match, paths
from vinework.operators.traverse import _masks, traverse
from vinework.runtime import cut_lineage
from vinework.sources.graph import PropertyGraph

# No broadcast, and partitions of some kilobytes count as skewed.
SKEWED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "100KB",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hub(spark, tmp_path_factory):
    """Edges of which a third start at node 0 and a third end there."""
    path = str(tmp_path_factory.mktemp("hub"))
    third = F.col("id") % 3
    edges = spark.range(60000).select(
        F.col("id"),
        F.when(third == 0, 0).otherwise(F.col("id") % 5000).alias("start_id"),
        F.when(third == 1, 0).otherwise(F.col("id") * 7 % 5000).alias("end_id"),
        F.lit("N").alias("src_label"), F.lit("N").alias("dst_label"),
    )
    edges.repartition(12).write.parquet(f"{path}/edges")
    spark.range(5000).select("id", F.concat(F.lit("n"), "id").alias("name")).repartition(4).write.parquet(f"{path}/nodes")
    return PropertyGraph({"N": spark.read.parquet(f"{path}/nodes")}, {"E": spark.read.parquet(f"{path}/edges")})


def test_traversal_level_splits_a_hub(spark, hub):
    with settings(spark, SKEWED):
        frontier = cut_lineage(hub.nodes("N").select(F.col("id").alias("node_id")), "frontier")
        steps = hub.edge_ends("E").select(F.col("start_id").alias("_near"), F.col("end_id").alias("node_id"))
        assert "skew=true" in final_plan(_masks(steps, frontier, 1))


def test_pattern_splits_a_hub(spark, hub):
    with settings(spark, SKEWED):
        found = match(hub, "a", "N").out("r", "E", "b", "N").returns("a.name", "r")
        assert "skew=true" in final_plan(found)


def test_detach_delete_splits_a_hub(spark, hub):
    with settings(spark, SKEWED):
        _, kept = merge.detach_delete(hub.nodes("N"), hub.edges("E"), hub.nodes("N").filter("id % 2 = 1"))
        assert "skew=true" in final_plan(kept)


def test_hot_term_is_split(spark, tmp_path):
    words = F.concat(F.lit("hot w"), F.col("id") % 1500, F.lit(" v"), F.col("id") % 900)
    corpus = spark.range(30000).select("id", words.alias("content"))
    queries = spark.range(1500).select(F.col("id").alias("qid"), F.concat(F.lit("w"), "id").alias("text"))
    queries = queries.union(spark.createDataFrame([(5000, "hot"), (5001, "hot w1")], "qid bigint, text string"))
    index = cut_lineage(fulltext.postings(corpus, SIMPLE), "index").repartition(8)
    with settings(spark, SKEWED):
        asked = cut_lineage(fulltext.query_terms(queries, SIMPLE), "asked")
        found = fulltext.match(index, asked)
        assert "skew=true" in final_plan(found)
        counts = {r.qid: r["count"] for r in found.filter("qid >= 5000").groupBy("qid").count().collect()}
        assert counts == {5000: 30000, 5001: 20}


def test_edges_of_a_hot_endpoint_are_split(spark):
    ends = spark.range(40000).select(
        F.lit("P").alias("src_label"), F.when(F.col("id") % 3 == 0, "hub").otherwise(F.col("id").cast("string")).alias("src_id"),
        F.lit("P").alias("dst_label"), F.col("id").cast("string").alias("dst_id"), F.lit("E").alias("type"),
        F.create_map(F.lit("n"), F.col("id").cast("string")).alias("props"),
        F.struct(F.col("id").alias("doc"), F.lit(0).cast("bigint").alias("at")).alias("seq"),
    ).repartition(12)
    seen = spark.range(40000).select(F.lit("P").alias("label"), F.col("id").cast("string").alias("id"), F.lit(None).cast("bigint").alias("first_doc"))
    seen = cut_lineage(seen.union(spark.createDataFrame([("P", "hub", None)], "label string, id string, first_doc bigint")), "seen")
    with settings(spark, SKEWED):
        found = merge.with_existing_ends(ends, seen)
        assert "skew=true" in final_plan(found)
        assert found.count() == 40000


def test_small_frontier_leaves_the_edges_in_place(spark, hub):
    frontier = cut_lineage(hub.nodes("N").filter("id < 10").select(F.col("id").alias("node_id")), "frontier")
    steps = hub.edge_ends("E").select(F.col("start_id").alias("_near"), F.col("end_id").alias("node_id"))
    plan = _masks(steps, frontier, 1)._jdf.queryExecution().executedPlan().toString()
    # What is shuffled are far ends, merged in each task before.
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_near" not in plan
    assert plan.count("Exchange hashpartitioning(node_id") == 1 and "partial_bit_or" in plan


def test_a_level_shuffles_one_row_per_node_and_task(spark, hub):
    """However many walks there are, no level shuffles more rows than tasks times nodes."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = traverse(hub, "N", None, "E", 5, return_properties=False)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_bit_or") >= 5 and "Join" in plan
    assert plan.split("Initial Plan")[0].count("keys=[depth") == 0  # no distinct over levels


def test_only_needed_columns_are_read(spark, hub):
    plan = match(hub, "a", "N").out("r", "E", "b", "N").returns("a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "name" not in plan and "Join" not in plan


def test_half_walks_are_written_once(spark, hub):
    small = PropertyGraph(hub.node_frames, {"E": hub.edge_frames["E"].filter("id < 300")})
    whole = paths(small, "E", 4)
    assert "half-walks" in whole._jdf.queryExecution().executedPlan().toString()
    grown = paths(small, "E", 4, small.nodes("N").select("id"))
    assert sorted((r.start_id, r.end_id, *r.edge_ids) for r in whole.collect()) == sorted(
        (r.start_id, r.end_id, *r.edge_ids) for r in grown.collect()
    )


@pytest.mark.parametrize("hops", [2, 3, 6])
def test_walks_of_a_whole_graph_are_made_by_many_tasks(spark, tmp_path, hops):
    """Edges in one small file: no task makes most of the walks, and nothing of the size of the graph is broadcast."""
    n, key = 600, F.col("id")
    spark.range(0, n, 1, 1).write.parquet(f"{tmp_path}/nodes")
    nodes = spark.read.parquet(f"{tmp_path}/nodes")
    ends = F.explode(F.array((key * 7 + 13) % n, (key * 13 + 7) % n)).alias("end_id")
    edges = nodes.select(key.alias("start_id"), ends).select(
        (F.col("start_id") * n + F.col("end_id")).alias("id"), "start_id", "end_id",
        F.lit("N").alias("src_label"), F.lit("N").alias("dst_label"),
    )
    walks = paths(PropertyGraph({"N": nodes}, {"E": edges}), "E", hops)
    assert "BroadcastHashJoin" not in final_plan(walks.groupBy("start_id").agg(F.countDistinct("end_id")))
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        made = [r["count"] for r in walks.groupBy(F.spark_partition_id()).count().collect()]
    assert len(made) >= 4 and max(made) <= sum(made) / 2


def test_results_do_not_depend_on_partitions(spark, hub):
    small = PropertyGraph(hub.node_frames, {"E": hub.edge_frames["E"].filter("id < 300")})
    other = PropertyGraph(hub.node_frames, {"E": small.edge_frames["E"].repartition(17)})
    for hops in (2, 3):
        assert sorted(paths(small, "E", hops).collect()) == sorted(paths(other, "E", hops).collect())
