"""Times the headline queries on one machine and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores.
Every query runs cold, then ``BENCH_RUNS`` times warm; the reported time is the
median of the warm runs. Results are written to Spark's noop sink.
``stored_search`` times building a stored text index, a search in it and ranking
every match. ``deep_walks`` and ``dense_walks`` compare deep traversal with path enumeration,
the one ratio that is published.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from vinework.functions.filters import text_equals_all
from vinework.functions.text import SIMPLE
from vinework.operators import fulltext
from vinework.operators.pattern import paths
from vinework.operators.traverse import traverse
from vinework.plans.all_queries import QUERIES
from vinework.plans.inputs import benchmark_texts, link_graph, scratch_path, table
from vinework.runtime import local_session
from vinework.sources.graph import PropertyGraph
from vinework.sources.textindex import TextIndex

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# The workloads of the published benchmark script first, then the retrieval ones.
HEADLINE = (
    "point_lookup",
    "one_hop_count",
    "khop3_distinct",
    "khop6_distinct",
    "node_count",
    "append_nodes",
    "node_overlay",
    "edge_merge",
    "schema_node_props",
    "schema_triples",
    "traverse_out",
    "traverse_both",
    "knn_cosine",
    "knn_filtered",
    "mmr",
    "text_match",
    "bm25_rank",
    "proximity_rank",
    "hybrid_rrf",
    "graph_rag_expand",
    "collection_upsert",
    "latency_profile",
)


def timed(name: str, spark) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_search(spark) -> dict[str, float]:
    """Ten best documents of every benchmark passage: from a stored index, and by ranking every match anew."""
    documents = table(spark, SF_DIR, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    queries = benchmark_texts(spark, SF_DIR)
    index = TextIndex(spark, scratch_path(spark, "bench-text"), SIMPLE, id_type="bigint", buckets=16).create()
    times = {}

    def measure(name: str, run) -> None:
        begin = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - begin, 3)

    measure("build", lambda: index.add(documents))
    index.search(queries, 10).count()
    measure("search", lambda: index.search(queries, 10).count())
    asked = fulltext.query_terms(queries, SIMPLE)
    measure("rank_every_match", lambda: fulltext.top_texts(fulltext.rank_bm25(fulltext.query_postings(documents, asked, SIMPLE), asked), 10).count())
    return times


def dense_graph(spark) -> PropertyGraph:
    """Customers with eight links each."""
    customer = table(spark, SF_DIR, "customer")
    n, key = customer.count(), F.col("c_custkey")
    ends = F.posexplode(F.array(*[(key * (7 + 2 * i) + 13 * i + 1) % n for i in range(8)])).alias("at", "end_id")
    links = customer.select(key.alias("start_id"), ends).select(
        (F.col("start_id") * 8 + F.col("at")).alias("id"), "start_id", "end_id",
        F.lit("Customer").alias("src_label"), F.lit("Customer").alias("dst_label"),
    )
    return PropertyGraph({"Customer": customer.withColumn("id", key)}, {"LINKS": links})


def deep_walks(graph: PropertyGraph, start: dict, depth: int) -> dict[str, float]:
    """Nodes within reach: the frontier traversal against enumerating all paths, each after a first run."""
    starts = graph.nodes("Customer").filter(text_equals_all(start))

    def by_frontier() -> None:
        traverse(graph, "Customer", start, "LINKS", depth, return_properties=False).select("node_id").distinct().count()

    def by_path() -> None:
        paths(graph, "LINKS", depth, starts).select("end_id").distinct().count()

    times = []
    for run in (by_frontier, by_path):
        run()
        begin = time.perf_counter()
        run()
        times.append(time.perf_counter() - begin)
    return {"depth": depth, "traverse": round(times[0], 3), "paths": round(times[1], 3), "times_faster": round(times[1] / times[0], 2)}


def main() -> None:
    spark = local_session(CPUS, "vinework-bench", **{"spark.sql.shuffle.partitions": CPUS})
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(name, spark), 3)
        warm[name] = round(statistics.median(timed(name, spark) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total warm time of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "stored_search": stored_search(spark),
                "deep_walks": [deep_walks(link_graph(spark, SF_DIR), {"c_mktsegment": "BUILDING"}, depth) for depth in (4, 6, 12)],
                "dense_walks": [deep_walks(dense_graph(spark), {"c_mktsegment": "BUILDING", "c_nationkey": 7}, depth) for depth in (4, 6)],
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
