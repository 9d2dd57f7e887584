"""Retrieval that expands search hits through the graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage
from vinework.sources.graph import PropertyGraph

# Hook on the expanded context.
ContextFn = Callable[[DataFrame], DataFrame]


def expand(
    hits: DataFrame,
    graph: PropertyGraph,
    *,
    node_col: str = "node_id",
    edge_type: str | None = None,
    direction: str = "both",
    entities: bool = False,
    context: ContextFn | None = None,
) -> DataFrame:
    """Neighbours of every hit: hit columns plus ``rel_type, direction, neighbour_id, neighbour_label``.

    ``entities`` adds ``neighbour``, the neighbour's id, label and properties;
    it is null where the graph has an edge to a node it does not hold.

    ``direction`` is ``out``, ``in`` or ``both``, where a self-loop counts once.
    Hits are written first: their size is then known, so Spark broadcasts them
    to the edge scan when they are few and shuffles otherwise. ``context`` may
    post-process the result, for instance to join properties.
    """
    hits = cut_lineage(hits, "hits")
    ends = graph.edge_ends(edge_type)
    parts = []
    if direction in ("out", "both"):
        parts.append(
            ends.select(
                F.col("start_id").alias(node_col), F.col("type").alias("rel_type"), F.lit("out").alias("direction"),
                F.col("end_id").alias("neighbour_id"), F.col("dst_label").alias("neighbour_label"),
            )
        )
    if direction in ("in", "both"):
        back = ends.filter(F.col("start_id") != F.col("end_id")) if direction == "both" else ends
        parts.append(
            back.select(
                F.col("end_id").alias(node_col), F.col("type").alias("rel_type"), F.lit("in").alias("direction"),
                F.col("start_id").alias("neighbour_id"), F.col("src_label").alias("neighbour_label"),
            )
        )
    if not parts:
        raise ValueError("direction must be 'out', 'in' or 'both'")
    neighbours = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    expanded = hits.join(neighbours, node_col)
    if entities:
        # Written, so that a node which many hits share can be split when its entity is joined.
        nodes = graph.entities().withColumnsRenamed({"id": "_neighbour", "entity": "neighbour"})
        expanded = cut_lineage(expanded.withColumn("_neighbour", F.col("neighbour_id").cast("string")), "expanded")
        expanded = expanded.join(nodes, "_neighbour", "left").drop("_neighbour")
    return expanded if context is None else context(expanded)


def question_context(results: DataFrame, top_k: int = 10, *, question_col: str = "question", order_col: str = "seq") -> DataFrame:
    """First ``top_k`` result rows of each question as one list of JSON texts.

    Rows beyond ``top_k`` are dropped before the shuffle, so a group holds at
    most ``top_k`` rows.
    """
    order = Window.partitionBy(question_col).orderBy(order_col)
    rest = [c for c in results.columns if c not in (question_col, order_col)]
    first = results.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top_k)
    row = F.struct("_n", F.to_json(F.struct(*rest)).alias("_row"))
    gathered = first.groupBy(question_col).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return gathered.select(question_col, F.transform("_rows", lambda r: r["_row"]).alias("context"))
