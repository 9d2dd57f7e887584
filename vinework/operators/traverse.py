"""Depth-bounded traversal by frontier joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vinework.functions.filters import text_equals_all
from vinework.runtime import cut_lineage
from vinework.sources.graph import PropertyGraph


# Levels of one plan; a mask of depths has 63 bits.
LEVELS = 12


def traverse(
    graph: PropertyGraph,
    start_label: str,
    start_filter: Mapping[str, Any] | None,
    edge_type: str,
    max_depth: int,
    *,
    direction: str = "outgoing",
    properties: Sequence[str] | None = None,
    return_properties: bool = True,
    cut_every: int = LEVELS,
) -> DataFrame:
    """Distinct ``(depth, node_id)`` pairs reached from the start nodes.

    There is no visited set: in a cycle a node comes back at several depths.
    Depth 1 is always produced. With ``return_properties`` only nodes of the
    start label are kept, with their properties (all, or the named ones).
    ``both`` merges two one-way traversals into one row per node, where an
    outgoing depth goes before an incoming one. Rows are not sorted.

    One pass carries all depths: a node has a mask in which bit d tells that it
    was reached at depth d. A hop shifts the masks of the near ends by one bit
    and joins, per far end, all that arrive with ``bit_or``, first in each task.
    So a node is one row however many walks reach it, a hop shuffles one row per
    reached node and task, and no level needs a union or a distinct of its own.
    After ``cut_every`` levels the masks are written to the shared folder; the
    job that does it also counts the last frontier, from which the next masks
    start, and the loop stops if it is empty.
    """
    options = dict(properties=properties, return_properties=return_properties, cut_every=cut_every)
    if direction == "both":
        out = traverse(graph, start_label, start_filter, edge_type, max_depth, **options)
        back = traverse(graph, start_label, start_filter, edge_type, max_depth, direction="incoming", **options)
        return first_wins(out, back)
    if not 1 <= cut_every < 63:
        raise ValueError("cut_every must be from 1 to 62")
    near, far = ("end_id", "start_id") if direction == "incoming" else ("start_id", "end_id")
    # Without the filter every hop would add its own, and Spark could not use one exchange for all.
    steps = graph.edge_ends(edge_type).select(F.col(near).alias("_near"), F.col(far).alias("node_id")).dropna()
    starts = graph.nodes(start_label)
    chosen = text_equals_all(start_filter or {})
    starts = starts if chosen is None else starts.filter(chosen)
    frontier = starts.select(F.col("id").alias("node_id"))
    parts: list[DataFrame] = []
    done, depth = 0, max(1, max_depth)
    while done < depth:
        levels = min(cut_every, depth - done)
        masks = _masks(steps, frontier, levels)
        if done + levels < depth:
            last = Observation()
            masks = cut_lineage(masks.observe(last, F.count_if(_at(F.lit(levels))).alias("n")), "masks")
        each = masks.select(F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("_level"), "node_id", "mask").filter(_at(F.col("_level")))
        parts.append(each.select((F.col("_level") + done).alias("depth"), "node_id"))
        done += levels
        if done < depth:
            if not last.get["n"]:
                break
            frontier = masks.filter(_at(F.lit(levels))).select("node_id")
    reached = reduce(DataFrame.unionByName, parts)
    if not return_properties:
        return reached
    return attach_properties(reached, graph, start_label, properties)


def _at(level) -> Column:
    return F.getbit("mask", level) == 1


def _masks(steps: DataFrame, frontier: DataFrame, levels: int) -> DataFrame:
    """``node_id, mask``: bit d is set where d edges lead from the frontier to the node.

    One statement for all levels, so that Spark analyses the plan once and not again for every level.
    """
    parts = ["WITH m0 AS (SELECT node_id, 1L AS mask FROM {frontier})"]
    for level in range(1, levels + 1):
        seeds = " UNION ALL SELECT node_id, 1L FROM {frontier}" if level < levels else ""
        parts.append(
            f"m{level} AS (SELECT node_id, bit_or(mask) AS mask FROM (SELECT s.node_id, shiftleft(m.mask, 1) AS mask "
            f"FROM {{steps}} s JOIN m{level - 1} m ON s._near = m.node_id{seeds}) GROUP BY node_id)"
        )
    return steps.sparkSession.sql(", ".join(parts) + f" SELECT node_id, mask FROM m{levels}", steps=steps, frontier=frontier)


def attach_properties(
    reached: DataFrame, graph: PropertyGraph, label: str, properties: Sequence[str] | None = None
) -> DataFrame:
    """Inner join to one label; nodes of other labels drop out."""
    nodes = graph.node_frames[label].withColumnRenamed("id", "node_id")
    if properties is not None:
        nodes = nodes.select("node_id", *properties)
    return reached.join(nodes, "node_id").select("depth", "node_id", *(c for c in nodes.columns if c != "node_id"))


def first_wins(first: DataFrame, second: DataFrame, key: str = "node_id", order: str = "depth") -> DataFrame:
    """Merge two ranked lists: per key the lowest row of the first list that has it."""
    rest = [c for c in first.columns if c != key]

    def lowest(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*rest)
        return df.groupBy(key).agg(F.min_by(row, F.col(order)).alias(name))

    merged = lowest(first, "_a").join(lowest(second, "_b"), key, "full_outer")
    merged = merged.withColumn("_row", F.coalesce("_a", "_b"))
    return merged.select(*(F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in first.columns))
