"""Distinct ends of walks of exactly k edges without a repeated edge, with bounded state per node.

Whether a walk can go on depends on the edges it has used, so a node alone is
not enough state, and all walks to a node are too many: through a hub there are
in-degree times out-degree. But the rest of a walk has at most q = k - t edges.
Of all edge sets of the walks that reach a node with t edges, a representative
family is kept: whatever q edges follow, if they avoid one of the sets, they
avoid one that is kept. It has at most 1 + t + t^2 + ... + t^q sets, whatever
the degree of the node (40 for t = q = 3).

Families are reduced in each task first and then per node, in a stream over
sorted rows, so a hub's incoming walks never gather in memory.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage
from vinework.sources.graph import PropertyGraph

# Ship these helpers with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def largest_family(used: int, left: int) -> int:
    """Most edge sets of ``used`` edges that are kept where ``left`` edges follow."""
    return sum(used**i for i in range(left + 1))


def representatives(sets: np.ndarray, left: int) -> np.ndarray:
    """Rows of ``sets`` (one edge set each) that represent all of them for any ``left`` further edges.

    One set is kept. Further edges that meet it hold one of its edges e, and
    avoid a set without e if they avoid any: these sets are represented for one
    edge less.
    """
    kept: set[int] = set()

    def choose(rows: np.ndarray, more: int) -> None:
        if not len(rows):
            return
        kept.add(int(rows[0]))
        if more:
            for edge in sets[rows[0]]:
                choose(rows[(sets[rows] != edge).all(axis=1)], more - 1)

    choose(np.arange(len(sets)), left)
    return np.array(sorted(kept), np.int64)


def distinct_ends(graph: PropertyGraph, edge_type: str, hops: int, starts: DataFrame | None = None, *, per_start: bool = False) -> DataFrame:
    """``end_id`` of every walk of exactly ``hops`` edges without a repeated edge.

    ``starts`` is a frame with ``id``; without it walks start anywhere. With
    ``per_start`` the result is ``start_id, end_id``, and families are kept per
    pair of start and node.
    """
    if hops < 1:
        raise ValueError("hops must be at least 1")
    edges = graph.edge_ends(edge_type).select(F.col("start_id").alias("_from"), F.col("end_id").alias("_to"), F.col("id").alias("_edge")).dropna()
    start = [F.col("_from").alias("start_id")] if per_start else []
    key = ["start_id", "end_id"] if per_start else ["end_id"]
    first = edges if starts is None else edges.join(starts.select(F.col("id").alias("_from")), "_from", "left_semi")
    walks = first.select(*start, F.col("_to").alias("end_id"), F.array("_edge").alias("edge_ids"))
    for used in range(1, hops):
        families = cut_lineage(_reduced(walks, key, used, hops - used), "families")
        grown = families.join(edges, F.col("end_id") == F.col("_from")).filter(~F.array_contains("edge_ids", F.col("_edge")))
        walks = grown.select(*key[:-1], F.col("_to").alias("end_id"), F.array_append("edge_ids", F.col("_edge")).alias("edge_ids"))
    return walks.select(*key).distinct()


def _reduced(walks: DataFrame, key: list[str], used: int, left: int) -> DataFrame:
    most = largest_family(used, left)
    within = walks.mapInArrow(_in_batches(key, used, left, most), walks.schema)
    placed = within.repartition(*key).sortWithinPartitions(*key)
    return placed.mapInArrow(_in_order(key, used, left, most), walks.schema)


def _numbers(batch: pa.RecordBatch, key: list[str], used: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of every row and its edges, as numbers within the batch."""
    codes = np.zeros(batch.num_rows, np.int64)
    for name in key:
        found = batch.column(name).dictionary_encode()
        codes = codes * len(found.dictionary) + np.asarray(found.indices)
    edges = batch.column("edge_ids").flatten().dictionary_encode()
    return codes, np.asarray(edges.indices).reshape(batch.num_rows, used)


def _chosen(codes: np.ndarray, sets: np.ndarray, left: int, most: int) -> np.ndarray:
    """Rows that stay; families within the bound stay whole."""
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    sizes = np.diff(np.append(starts, len(codes)))
    large = sizes > most
    kept = [order[np.repeat(~large, sizes)]]
    for at, n in zip(starts[large].tolist(), sizes[large].tolist(), strict=True):
        rows = order[at : at + n]
        kept.append(rows[representatives(sets[rows], left)])
    return np.sort(np.concatenate(kept))


def _in_batches(key: list[str], used: int, left: int, most: int):
    """Every Arrow batch by itself."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sets = _numbers(batch, key, used)
            yield batch.take(pa.array(_chosen(codes, sets, left, most)))

    return reduce


def _in_order(key: list[str], used: int, left: int, most: int):
    """A stream of rows sorted by key: the last family of a batch may go on in the next."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            codes, sets = _numbers(whole, key, used)
            last = int(np.flatnonzero(codes != codes[-1])[-1]) + 1 if (codes != codes[-1]).any() else 0
            rows = _chosen(codes, sets, left, most)
            yield whole.take(pa.array(rows[rows < last]))
            held = whole.take(pa.array(rows[rows >= last]))
        if held is not None:
            yield held

    return reduce
