"""Clustering around integer centroids with an incremental distance matrix.

The exact integer inner products of every vector with all centroids are kept
with the vector in a table of the shared folder. When a centroid moves, only
the components in which it changed are multiplied, and the products are added
to what is kept; |c|^2 - 2 x.c then gives the nearest centroid without touching
the others. All numbers are integers, so a result does not depend on how rows
are dealt to tasks.

A round is one pass that writes the next table and one that sums the vectors of
each cluster in its tasks. What reaches the driver or travels to tasks is the
centroids: ``k`` times ``width`` numbers. The table of the round before is
deleted when the next is complete, so a lost executor repeats parts of a round
and the disk holds two tables at most.

Defined results: vectors that are null, have another number of components, or
hold null or non-finite components are dropped; repeated rows count each; rows
without an id are clustered, and become first centroids only after all rows
with one; equal hashes are ordered by their vectors; with fewer vectors than
``k`` there are as many centroids as vectors; no vectors give no rows. Extra
columns are untouched. Components so large that squared distances don't fit 64
bits raise an error.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework import runtime
from vinework.llm import dense

CLUSTERS = 40
ROUNDS = 5
WIDTH = 64
SCALE = 256
SEED = "2"
LONGS = T.ArrayType(T.LongType())


def _limit(width: int) -> int:
    """Largest component with which squared distances and inner products fit 62 bits."""
    return math.isqrt((1 << 60) // width)


def integers(vectors: DataFrame, vector_col: str, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """The kept rows with ``_ce_x``, their vectors as floor(scale * x), in place of the vector."""
    limit = _limit(width)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = dense.usable(batch.column(batch.schema.names.index(vector_col)), width)
            arrays, names = dense.without(batch, vector_col, rows)
            yield pa.RecordBatch.from_arrays([*arrays, _lists(dense.floors(matrix, scale, limit))], [*names, "_ce_x"])

    typed = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    others = [f for f in typed.schema.fields if f.name != vector_col]
    return typed.mapInArrow(convert, T.StructType(others).add("_ce_x", LONGS))


def _lists(matrix: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def first_centroids(rows: DataFrame, id_col: str, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id, in the order of the hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = rows.select(mark.alias("mark"), "_ce_x").orderBy(F.asc_nulls_last("mark"), "_ce_x").limit(k)
    return np.array([r["_ce_x"] for r in first.collect()], np.int64)


def _add_products(dots: np.ndarray, x: np.ndarray, changes: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
    """Adds the products of ``x`` with each centroid's changed components."""
    largest = int(np.abs(x).max(initial=0)) * max((int(np.abs(by).max()) for _, _, by in changes), default=0) * x.shape[1]
    kind = np.float64 if largest < 1 << 53 else np.int64  # sums below 2**53 are exact in doubles
    typed = x.astype(kind)
    for centroid, where, by in changes:
        part = typed if len(where) == x.shape[1] else typed[:, where]
        dots[:, centroid] += (part @ by.astype(kind)).astype(np.int64)


def assign(state: DataFrame, old: np.ndarray | None, new: np.ndarray, keep: bool = True) -> DataFrame:
    """Nearest of the centroids ``new`` per row; ``_ce_dots`` holds the products with ``old`` (None: no products yet).

    ``keep`` also returns vectors and products, for the next round.
    """
    k, width = new.shape
    change = new - (np.zeros_like(new) if old is None else old)
    changes = [(j, np.flatnonzero(row), row[row != 0]) for j, row in enumerate(change) if row.any()]
    squares = (new * new).sum(axis=1)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            x = _matrix(columns.pop("_ce_x"), width)
            dots = np.zeros((len(x), k), np.int64) if old is None else _matrix(columns.pop("_ce_dots"), k).copy()
            columns.pop("_ce_cluster", None)
            _add_products(dots, x, changes)
            scores = squares - 2 * dots
            cluster = scores.argmin(axis=1)  # the first of equal scores
            distance = scores[np.arange(len(x)), cluster] + (x * x).sum(axis=1)
            columns |= {"_ce_x": _lists(x), "_ce_dots": _lists(dots)} if keep else {"_ce_distance": pa.array(distance)}
            columns["_ce_cluster"] = pa.array(cluster.astype(np.int32))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = T.StructType([f for f in state.schema.fields if f.name not in ("_ce_x", "_ce_dots", "_ce_cluster")])
    schema = schema.add("_ce_x", LONGS).add("_ce_dots", LONGS) if keep else schema.add("_ce_distance", T.LongType())
    return state.mapInArrow(update, schema.add("_ce_cluster", T.IntegerType()))


def moved(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of every cluster; empty clusters stay."""
    k, width = old.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), np.int64)  # a task's rows times the largest component stay below 2**63
        for batch in batches:
            cluster, x = np.asarray(batch.column(0)), _matrix(batch.column(1), width)
            order = np.argsort(cluster, kind="stable")
            starts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            if len(starts):
                total[cluster[order][starts], :width] += np.add.reduceat(x[order], starts, axis=0)
                total[:, width] += np.bincount(cluster, minlength=k)
        some = np.repeat(total[:, width] > 0, width + 1)
        place = [np.repeat(np.arange(k), width + 1)[some], np.tile(np.arange(width + 1), k)[some]]
        arrays = [pa.array(p.astype(np.int32)) for p in place] + [pa.array(total.ravel()[some])]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "place", "value"])

    parts = state.select("_ce_cluster", "_ce_x").mapInArrow(sums, "cluster int, place int, value bigint")
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found = {(r["cluster"], r["place"]): int(r["value"]) for r in rows}
    new = old.copy()
    for j in {j for j, _ in found}:
        new[j] = [found[j, i] // found[j, width] for i in range(width)]
    return new


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: str = SEED,
) -> DataFrame:
    """One row per kept vector: its columns but the vector, ``_ce_cluster``, ``_ce_distance`` (squared),
    ``_ce_cluster_inertia``, ``_ce_inertia`` and ``_ce_centroid`` (components of the final centroid).

    ``rounds`` times vectors are assigned and centroids moved; then vectors are assigned once more.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, vector_col, width, scale)
    centroids, old = first_centroids(rows, id_col, k, seed), None
    if not len(centroids):
        extra = "_ce_cluster int, _ce_distance bigint, _ce_cluster_inertia bigint, _ce_inertia bigint, _ce_centroid array<bigint>"
        others = [f for f in rows.schema.fields if f.name != "_ce_x"]
        return spark.createDataFrame([], T.StructType([*others, *T.StructType.fromDDL(extra).fields]))
    folder = f"{runtime.shared_dir(spark)}/vinework/{spark.sparkContext.applicationId}/centroids-{uuid.uuid4().hex}"
    state = rows
    for at in range(rounds):
        state = _written(assign(state, old, centroids), f"{folder}/{at}")
        if at:
            runtime.delete_folder(spark, f"{folder}/{at - 1}")
        old, centroids = centroids, moved(state, centroids)
    found = runtime.cut_lineage(assign(state, old, centroids, keep=False), "assigned")
    runtime.delete_folder(spark, folder)
    per = {r[0]: int(r[1]) for r in found.groupBy("_ce_cluster").agg(F.sum(F.col("_ce_distance").cast("decimal(38,0)"))).collect()}
    facts = [(j, per[j], sum(per.values()), centroids[j].tolist()) for j in sorted(per)]
    facts = spark.createDataFrame(facts, "_ce_cluster int, _ce_cluster_inertia bigint, _ce_inertia bigint, _ce_centroid array<bigint>")
    # k rows, whatever the data.
    joined = found.join(F.broadcast(facts), "_ce_cluster")
    others = [c for c in found.columns if c not in ("_ce_cluster", "_ce_distance")]
    return joined.select(*others, "_ce_cluster", "_ce_distance", "_ce_cluster_inertia", "_ce_inertia", "_ce_centroid")


def _written(table: DataFrame, path: str) -> DataFrame:
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def digest(centroid: str = "_ce_centroid"):
    """Hex sha256 of a centroid's components, as decimal integers joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(centroid).cast("array<string>")), 256)
