"""Approximate nearest neighbours through cells around k-means centres.

The index is an ordinary table: the corpus with a ``cell`` column. Written
with ``partitionBy("cell")``, a search reads only the cells it probes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinework.functions import kernels, vectors
from vinework.functions.vectors import Metric
from vinework.operators import knn as exact
from vinework.runtime import cut_lineage


# Rows per cell that the number of cells aims at, and the most cells there are: 65,536 centres of 64 dimensions are 32 MB.
CELL_ROWS = 1024
MOST_CELLS = 1 << 16
# Rows per centre, and at most, on which centres are fitted.
FIT_ROWS = 64
MOST_FIT_ROWS = 1 << 18
# Cells of a query that an exact search reads before it knows a distance to beat.
FIRST_CELLS = 2


@dataclass(frozen=True)
class CellIndex:
    """Corpus with a ``cell`` column, the cell centres and radii.

    There are at most ``MOST_CELLS`` centres, so they travel with the tasks. A
    radius is the largest distance of a cell's row from its centre, of unit
    vectors for cosine.
    """

    cells: DataFrame
    centres: np.ndarray
    metric: str
    id_col: str = "id"
    vec_col: str = "embedding"
    radii: np.ndarray | None = None

    def search(
        self,
        queries: DataFrame,
        k: int = 4,
        nprobe: int = 4,
        *,
        where: Column | None = None,
        carry: tuple[str, ...] = (),
        digits: int | None = None,
        qid_col: str = "qid",
        query_vec: str = "embedding",
    ) -> DataFrame:
        """k nearest rows among the ``nprobe`` cells nearest to each query."""
        asked = _asked(queries, qid_col, query_vec)
        probes = _nearest_centres(asked, "_qvec", self.centres, min(nprobe, len(self.centres)), self.metric)
        # Written: the grid and the search both read them.
        probes = cut_lineage(probes.select("_qid", "_qvec", F.explode("_cells").alias("_cell")), "probes")
        near = self._within(probes, k, where, carry, digits)
        return exact.ranked(near, k, self.id_col).withColumnRenamed("_qid", qid_col)

    def search_exact(
        self,
        queries: DataFrame,
        k: int = 4,
        *,
        where: Column | None = None,
        carry: tuple[str, ...] = (),
        digits: int | None = None,
        qid_col: str = "qid",
        query_vec: str = "embedding",
    ) -> DataFrame:
        """k nearest rows with a vector, exactly: cells that can't hold any of them are not read.

        The triangle inequality bounds the distance of a query to all rows of a
        cell by that to its centre and the cell's radius. The cells with the
        smallest bounds are read first; the k-th distance found there rules out
        the cells whose bound is larger.
        """
        return self._exact(queries, k, where, carry, digits, qid_col, query_vec)[0]

    def cells_read(self, queries: DataFrame, k: int = 4, *, digits: int | None = None, qid_col: str = "qid", query_vec: str = "embedding") -> DataFrame:
        """``qid, cells, read``: cells there are, and those that an exact search reads."""
        read = self._exact(queries, k, None, (), digits, qid_col, query_vec)[1]
        counts = read.groupBy("_qid").agg(F.count(F.lit(1)).alias("read"))
        return counts.select(F.col("_qid").alias(qid_col), F.lit(len(self.centres)).alias("cells"), "read")

    def _exact(self, queries, k, where, carry, digits, qid_col, query_vec) -> tuple[DataFrame, DataFrame]:
        if self.radii is None:
            raise ValueError("the index was saved without radii")
        asked = cut_lineage(_asked(queries, qid_col, query_vec), "asked")
        first = cut_lineage(self._possible(asked.withColumn("_limit", F.lit(None).cast("double")), True), "first")
        begun = cut_lineage(self._within(first, k, where, carry, digits), "begun")
        worst = exact.ranked(begun, k, self.id_col).filter((F.col("rank") == k) & ~F.isnan("distance")).select("_qid", F.col("distance").alias("_worst"))
        # Rounded distances and those of the bounds, which are sums in another order, may differ by this much.
        slack = (10.0**-digits if digits is not None else 0.0) + 1e-7
        limit = F.col("_worst") + slack * (1 + F.abs("_worst"))
        rest = cut_lineage(self._possible(asked.join(worst, "_qid", "left").select("_qid", "_qvec", limit.alias("_limit")), False), "rest")
        near = begun.unionByName(self._within(rest, k, where, carry, digits))
        read = first.select("_qid", "_cell").unionByName(rest.select("_qid", "_cell"))
        return exact.ranked(near, k, self.id_col).withColumnRenamed("_qid", qid_col), read

    def _possible(self, asked: DataFrame, begin: bool) -> DataFrame:
        """``_qid, _qvec, _cell``: the cells with the smallest bounds, or all others whose bounds don't pass ``_limit``."""
        cells = _bounded_cells(self.centres, self.radii, self.metric, begin)
        return asked.select("_qid", "_qvec", F.explode(cells(F.col("_qvec"), F.col("_limit"))).alias("_cell"))

    def _within(self, probes: DataFrame, k: int, where: Column | None, carry: tuple[str, ...], digits: int | None) -> DataFrame:
        """Candidates of every query in its cells (``_qid, _qvec, _cell``)."""
        rows = self.cells if where is None else self.cells.filter(where)
        columns = list(dict.fromkeys([self.id_col, *carry]))
        rows = rows.withColumn("_cell", F.col("cell")).select("_cell", *dict.fromkeys([*columns, self.vec_col]))
        return exact.blockwise(
            rows, probes, k, self.metric,
            digits=digits, columns=columns, id_col=self.id_col, vec_col=self.vec_col, dim=self.centres.shape[1],
        )

    def save(self, path: str) -> CellIndex:
        """Write the index; the saved one reads only the cells that are probed."""
        path = path.rstrip("/")
        spread = self.cells.hint("rebalance", "cell")
        spread.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
        spark = self.cells.sparkSession
        radii = [None] * len(self.centres) if self.radii is None else self.radii.tolist()
        rows = [(i, centre.tolist(), radius) for i, (centre, radius) in enumerate(zip(self.centres, radii, strict=True))]
        spark.createDataFrame(rows, "cell int, centre array<double>, radius double").write.mode("overwrite").parquet(f"{path}/centres")
        return load_cells(spark, path, self.metric, id_col=self.id_col, vec_col=self.vec_col)


def load_cells(spark: SparkSession, path: str, metric: Metric | str, *, id_col: str = "id", vec_col: str = "embedding") -> CellIndex:
    """Open a saved index."""
    path = path.rstrip("/")
    rows = spark.read.schema("cell int, centre array<double>, radius double").parquet(f"{path}/centres").orderBy("cell").collect()
    centres = np.array([r.centre for r in rows])
    radii = None if any(r.radius is None for r in rows) else np.array([r.radius for r in rows])
    return CellIndex(spark.read.parquet(f"{path}/cells"), centres, Metric(metric).value, id_col, vec_col, radii)


def _asked(queries: DataFrame, qid_col: str, query_vec: str) -> DataFrame:
    known = queries.filter(F.col(query_vec).isNotNull())
    return known.select(F.col(qid_col).alias("_qid"), F.col(query_vec).cast("array<double>").alias("_qvec"))


def build_cells(
    corpus: DataFrame,
    n_lists: int | None = None,
    metric: Metric | str = Metric.COSINE,
    *,
    id_col: str = "id",
    vec_col: str = "embedding",
    iterations: int = 10,
    seed: int = 7,
    train_on: DataFrame | None = None,
) -> CellIndex:
    """Fit ``n_lists`` centres and put every row with a vector into a cell.

    Without ``n_lists`` there is a cell for every ``CELL_ROWS`` rows, at most
    ``MOST_CELLS``. The metric steers the cells: unit vectors for cosine, raw
    ones otherwise. Centres are fitted on ``train_on``, or on about ``FIT_ROWS``
    rows per centre, ``MOST_FIT_ROWS`` at most, chosen by a hash of the id; all
    rows of the corpus are assigned in any case. Rows without a vector are in
    no cell.
    """
    metric = Metric(metric).value
    known = corpus.filter(F.col(vec_col).isNotNull())
    n = known.count()
    n_lists = n_lists or max(1, min(MOST_CELLS, -(-n // CELL_ROWS)))
    source = known if train_on is None else train_on.filter(F.col(vec_col).isNotNull())
    wanted = min(MOST_FIT_ROWS, max(FIT_ROWS * n_lists, 1 << 14))
    if train_on is None and n > wanted:
        source = source.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(wanted / n * (1 << 30)))
    features = source.select(array_to_vector(_shape(F.col(vec_col), metric)).alias("features"))
    model = KMeans(k=n_lists, maxIter=iterations, seed=seed).fit(features)
    centres = np.array(model.clusterCenters())
    placed = _nearest_centres(known, vec_col, centres, 1, metric)
    cells = cut_lineage(placed.withColumn("cell", F.col("_cells")[0]).drop("_cells"), "cells")
    return CellIndex(cells, centres, metric, id_col, vec_col, _radii(cells, vec_col, centres, metric))


def _shape(vector: Column, metric: str) -> Column:
    """What cells are made of: unit vectors for cosine."""
    shape = vectors.doubles(vector)
    if metric == "cosine":
        length = vectors.norm(vector)
        shape = F.transform(shape, lambda x: x / F.when(length == 0.0, 1.0).otherwise(length))
    return shape


def _radii(cells: DataFrame, vec_col: str, centres: np.ndarray, metric: str) -> np.ndarray:
    """Largest distance of a cell's rows from its centre, one number per cell; 0 for an empty cell."""

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(centres))
        for batch in batches:
            rows, _ = kernels.matrix(batch.column(1), centres.shape[1])
            if metric == "cosine":
                rows = np.nan_to_num(kernels.unit(rows))
            cell = np.asarray(batch.column(0))
            np.maximum.at(found, cell, np.linalg.norm(rows - centres[cell], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["cell", "radius"])

    parts = cells.select("cell", vec_col).mapInArrow(largest, "cell int, radius double")
    rows = parts.groupBy("cell").agg(F.max("radius").alias("radius")).collect()
    out = np.zeros(len(centres))
    for r in rows:
        out[r["cell"]] = r["radius"]
    return out


def _bounded_cells(centres: np.ndarray, radii: np.ndarray, metric: str, begin: bool):
    """Cells by the least distance that a row in them can have: the first ones, or the others up to a limit (null: all)."""
    far = radii * (1 + 1e-12)

    @F.arrow_udf("array<int>")
    def cells(column: pa.Array, limit: pa.Array) -> pa.Array:
        queries, _ = kernels.matrix(column, centres.shape[1])
        if metric == "ip":
            low = -(queries @ centres.T) - np.linalg.norm(queries, axis=1)[:, None] * far
        else:
            queries = np.nan_to_num(kernels.unit(queries)) if metric == "cosine" else queries
            low = np.maximum(kernels.rough_distances(queries, centres, "l2") - far, 0.0)
            low = low * low / 2 if metric == "cosine" else low
        order = np.argsort(low, axis=1, kind="stable")
        if begin:
            kept = np.arange(len(centres)) < np.full(len(queries), FIRST_CELLS)[:, None]
        else:
            most = np.asarray(limit.fill_null(np.inf))[:, None]
            kept = (np.take_along_axis(low, order, axis=1) <= most) & (np.arange(len(centres)) >= FIRST_CELLS)
        offsets = np.append(0, np.cumsum(kept.sum(axis=1))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(order[kept].astype(np.int32)))

    return cells


def _nearest_centres(df: DataFrame, vec_col: str, centres: np.ndarray, n: int, metric: str) -> DataFrame:
    """Add ``_cells``: the n centres nearest to each vector, nearest first."""

    # Only the vectors go through Python, not the row's other columns.
    @F.arrow_udf("array<int>")
    def assign(column: pa.Array) -> pa.Array:
        rows, _ = kernels.matrix(column, centres.shape[1])
        dist = np.nan_to_num(kernels.rough_distances(rows, centres, metric), nan=np.inf)
        picks = np.argsort(dist, axis=1, kind="stable")[:, :n].astype(np.int32)
        offsets = np.arange(0, picks.size + 1, n, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(picks.ravel()))

    return df.withColumn("_cells", assign(F.col(vec_col)))


def recall(approximate: DataFrame, truth: DataFrame, qid_col: str = "qid", id_col: str = "id") -> DataFrame:
    """Share of the exact neighbours that were found, per query."""
    found = approximate.select(qid_col, id_col).withColumn("_hit", F.lit(1))
    return (
        truth.select(qid_col, id_col)
        .join(found, [qid_col, id_col], "left")
        .groupBy(qid_col)
        .agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
    )
