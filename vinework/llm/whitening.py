"""Whitening of integer vectors by the singular values of the centred rows.

Sums per dimension are exact integers, so rows are centred exactly. Every task
reduces its centred rows block by block to one triangular factor (QR of the
factor so far and the next block); factors are reduced in groups, in Spark,
until one is left, which has features times features numbers. On the driver it
is made bidiagonal, the dqds transform gives its singular values and twisted
factorisations its right vectors (``bidiagonal.py``): the whitening directions.
The covariance is never formed, so its condition isn't squared.

A last pass over the whitened rows sums their products, which tells how far
their covariance is from the identity.

Defined results: rows whose vector is null, empty, or holds null or non-finite
components are dropped; so are rows whose vector has not the number of
components that most rows have (of equally common ones, the larger). Repeated
rows count each. A component without variance (beyond rounding) has no unit
variance to scale to: its values are null and it takes no part in the identity
error; where no component has variance that error and all shares are null. No
rows give no rows. Extra columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework import runtime
from vinework.llm import bidiagonal, dense

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
LARGEST = 1 << 40  # of an integer component
TOGETHER = 16  # factors that one task reduces to one
_LIMB = 28


class Fit:
    """Number of rows, exact sums, and the directions of the components."""

    def __init__(self, width: int, n: int, sums: list[int]):
        self.width, self.n = width, n
        whole = [divmod(s, n) for s in sums]
        self.means = np.array([q for q, _ in whole], np.int64)
        self.rests = np.array([r for _, r in whole], np.int64)
        self.values = self.vectors = np.zeros(0)
        self.identity_error: float | None = None

    def rows(self, batch: pa.RecordBatch, vector_col: str, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Usable rows of a batch and their integers less the whole part of the means."""
        rows, matrix = dense.usable(batch.column(batch.schema.names.index(vector_col)), self.width)
        return rows, dense.floors(matrix, scale, LARGEST) + shift - self.means

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.rests / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exactly."""
        largest = int(np.abs(x).max(initial=0)) * self.n + self.n
        if largest * largest * self.width < 1 << 63:
            off = self.n * x - self.rests
            return (off * off).sum(axis=1).tolist()
        if largest >= 1 << 2 * _LIMB:
            return [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rests.tolist(), strict=True)) for row in x.tolist()]
        total = [0] * len(x)
        for at in range(0, self.width, 64):  # squares of two limbs, summed over 64 dimensions, stay below 2**63
            off = np.abs(self.n * x[:, at : at + 64] - self.rests[at : at + 64])
            high, low = off >> _LIMB, off & ((1 << _LIMB) - 1)
            sums = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
            parts = zip(total, *(s.tolist() for s in sums), strict=True)
            total = [t + (hh << 2 * _LIMB) + (hl << _LIMB + 1) + ll for t, hh, hl, ll in parts]
        return total

    def known(self) -> np.ndarray:
        """Which components have a variance beyond rounding."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values[: len(self.vectors)] > top * (self.width * bidiagonal.EPS) ** 2 if top > 0 else np.zeros(len(self.vectors), bool)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Values of all components with variance, one column each."""
        known = self.known()
        return self.centred(x) @ (self.vectors[known] / np.sqrt(self.values[: len(self.vectors)][known])[:, None]).T


def _totals(vectors: DataFrame, vector_col: str, scale: int, shift: int) -> Fit | None:
    """Number of components of most rows, their number and exact sums; None without rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column(0)
            for width in np.unique(dense.lengths(column)).tolist():
                if width > 0:
                    _, matrix = dense.usable(column, width)
                    x = dense.floors(matrix, scale, LARGEST) + shift
                    mine = np.append(len(x), x.sum(axis=0)).astype(object)  # one batch fits 64 bits, a task may not
                    sums[width] = sums.get(width, 0) + mine
        for width, total in sorted(sums.items()):
            place = pa.array(np.arange(-1, width, dtype=np.int32))
            values = pa.array([str(v) for v in total])
            yield pa.RecordBatch.from_arrays([pa.array([width] * (width + 1), pa.int32()), place, values], ["width", "place", "value"])

    parts = vectors.select(vector_col).mapInArrow(add, "width int, place int, value string")
    total = parts.groupBy("width", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = runtime.cut_lineage(total, "sums")
    most = total.filter("place = -1 AND value > 0").orderBy(F.desc("value"), F.desc("width")).first()
    if most is None:
        return None
    sums = {r["place"]: int(r["value"]) for r in total.filter(F.col("width") == most["width"]).collect()}
    return Fit(most["width"], sums[-1], [sums[i] for i in range(most["width"])])


def _factor(vectors: DataFrame, vector_col: str, fit: Fit, scale: int, shift: int) -> np.ndarray:
    """Triangular factor of all centred rows."""
    width = fit.width

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            _, x = fit.rows(batch, vector_col, scale, shift)
            factor = np.linalg.qr(np.concatenate([factor, fit.centred(x)]), mode="r")
        yield _row(TaskContext.get().partitionId(), factor)

    def join(key: tuple, parts: pa.Table) -> pa.Table:
        blocks = [np.frombuffer(b, float).reshape(-1, width) for _, b in sorted(zip(*parts.to_pydict().values(), strict=True))]
        factor = blocks[0]
        for block in blocks[1:]:
            factor = np.linalg.qr(np.concatenate([factor, block]), mode="r")
        return pa.Table.from_batches([_row(key[0].as_py(), factor)])

    def _row(part: int, factor: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(factor).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["part", "factor"])

    schema = "part bigint, factor binary"
    factors = runtime.cut_lineage(vectors.select(vector_col).mapInArrow(reduce, schema), "factors")
    while factors.count() > 1:
        group = F.floor(F.col("part") / TOGETHER)
        factors = runtime.cut_lineage(factors.groupBy(group).applyInArrow(join, schema), "factors")
    factor = np.frombuffer(factors.first()["factor"], float).reshape(-1, width)
    return np.concatenate([factor, np.zeros((width - len(factor), width))]) if len(factor) < width else factor


def _identity_error(vectors: DataFrame, vector_col: str, fit: Fit, scale: int, shift: int) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    size = int(fit.known().sum())
    if not size:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            values = fit.whitened(fit.rows(batch, vector_col, scale, shift)[1])
            total[:, :size] += values.T @ values
            total[:, size] += values.sum(axis=0)
        place = [np.repeat(np.arange(size), size + 1), np.tile(np.arange(size + 1), size)]
        arrays = [pa.array(p.astype(np.int32)) for p in place] + [pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "value"])

    parts = vectors.select(vector_col).mapInArrow(products, "i int, j int, value double")
    sums = np.zeros((size, size + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        sums[r["i"], r["j"]] = r["value"] / fit.n
    # Rows are centred by their exact means before they are multiplied; what rounding left of the mean goes too.
    return float(np.abs(sums[:, :size] - np.outer(sums[:, size], sums[:, size]) - np.eye(size)).max())


def learn(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Fit | None:
    """Directions that whiten all usable rows; None without rows."""
    typed = vectors.select(F.col(vector_col).cast("array<double>").alias(vector_col))
    fit = _totals(typed, vector_col, scale, shift)
    if fit is not None:
        squares, fit.vectors = bidiagonal.right_vectors(_factor(typed, vector_col, fit, scale, shift), components)
        fit.values = squares / fit.n
        fit.identity_error = _identity_error(typed, vector_col, fit, scale, shift)
    return fit


EXTRA = "_wh_component int, _wh_n bigint, _wh_deviation decimal(38,0), _wh_value double, _wh_explained double, _wh_identity_error double"


def whiten(vectors: DataFrame, fit: Fit | None, vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable row and component: its columns but the vector, ``_wh_component`` (from 1), ``_wh_n``,
    ``_wh_deviation`` (exact sum of (n * x - S)^2), ``_wh_value``, ``_wh_explained`` and ``_wh_identity_error``."""
    typed = vectors.withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    schema = T.StructType([*(f for f in typed.schema.fields if f.name != vector_col), *T.StructType.fromDDL(EXTRA).fields])
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, known, trace = len(fit.vectors), fit.known(), float(fit.values.sum())
    shares = [float(v / trace) if trace > 0 else None for v in fit.values[:size]]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = fit.rows(batch, vector_col, scale, shift)
            values = np.full((len(rows), size), np.nan)
            values[:, known] = fit.whitened(x)
            off = pa.array([Decimal(d) for d in fit.deviations(x)], pa.decimal128(38, 0))
            arrays, names = dense.without(batch, vector_col, np.repeat(rows, size))
            arrays += [
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(rows) * size, fit.n)),
                off.take(pa.array(np.repeat(np.arange(len(rows)), size))),
                pa.array(values.ravel(), mask=np.tile(~known, len(rows))),
                pa.array(shares * len(rows), pa.float64()),
                pa.array([fit.identity_error] * (len(rows) * size), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *(f.name for f in schema.fields[len(names) :])])

    return typed.mapInArrow(add, schema)
