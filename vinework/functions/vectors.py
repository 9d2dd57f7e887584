"""Distances, relevance scores and float32 vectors as native columns."""

from __future__ import annotations

from collections.abc import Callable
from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hook that turns a distance column into a relevance column.
ScoreFn = Callable[[Column], Column]


class Metric(str, Enum):
    """Lower is closer for all three; the inner product is negated."""

    COSINE = "cosine"
    L2 = "l2"
    INNER_PRODUCT = "ip"


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def float32(vector: Column, dim: int | None = None) -> Column:
    """Round a vector to 32-bit floats, failing on a wrong dimension."""
    rounded = vector.cast("array<float>")
    if dim is None:
        return rounded
    complaint = F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, got "), F.size(vector).cast("string")))
    return F.when(vector.isNull() | (F.size(vector) == dim), rounded).otherwise(complaint)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(metric: Metric | str, a: Column, b: Column) -> Column:
    """Distance of two vectors in double precision.

    Cosine is NaN when a vector has length zero; a null vector gives null.
    """
    metric = Metric(metric)
    if metric is Metric.INNER_PRODUCT:
        return -dot(a, b)
    if metric is Metric.L2:
        squares = F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    lengths = norm(a) * norm(b)
    return F.when(lengths == 0.0, F.lit(float("nan"))).otherwise(1.0 - dot(a, b) / F.nullif(lengths, F.lit(0.0)))


def relevance(metric: Metric | str, dist: Column, custom: ScoreFn | None = None) -> Column:
    """Relevance of a distance; a custom function replaces the metric's own."""
    if custom is not None:
        return custom(dist)
    metric = Metric(metric)
    if metric is Metric.COSINE:
        return 1.0 - dist
    if metric is Metric.L2:
        return 1.0 / (1.0 + dist)
    return -dist
