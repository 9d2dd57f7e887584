"""Vectors in Arrow batches as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lengths(column: pa.Array) -> np.ndarray:
    """Number of components of every row, -1 for null."""
    return np.asarray(pc.fill_null(pc.list_value_length(column), -1)).astype(np.int64)


def usable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with exactly ``width`` components, none null or non-finite, and these components as doubles."""
    sizes = lengths(column)
    values = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), np.nan))
    ends = np.cumsum(np.maximum(sizes, 0))
    rows = np.flatnonzero(sizes == width)
    matrix = values[(ends[rows] - width)[:, None] + np.arange(width)]
    fine = np.isfinite(matrix).all(axis=1)
    return rows[fine], matrix[fine]


def floors(matrix: np.ndarray, scale: float, limit: int) -> np.ndarray:
    """floor(scale * x) as integers; components whose results pass ``limit`` raise."""
    with np.errstate(over="ignore"):
        found = np.floor(scale * matrix)
    if found.size and np.abs(found).max() > limit:
        raise ValueError(f"a component times {scale:g} is larger than {limit}: the results don't fit 64 bits")
    return found.astype(np.int64)


def without(batch: pa.RecordBatch, name: str, rows: np.ndarray) -> tuple[list[pa.Array], list[str]]:
    """The chosen rows of all columns but ``name``."""
    names = [n for n in batch.schema.names if n != name]
    return [batch.column(batch.schema.names.index(n)).take(pa.array(rows)) for n in names], names
