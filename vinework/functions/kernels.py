"""Array kernels that run inside Arrow batches on the executors."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Ship these helpers with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Query/row pairs held in memory at once by one task, and rows that are made a matrix at once.
PAIRS = 1 << 20
ROWS = 8_192
# Pairs whose distance is recomputed at once.
EXACT_PAIRS = 65_536


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a list column as ``(rows x dim, row numbers)``; nulls left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    present = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False))
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(present) and not np.all(lengths[present] == dim):
        raise ValueError(f"all vectors must have {dim} dimensions")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(present), dim), present


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; a zero vector becomes NaN."""
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    with np.errstate(invalid="ignore", divide="ignore"):
        return vectors / lengths[:, None]


def rough_distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """All distances of a block by one matrix product."""
    return rough_distances_to(rows, metric)(queries)


def rough_distances_to(rows: np.ndarray, metric: str):
    """The same for several blocks of queries: what the rows need is made once."""
    if metric == "cosine":
        turned = unit(rows).T
        return lambda queries: 1.0 - unit(queries) @ turned
    if metric == "ip":
        return lambda queries: -(queries @ rows.T)
    own = np.einsum("ij,ij->i", rows, rows)[None, :]

    def l2(queries: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", queries, queries)[:, None] + own
        return np.sqrt(np.maximum(squares - 2.0 * (queries @ rows.T), 0.0))

    return l2


def exact_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance of ``a[i]`` and ``b[i]`` without cancellation."""
    if metric == "l2":
        return np.sqrt(np.einsum("ij,ij->i", a - b, a - b))
    inner = np.einsum("ij,ij->i", a, b)
    if metric == "ip":
        return -inner
    lengths = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1.0 - inner / lengths


def first_k(group: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Entries of ``order`` that are among the first k of their group.

    ``order`` must list whole groups one after another.
    """
    if not len(order):
        return order
    sorted_group = group[order]
    starts = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]])
    counts = np.diff(np.r_[starts, len(order)])
    position = np.arange(len(order)) - np.repeat(starts, counts)
    return order[position < k]


def block_nearest(queries, rows, tie, metric, k, digits, bound):
    """Nearest rows of one block: ``(query index, row index, distance)``.

    ``tie`` orders rows of equal distance. ``bound`` holds a distance per query
    beyond which a row cannot be among the k nearest. Undefined distances
    (NaN) come after all others.
    """
    slack = (0.0 if digits is None else 10.0**-digits) + 1e-7
    found = []
    step = max(1, PAIRS // max(1, len(rows)))
    distances = rough_distances_to(rows, metric)
    for start in range(0, len(queries), step):
        part = queries[start : start + step]
        rough = distances(part)
        np.copyto(rough, np.inf, where=np.isnan(rough))
        limit = bound[start : start + step]
        # Once k rows are known for every query, their bounds are limit enough.
        if len(rows) > k and not np.isfinite(limit).all():
            limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1])
        margin = slack * (1.0 + np.abs(np.where(np.isfinite(limit), limit, 0.0)))
        q, r = np.nonzero(rough <= (limit + margin)[:, None])
        dist = np.empty(len(q))
        for lo in range(0, len(q), EXACT_PAIRS):
            hi = lo + EXACT_PAIRS
            dist[lo:hi] = exact_distances(part[q[lo:hi]], rows[r[lo:hi]], metric)
        if digits is not None:
            dist = np.round(dist, digits) + 0.0
        undefined = np.isnan(dist)
        order = np.lexsort((tie[r], np.where(undefined, 0.0, dist), undefined, q))
        kept = first_k(q, order, k)
        found.append((q[kept] + start, r[kept], dist[kept]))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0)
    return tuple(np.concatenate(parts) for parts in zip(*found))


class NearestRows:
    """Running k nearest rows per query over the batches of one task."""

    def __init__(self, qids, queries, metric, k, digits, columns):
        self.qids, self.queries = qids, queries
        self.metric, self.k, self.digits = metric, k, digits
        self.columns = columns
        self.bound = np.full(len(queries), np.inf)
        self.best = None

    def add(self, rows: pa.Table | pa.RecordBatch, id_col: str, vec_col: str) -> None:
        """Take in rows; ``id_col`` breaks ties."""
        if isinstance(rows, pa.RecordBatch):
            rows = pa.Table.from_batches([rows])
        if not len(self.queries):
            return
        for at in range(0, rows.num_rows, ROWS):
            self._add(rows.slice(at, ROWS), id_col, vec_col)

    def _add(self, rows: pa.Table, id_col: str, vec_col: str) -> None:
        vectors, present = matrix(rows.column(vec_col), self.queries.shape[1])
        order = pc.sort_indices(rows, sort_keys=[(id_col, "ascending")]).to_numpy()
        tie = np.empty(len(order), dtype=np.int64)
        tie[order] = np.arange(len(order))
        q, r, dist = block_nearest(self.queries, vectors, tie[present], self.metric, self.k, self.digits, self.bound)
        missing = np.setdiff1d(order, present)
        missing = missing[np.argsort(tie[missing])][: self.k]
        everyone = np.arange(len(self.queries))
        q = np.concatenate([q, np.repeat(everyone, len(missing))]).astype(np.int64)
        r = np.concatenate([present[r], np.tile(missing, len(everyone))]).astype(np.int64)
        null = np.r_[np.zeros(len(dist), dtype=bool), np.ones(len(q) - len(dist), dtype=bool)]
        dist = np.concatenate([dist, np.zeros(len(q) - len(dist))])
        taken = rows.select(self.columns).take(pa.array(r))
        undefined = np.isnan(dist)
        fresh = taken.append_column("_q", pa.array(q))
        fresh = fresh.append_column("_class", pa.array((undefined + 2 * null).astype(np.int8)))
        fresh = fresh.append_column("_d", pa.array(np.where(undefined, 0.0, dist)))
        if self.best is not None:
            fresh = pa.concat_tables([self.best, fresh])
        keys = [(c, "ascending") for c in ("_q", "_class", "_d", id_col)]
        order = pc.sort_indices(fresh, sort_keys=keys).to_numpy()
        group = fresh.column("_q").to_numpy()
        self.best = fresh.take(pa.array(first_k(group, order, self.k))).combine_chunks()
        self._tighten()

    def _tighten(self) -> None:
        group = self.best.column("_q").to_numpy()
        usable = self.best.column("_class").to_numpy() == 0
        counts = np.bincount(group[usable], minlength=len(self.queries))
        worst = np.full(len(self.queries), -np.inf)
        np.maximum.at(worst, group[usable], self.best.column("_d").to_numpy()[usable])
        self.bound = np.where(counts >= self.k, worst, np.inf)

    def result(self, qid_name: str) -> pa.Table | None:
        """Kept rows with query id and distance: NaN undefined, null missing."""
        if self.best is None:
            return None
        kind = self.best.column("_class").to_numpy()
        dist = np.where(kind == 1, np.nan, self.best.column("_d").to_numpy())
        distance = pa.array(dist, mask=kind == 2, from_pandas=False)
        out = self.best.select(self.columns)
        out = out.add_column(0, qid_name, self.qids.take(self.best.column("_q")))
        return out.append_column("distance", distance)


def diverse_picks(query: np.ndarray, candidates: np.ndarray, k: int, weight: float) -> list[int]:
    """Greedy choice by relevance to the query minus likeness to earlier picks.

    Maximal marginal relevance (Carbonell & Goldstein, 1998) with cosine
    similarity; a zero vector has similarity 0 to everything.
    """
    everything = np.nan_to_num(unit(np.vstack([query[None, :], candidates])))
    to_query = everything[1:] @ everything[0]
    rows = everything[1:]
    picks: list[int] = []
    nearest_pick = np.full(len(rows), -np.inf)
    free = np.ones(len(rows), dtype=bool)
    while len(picks) < min(k, len(rows)):
        score = to_query if not picks else weight * to_query - (1.0 - weight) * nearest_pick
        # Round so that equal scores stay equal whatever the summation order.
        best = int(np.argmax(np.where(free, np.round(score, 12), -np.inf)))
        picks.append(best)
        free[best] = False
        nearest_pick = np.maximum(nearest_pick, rows @ rows[best])
    return picks
