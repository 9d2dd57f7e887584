"""Approximate nearest neighbours by cosine, with balanced posting lists.

Vectors are assigned to clusters; a vector near a border is copied to several
clusters, where the next centroid must be almost as near as the nearest and not
lie in the direction of one already chosen. Centroids are searched in memory by
walking a graph of neighbours. A query reads the lists of the nearest
centroids, and the ratio of distances prunes lists that are clearly farther.

Centroids are fitted on a sample of at most ``SAMPLE`` vectors and
``SAMPLE_BYTES`` (chosen by a hash of the id) by repeatedly halving the largest
cluster, so lists hold about the same number of sampled
vectors; there are at most ``MOST_CENTROIDS``, which bounds what travels to the
tasks. All vectors are indexed. Lists longer than ``LIST_PART`` are read in
parts, each by a task of its own.

Equal vectors are one entry with their k + 1 smallest ids, which is all that
can appear among k neighbours, and equal queries are one query; so a vector
that a third of all rows share costs one entry.

Defined results: vectors that are null, empty, zero or have null or non-finite
components take no part, as query or neighbour; rows without an id take no
part; repeated ids count once (with their smallest vector); vectors of different lengths never meet; ties go
to the smaller id; with fewer candidates than k all found are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage

SAMPLE = 1 << 16
SAMPLE_BYTES = 1 << 26
PER_LIST = 64  # sampled vectors per centroid
MOST_CENTROIDS = 1 << 14
NEIGHBOURS = 24  # of a centroid in the graph
ENTRIES = 16  # where a walk starts
BEAM = 96  # centroids a walk keeps
COPIES = 4
NEAR_BORDER = 1.25  # a copy's squared distance to its centroid, relative to the nearest
LISTS = 96  # read by a query at most
FARTHEST = 2.0  # squared distance of a list's centroid, relative to the nearest
LIST_PART = 1 << 14
SEED = 7


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` of the rows that take part; vectors in double precision."""
    vector = F.col(vector_col).cast("array<double>")
    plain = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    some = F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.when(plain & some, vector).alias("vector")).dropna()
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def _rows(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Divided by the largest component first, so that squares don't overflow or vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Centroids:
    """Unit centroids and the graph in which they are searched."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float32)
        n = len(points)
        self.graph = np.empty((n, min(NEIGHBOURS, n)), np.int32)
        for at in range(0, n, 1024):
            near = -(self.points[at : at + 1024] @ self.points.T)
            self.graph[at : at + 1024] = np.argpartition(near, self.graph.shape[1] - 1, axis=1)[:, : self.graph.shape[1]]
        rng = np.random.default_rng(SEED)
        # Long links, so that a walk leaves the neighbourhood of its start.
        self.graph = np.concatenate([self.graph, rng.integers(0, n, (n, 8), np.int32)], axis=1)
        self.entries = rng.permutation(n)[: min(n, ENTRIES * 8)].astype(np.int32)

    def search(self, units: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest centroids found for each vector, nearest first, and their squared distances."""
        n, rows = len(self.points), len(units)
        k, beam = min(k, n), min(max(BEAM, k), n)
        near = units @ self.points[self.entries].T
        width = min(ENTRIES, len(self.entries))
        first = np.argpartition(-near, width - 1, axis=1)[:, :width]
        seen = np.zeros((rows, n), bool)
        opened = np.zeros((rows, n), bool)
        held = self.entries[first]
        values = np.take_along_axis(near, first, axis=1)
        np.put_along_axis(seen, held, True, axis=1)
        active = np.arange(rows)
        while len(active):
            # Open the nearest held centroids that are not open yet.
            closed = ~opened[active[:, None], held[active]]
            ranked = np.where(closed & np.isfinite(values[active]), values[active], -np.inf)
            pick = np.argpartition(-ranked, min(7, ranked.shape[1] - 1), axis=1)[:, :8]
            good = np.isfinite(np.take_along_axis(ranked, pick, axis=1))
            going = good.any(axis=1)
            active, pick, good = active[going], pick[going], good[going]
            if not len(active):
                break
            chosen = np.take_along_axis(held[active], pick, axis=1)
            r, c = np.nonzero(good)
            opened[active[r], chosen[r, c]] = True
            reach = np.where(good[:, :, None], self.graph[chosen], chosen[:, :1, None]).reshape(len(active), -1)
            new = ~seen[active[:, None], reach]
            seen[active[:, None], reach] = True
            score = np.einsum("ijk,ik->ij", self.points[reach], units[active])
            score[~new] = -np.inf
            # The same centroid may be reached twice in one step; keep one.
            order = np.argsort(reach, axis=1, kind="stable")
            twice = np.zeros_like(new)
            sorted_reach = np.take_along_axis(reach, order, axis=1)
            np.put_along_axis(twice, order[:, 1:], sorted_reach[:, 1:] == sorted_reach[:, :-1], axis=1)
            score[twice] = -np.inf
            all_held = np.concatenate([held[active], reach], axis=1)
            all_values = np.concatenate([values[active], score], axis=1)
            keep = np.argpartition(-all_values, min(beam, all_values.shape[1]) - 1, axis=1)[:, :beam]
            new_held, new_values = np.take_along_axis(all_held, keep, axis=1), np.take_along_axis(all_values, keep, axis=1)
            if held.shape[1] < new_held.shape[1]:
                grown = np.zeros((rows, new_held.shape[1]), held.dtype), np.full((rows, new_held.shape[1]), -np.inf, values.dtype)
                grown[0][:, : held.shape[1]], grown[1][:, : held.shape[1]] = held, values
                held, values = grown
            held[active, : new_held.shape[1]], values[active, : new_held.shape[1]] = new_held, new_values
        order = np.argsort(-values, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(held, order, axis=1), np.maximum(2 - 2 * np.take_along_axis(values, order, axis=1), 0)


def fit(sample: np.ndarray) -> Centroids:
    """Balanced centroids: the largest cluster is halved until clusters are small.

    A cluster is cut at the median of the direction between two far members,
    and each half is drawn to its mean, so both halves are of one size.
    """
    wanted = min(MOST_CENTROIDS, max(1, -(-len(sample) // PER_LIST)))
    clusters, rng = [np.arange(len(sample))], np.random.default_rng(SEED)
    done = []
    while clusters and len(clusters) + len(done) < wanted:
        clusters.sort(key=len)
        cluster = clusters.pop()
        if len(cluster) < 2:
            done.append(cluster)
            continue
        points = sample[cluster]
        a = points[rng.integers(len(points))]
        for _ in range(4):
            b = points[np.argmin(points @ a)]
            side = points @ (a - b)
            upper = side >= np.median(side)
            if upper.all() or not upper.any():
                upper = np.arange(len(points)) % 2 == 0
            a, b = points[upper].mean(axis=0), points[~upper].mean(axis=0)
        order = np.argsort(points @ (a - b), kind="stable")
        half = len(order) // 2
        clusters += [cluster[order[:half]], cluster[order[half:]]]
    means = np.stack([sample[c].mean(axis=0) for c in [*clusters, *done]])
    norms = np.linalg.norm(means, axis=1, keepdims=True)
    return Centroids(np.where(norms > 1e-9, means / np.maximum(norms, 1e-9), sample[: len(means)]))


def _assign(centroids: Centroids):
    """The clusters of every vector: the nearest, and others almost as near in other directions."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                units = _unit(_rows(batch.column("vector")))
                found, far = centroids.search(units.astype(np.float32), COPIES * 2)
                take = far <= far[:, :1] * NEAR_BORDER + 1e-6
                for i in range(1, found.shape[1]):
                    for j in range(i):
                        between = 2 - 2 * np.einsum("ij,ij->i", centroids.points[found[:, i]], centroids.points[found[:, j]])
                        take[:, i] &= ~take[:, j] | (between > far[:, i])
                    take[:, i] &= take[:, :i].sum(axis=1) < COPIES
                rows, places = np.nonzero(take)
                out = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(found[rows, places], pa.int32())], [*out.schema.names, "list"])

    return assign


def _probe(centroids: Centroids):
    """The lists that every query reads."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found, far = centroids.search(_unit(_rows(batch.column("vector"))).astype(np.float32), LISTS)
                rows, places = np.nonzero(far <= far[:, :1] * FARTHEST + 1e-6)
                out = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(found[rows, places], pa.int32())], [*out.schema.names, "list"])

    return probe


def cosines(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Cosines of one vector with many, each computed from its own two vectors alone."""
    query, points = query / np.abs(query).max(), points / np.abs(points).max(axis=1, keepdims=True)
    products = (points * query).sum(axis=1)
    return products / (np.sqrt((query * query).sum()) * np.sqrt((points * points).sum(axis=1)))


def _nearest(k: int):
    """Of one part of a list: the best entries for every query, by exact cosine."""

    def nearest(asked, entries):
        out = {"query": [], "entry": [], "score": []}
        if asked.num_rows and entries.num_rows:
            points, names = _rows(entries.column("vector")), np.asarray(entries.column("entry"))
            units, queries = _unit(points), _rows(asked.column("vector"))
            numbers = np.asarray(asked.column("query"))
            for at in range(0, len(queries), 256):
                rough = _unit(queries[at : at + 256]) @ units.T
                width = min(rough.shape[1], 2 * k + 8)
                best = np.argpartition(-rough, width - 1, axis=1)[:, :width]
                for i, some in enumerate(best):
                    exact = cosines(queries[at + i], points[some])
                    order = np.lexsort((names[some], -exact))[:k]
                    out["query"].append(np.full(len(order), numbers[at + i]))
                    out["entry"].append(names[some[order]])
                    out["score"].append(exact[order])
        join = lambda name, kind: pa.array(np.concatenate(out[name]) if out[name] else np.zeros(0), kind)
        return pa.table({"query": join("query", pa.int64()), "entry": join("entry", pa.int64()), "score": join("score", pa.float64())})

    return nearest


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score``: up to ``k`` nearest rows of ``vectors`` for each row of ``queries``, without the row of the same id."""
    rows = cut_lineage(usable(vectors, id_col, vector_col), "vectors")
    entries = _smallest_ids(rows, k + 1)
    entries = cut_lineage(entries.withColumn("entry", F.element_at("ids", 1)), "entries")
    asking = cut_lineage(usable(queries, id_col, vector_col), "asking")
    asked = cut_lineage(asking.groupBy("vector").agg(F.min("id").alias("query")), "asked")
    asking = cut_lineage(asking.join(asked, "vector").select("query", F.col("id").alias("query_id")), "askers")
    found = None
    for length in sorted(r[0] for r in entries.select(F.size("vector")).distinct().collect()):
        mine = F.size("vector") == length
        part = _search_length(entries.filter(mine), asked.filter(mine), length, k)
        found = part if found is None else found.unionByName(part)
    empty = asked.sparkSession.createDataFrame([], "query bigint, entry bigint, score double")
    found = cut_lineage(empty if found is None else found, "found")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = found.dropDuplicates(["query", "entry"]).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    named = found.join(entries.select("entry", "ids"), "entry").select("query", F.explode("ids").alias("id"), "score")
    # A query keeps k + 1 ids at most here, so that many queries of one vector stay small.
    named = named.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))
    named = cut_lineage(named.filter(F.col("place") <= k + 1).drop("place"), "named")
    pairs = asking.join(named, "query").filter(F.col("query_id") != F.col("id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return pairs.select("query_id", "rank", "id", "score")


def _smallest_ids(rows: DataFrame, n: int) -> DataFrame:
    """``vector, ids``: distinct vectors with their ``n`` smallest ids."""
    local = Window.partitionBy("vector", "salt").orderBy("id")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    kept = salted.withColumn("place", F.row_number().over(local)).filter(F.col("place") <= n)
    lists = kept.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return lists.withColumn("ids", F.slice("ids", 1, n))


def _search_length(entries: DataFrame, asked: DataFrame, length: int, k: int) -> DataFrame:
    # A hash below a threshold leaves little more than the sample; only that is ordered.
    size, wanted, whole = entries.count(), min(SAMPLE, max(1, SAMPLE_BYTES // (8 * length))), 1 << 30
    mark = F.pmod(F.xxhash64("entry"), F.lit(whole))
    chosen = entries.filter(mark < int(min(1.0, 1.2 * wanted / max(size, 1)) * whole)).orderBy(mark, "entry").limit(wanted)
    sample = chosen.select("vector").toArrow()
    centroids = fit(_unit(_rows(sample.column("vector"))))
    listed = entries.select("entry", "vector").mapInArrow(_assign(centroids), "entry bigint, vector array<double>, list int")
    listed = cut_lineage(listed, "listed")
    sizes = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_PART).cast("int").alias("parts"))
    sizes = cut_lineage(sizes, "list-sizes")
    probes = asked.select("query", "vector").mapInArrow(_probe(centroids), "query bigint, vector array<double>, list int")
    probes = probes.join(sizes, "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    listed = listed.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int"))
    probes, listed = probes.select("list", "part", "query", "vector"), listed.select("list", "part", "entry", "vector")
    met = probes.groupBy("list", "part").cogroup(listed.groupBy("list", "part"))
    return met.applyInArrow(_nearest(k + 1), "query bigint, entry bigint, score double")
