import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm import brute
from vinework.llm import bidiagonal, centroids, lists, minhash, queries, whitening
from vinework.llm.components import connected


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_minhash"])
def test_queries_match_their_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert oracle.spark_result(queries.QUERIES[name](spark, sf)) == oracle.duck_result(oracle.duck(sf), queries.ORACLES[name])


# ---- clustering


def found_clusters(df):
    digest = centroids.digest()
    return [tuple(r) for r in df.select("vec_id", "_ce_cluster", "_ce_distance", "_ce_cluster_inertia", "_ce_inertia", digest).collect()]


def odd_vectors(spark, width):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=width).tolist()) for i in range(150)]
    good += [(i, good[3][1]) for i in range(200, 260)] + [(7, good[7][1]), (None, good[9][1]), (8, good[1][1])]
    bad = [(300, None), (301, []), (302, [1.0]), (303, [float("nan")] * width), (304, [None, *[1.0] * (width - 1)]), (305, [float("inf")] * width), (306, [1.0] * (width + 1))]
    schema = "vec_id bigint, embedding array<double>, cluster int, place string, list int"
    return spark.createDataFrame([(*r, 1, "x", None) for r in good + bad], schema).repartition(5), good


@pytest.mark.parametrize("k", [1, 7, 500])
def test_clusters_of_odd_vectors(spark, k):
    vectors, good = odd_vectors(spark, 6)
    found = centroids.cluster(vectors, k=k, width=6, rounds=3)
    assert {"cluster", "place", "list"} <= set(found.columns)
    assert by_id(found_clusters(found)) == by_id(brute.clusters(good, k=k, rounds=3))


def test_products_change_only_where_centroids_do():
    x = np.arange(12).reshape(3, 4)
    dots = np.zeros((3, 2), np.int64)
    centroids._add_products(dots, x, [(1, np.array([0, 2]), np.array([5, -1]))])
    assert (dots[:, 0] == 0).all() and (dots[:, 1] == x @ [5, 0, -1, 0]).all()
    large = np.full((1, 4), 1 << 27)
    dots = np.zeros((1, 2), np.int64)
    centroids._add_products(dots, large, [(0, np.arange(4), np.full(4, (1 << 27) + 1))])
    assert dots[0, 0] == 4 * (1 << 27) * ((1 << 27) + 1)


def test_clusters_of_no_vectors(spark):
    vectors, _ = odd_vectors(spark, 6)
    for none in (vectors.limit(0), vectors.filter("embedding IS NULL")):
        assert centroids.cluster(none).count() == 0


def test_components_too_large_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<double>")).collect()


# ---- near duplicates


def found_sets(df):
    return [tuple(r) for r in df.select("doc_id", "_mh_size", "_mh_id").collect()]


def test_minhash_odd_rows(odd, odd_rows):
    found = minhash.near_duplicates(odd)
    assert found.columns[:-2] == [c for c in odd.columns if c != "text"]
    assert by_id(found_sets(found)) == by_id(brute.set_components([r[:2] for r in odd_rows]))
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def families(seed=3):
    """(id, text): families of texts around the threshold, one of them with hundreds of members, many exact copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for family in range(25):
        base = rng.choices(words, k=rng.choice([5, 40, 200]))
        for _ in range(250 if family == 0 else 12):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, rows[0][1]) for i in range(300)]
    rng.shuffle(rows)
    return rows


def test_minhash_at_the_threshold(spark):
    rows = families()
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    expected = brute.set_components(rows)
    assert by_id(found_sets(found)) == by_id(expected)
    assert len({least for *_, least in expected}) > 25


def test_minhash_with_long_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LONG_LIST", 7)
    monkeypatch.setattr(minhash, "TASK_BYTES", 3000)
    rows = families(5)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    assert by_id(found_sets(found)) == by_id(brute.set_components(rows))


def test_minhash_of_the_larger_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = [tuple(r)[:3] for r in queries.op12_minhash(spark, "/root/testdata/sf0.01").collect()]
    assert by_id(found) == by_id(brute.set_components(rows))


def test_posterior_bounds():
    """Pairs at the threshold pass every step; unlike ones are given up at the first."""
    least = minhash.least_matches(0.85)
    assert len(least) == 4 and all(a < b for a, b in zip(least, least[1:], strict=False))
    rng = np.random.default_rng(1)
    agree = rng.random((200_000, 128)) < 0.85
    for step, needed in enumerate(least, 1):
        assert (agree[:, : 32 * step].sum(axis=1) < needed).mean() < 1e-5
        agree = agree[agree[:, : 32 * step].sum(axis=1) >= needed]
    assert (rng.random((1000, 32)) < 0.2).sum(axis=1).max() < least[0] + 6
    for fewer, more in ((1e-8, 1e-3),):
        assert all(a <= b for a, b in zip(minhash.least_matches(0.85, fewer), minhash.least_matches(0.85, more), strict=True))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    one, two = np.sort(np.concatenate([shared, a])), np.sort(np.concatenate([shared, b]))
    found = minhash.signatures(np.concatenate([one, two]), np.array([0, 900, 1800]))
    assert abs((found[0] == found[1]).mean() - 0.8) < 0.12


@pytest.mark.parametrize("limit", [2, 5, 1000])
def test_links_in_lists_are_those_of_all_pairs(spark, limit):
    """Numbers are linked when they differ by at most 3; one list is hot and mostly connected."""
    rng = random.Random(limit)
    rows = [(1, i, 1) for i in range(0, 90, 2)] + [(1, i, 1) for i in range(200, 400, 5)] + [(1, 500, 1), (1, 502, 1)]
    rows += [(2 + i % 9, rng.randrange(1000, 1400), 1) for i in range(300)]
    rows = sorted(set(rows))

    def check(table: pa.Table):
        node = np.asarray(table.column("node"))
        return lambda i, j: np.abs(node[i] - node[j]) <= 3

    members = spark.createDataFrame(rows, "list bigint, node bigint, weight bigint").repartition(3)
    found = {r["node"]: r["root"] for r in connected(lists.links(members, [], check, limit)).collect()}
    parent = {n: n for _, n, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, x, _ in rows:
            for b, y, _ in rows:
                if a == b and abs(x - y) <= 3 and parent[x] != parent[y]:
                    parent[x] = parent[y] = min(parent[x], parent[y])
                    changed = True
    assert {n: found.get(n, n) for n in parent} == parent


# ---- whitening


def plain_whitening(vectors, most=8):
    """Integers, eigenvalues and eigenvectors of the covariance."""
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    centred = (len(x) * x - x.sum(axis=0)) / len(x)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    return x, centred, values[::-1], directions[:, ::-1][:, :most]


def test_whitening_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = sorted(rows)
    x, centred, values, directions = plain_whitening([rows[i] for i in ids])
    expected = centred @ directions / np.sqrt(values[:8])
    found = queries.op13_whitening(spark, sf).collect()
    assert sorted((r.vec_id, r.component) for r in found) == [(i, c) for i in ids for c in range(1, 9)]
    got = np.zeros_like(expected)
    for r in found:
        got[ids.index(r.vec_id), r.component - 1] = r.whitened
        assert r.n == len(ids) and r.identity_error < 1e-9
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-9
    exact = {i: sum((len(ids) * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(axis=0), strict=True)) for i, row in zip(ids, x, strict=True)}
    assert all(exact[r.vec_id] == r.deviation for r in found)


def test_whitening_of_odd_vectors(spark):
    vectors, good = odd_vectors(spark, 6)
    found = whitening.whiten(vectors, whitening.learn(vectors)).collect()
    assert len(found) == 6 * len(good) and found[0].cluster == 1
    _, centred, values, _ = plain_whitening([v for _, v in good])
    by_component = {c: [r for r in found if r._wh_component == c] for c in range(1, 7)}
    for c, rows in by_component.items():
        assert abs(np.mean([r._wh_value for r in rows])) < 1e-9 and abs(np.mean([r._wh_value**2 for r in rows]) - 1) < 1e-9
        assert abs(rows[0]._wh_explained - values[c - 1] / values.sum()) < 1e-12
    for none in (vectors.limit(0), vectors.filter("embedding IS NULL")):
        assert whitening.whiten(none, whitening.learn(none)).count() == 0


def test_whitening_without_variance(spark):
    flat = spark.createDataFrame([(i, [1.0, float(i % 3), 2.0 * (i % 3)]) for i in range(9)], "vec_id bigint, embedding array<double>")
    rows = whitening.whiten(flat, whitening.learn(flat)).collect()
    assert {r._wh_component for r in rows if r._wh_value is not None} == {1} and len(rows) == 27
    assert all(r._wh_identity_error < 1e-9 for r in rows)
    one = flat.limit(1)
    rows = whitening.whiten(one, whitening.learn(one)).collect()
    assert len(rows) == 3 and all(r._wh_value is None and r._wh_explained is None and r._wh_deviation == 0 for r in rows)


def test_deviations_are_exact_at_any_size():
    rng = np.random.default_rng(8)
    for n in (3, 10**6, 10**10, 10**13):
        sums = [int(v) for v in rng.integers(0, 10**15, 70)]
        fit = whitening.Fit(70, n, sums)
        x = rng.integers(-900, 900, (5, 70))
        expected = [sum((n * (int(v) + int(m)) - s) ** 2 for v, m, s in zip(row, fit.means, sums, strict=True)) for row in x]
        assert fit.deviations(x) == expected


def test_factors_are_reduced_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    vectors, good = odd_vectors(spark, 6)
    fit = whitening.learn(vectors.repartition(23))
    _, _, values, _ = plain_whitening([v for _, v in good])
    assert np.allclose(fit.values, values, rtol=1e-10)


@pytest.mark.parametrize("kind", ["random", "graded", "clustered", "equal", "low rank", "split", "one"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(6)
    turn = lambda: np.linalg.qr(rng.normal(size=(40, 40)))[0]
    matrix = {
        "random": rng.normal(size=(40, 40)),
        "graded": rng.normal(size=(40, 40)) * np.logspace(0, -9, 40),
        "clustered": turn() @ np.diag([5.0] * 4 + [5 - 1e-10] * 4 + [1.0] * 32) @ turn(),
        "equal": 3 * np.eye(40),
        "low rank": rng.normal(size=(40, 12)) @ rng.normal(size=(12, 40)),
        "split": np.kron(np.eye(10), np.triu(rng.normal(size=(4, 4)))),
        "one": np.array([[2.0]]),
    }[kind]
    values, vectors = bidiagonal.right_vectors(matrix, 8)
    expected = np.linalg.svd(matrix, compute_uv=False) ** 2
    assert np.abs(values - expected).max() < 1e-13 * expected[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-11
    assert np.abs(matrix.T @ (matrix @ vectors.T) - vectors.T * values[: len(vectors)]).max() < 1e-12 * expected[0]


def test_small_values_are_accurate():
    """A bidiagonal matrix whose values span 30 orders of magnitude keeps the relative accuracy of all."""
    a, b = np.logspace(0, -15, 30), np.logspace(-1, -16, 29)
    found = bidiagonal.squared_values(a * a, b * b)
    # The product of all values is the squared determinant, exactly.
    assert abs(np.log(found).sum() - 2 * np.log(a).sum()) < 1e-10


def test_extra_columns_of_clashing_names(spark):
    vectors, _ = odd_vectors(spark, 6)
    more = vectors.withColumn("part", F.lit(1)).withColumn("width", F.lit("w")).withColumn("value", F.lit(0.5))
    assert whitening.whiten(more, whitening.learn(more)).filter("part = 1 AND width = 'w' AND value = 0.5").count() == 6 * 213
    assert centroids.cluster(more, width=6).filter("part = 1 AND width = 'w'").count() == 213
