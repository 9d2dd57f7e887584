import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vinework.functions import vectors
from vinework.functions.embed import length_embedder, model_embedder
from vinework.functions.kernels import diverse_picks
from vinework.functions.vectors import Metric
from vinework.operators import ann
from vinework.operators.ann import build_cells, recall
from vinework.operators.knn import knn
from vinework.operators.rag import expand, question_context
from vinework.operators.search import Search, search, with_documents
from vinework.sources.graph import PropertyGraph


def frame(spark, rows, id_name="id"):
    return spark.createDataFrame(rows, f"{id_name} bigint, embedding array<float>")


def brute(rows, query, k, metric):
    """(id, distance) of the k nearest: numbers, then NaN, then missing vectors."""
    q = np.array(query, dtype=np.float64)
    out = []
    for i, v in rows:
        if v is None:
            out.append((2, 0.0, i, None))
            continue
        x = np.array(v, dtype=np.float32).astype(np.float64)
        if metric == "l2":
            d = float(np.sqrt(((x - q) ** 2).sum()))
        elif metric == "ip":
            d = -float(x @ q)
        else:
            length = math.sqrt(x @ x) * math.sqrt(q @ q)
            d = float("nan") if length == 0 else 1 - float(x @ q) / length
        out.append((1, 0.0, i, d) if math.isnan(d) else (0, round(d, 6) + 0.0, i, round(d, 6) + 0.0))
    return [(i, d) for _, _, i, d in sorted(out, key=lambda t: t[:3])[:k]]


def as_dict(df):
    found = {}
    for r in df.orderBy("qid", "rank").collect():
        found.setdefault(r.qid, []).append((r.id, r.distance))
    return found


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        for (_, x), (_, y) in zip(a[q], b[q]):
            assert (x is None and y is None) or (math.isnan(x) and math.isnan(y)) or abs(x - y) < 1e-9


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=5) * rng.integers(1, 4)).astype(np.float32).tolist()) for i in range(90)]
    # A third of all rows are copies of one vector; some rows are zero or missing.
    rows += [(i, rows[7][1]) for i in range(100, 150)]
    rows += [(200, [0.0] * 5), (201, [0.0] * 5), (202, None), (203, None)]
    queries = [(q, rng.normal(size=5).astype(np.float32).tolist()) for q in range(6)] + [(50, rows[7][1])]
    return rows, queries


@pytest.mark.parametrize("metric", [m.value for m in Metric])
@pytest.mark.parametrize(
    ("k", "partitions", "options"),
    [(4, 1, {}), (4, 7, {"shipped_queries": 2}), (60, 3, {}), (4, 5, {"plan": "blocks"}), (200, 2, {"plan": "blocks"})],
)
def test_knn_against_brute_force(spark, data, metric, k, partitions, options):
    rows, queries = data
    corpus = frame(spark, rows).repartition(partitions)
    found = knn(corpus, frame(spark, queries, "qid"), k, metric, digits=6, **options)
    same(as_dict(found), {q: brute(rows, v, k, metric) for q, v in queries})


def test_knn_small_blocks(spark, data, monkeypatch):
    from vinework.operators import knn as module

    rows, queries = data
    monkeypatch.setattr(module.blockwise, "__kwdefaults__", {**module.blockwise.__kwdefaults__, "block_rows": 11, "block_queries": 2})
    found = knn(frame(spark, rows), frame(spark, queries, "qid"), 5, "l2", digits=6, plan="blocks")
    same(as_dict(found), {q: brute(rows, v, 5, "l2") for q, v in queries})


def test_knn_filters_before_ranking_and_carries_columns(spark, data):
    rows, queries = data
    corpus = frame(spark, rows).withColumn("content", F.concat(F.lit("c"), "id"))
    found = knn(corpus, frame(spark, queries, "qid"), 3, "l2", where=F.col("id") >= 60, digits=6, carry=("content",))
    same(as_dict(found), {q: brute([r for r in rows if r[0] >= 60], v, 3, "l2") for q, v in queries})
    assert all(r.content == f"c{r.id}" for r in found.collect())


def test_string_ids_and_empty_inputs(spark):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "id string, embedding array<float>")
    one = frame(spark, [(1, [1.0, 0.0])], "qid")
    assert [r.id for r in knn(corpus, one, 2).orderBy("rank").collect()] == ["a", "b"]
    assert knn(corpus.limit(0), one, 2).count() == 0
    assert knn(corpus, one.limit(0), 2).count() == 0


def test_wrong_dimension_raises(spark):
    with pytest.raises(Exception, match="dimensions"):
        knn(frame(spark, [(1, [1.0])]), frame(spark, [(1, [1.0, 2.0])], "qid"), 1).collect()
    with pytest.raises(Exception, match="expected 3 dimensions"):
        frame(spark, [(1, [1.0])]).select(vectors.float32(F.col("embedding"), 3)).collect()


def test_column_distances(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = row.select(
        vectors.distance("cosine", a, b), vectors.distance("l2", a, b), vectors.distance("ip", a, b), vectors.distance("cosine", a, z)
    ).first()
    assert got[0] == pytest.approx(1 - 24 / 25) and got[1] == pytest.approx(math.sqrt(2)) and got[2] == -24
    assert math.isnan(got[3])


@pytest.mark.parametrize(("metric", "d", "expected"), [("cosine", 0.25, 0.75), ("cosine", 1.5, -0.5), ("l2", 3.0, 0.25), ("ip", -7.0, 7.0)])
def test_relevance(spark, metric, d, expected):
    assert spark.range(1).select(vectors.relevance(metric, F.lit(d))).first()[0] == pytest.approx(expected)


def test_custom_score_applies_once(spark):
    corpus, one = frame(spark, [(1, [0.0, 2.0])]), frame(spark, [(1, [0.0, 1.0])], "qid")
    row = Search(corpus, metric="l2", score_fn=lambda d: d + 10).with_relevance(one, 1).first()
    assert (row.distance, row.relevance) == (1.0, 11.0)


def test_embedders(spark):
    texts = spark.createDataFrame([(1, "abcde"), (2, "")], "qid bigint, text string")
    rows = texts.select("qid", length_embedder(F.col("text")).alias("e")).orderBy("qid").collect()
    assert [r.e for r in rows] == [[0.25, 0.5, 0.75, 0.0], [0.0, 0.25, 0.5, 0.75]]

    def load():
        return lambda batch: [[float(len(t)), 1.0] for t in batch]

    corpus = frame(spark, [(1, [5.0, 1.0]), (2, [0.0, 1.0])])
    found = search(corpus, texts, 1, metric="l2", embedder=model_embedder(load))
    assert sorted((r.qid, r.id, r.distance) for r in found.collect()) == [(1, 1, 0.0), (2, 2, 0.0)]


def greedy(query, rows, k, weight):
    def cos(a, b):
        n = math.sqrt(a @ a) * math.sqrt(b @ b)
        return 0.0 if n == 0 else float(a @ b) / n

    picks = []
    while len(picks) < min(k, len(rows)):
        best, best_score = None, None
        for i, r in enumerate(rows):
            if i in picks:
                continue
            score = cos(query, r)
            if picks:
                score = weight * score - (1 - weight) * max(cos(r, rows[p]) for p in picks)
            if best_score is None or score > best_score + 1e-12:
                best, best_score = i, score
        picks.append(best)
    return picks


@pytest.mark.parametrize("weight", [0.0, 0.3, 0.5, 1.0])
def test_diverse_picks_against_greedy(weight):
    rng = np.random.default_rng(5)
    query, rows = rng.normal(size=6), rng.normal(size=(12, 6))
    assert diverse_picks(query, rows, 5, weight) == greedy(query, rows, 5, weight)
    assert len(diverse_picks(query, rows[:2], 5, weight)) == 2


@pytest.mark.parametrize("partitions", [1, 7])
def test_mmr_against_brute_force(spark, data, partitions):
    rows, queries = data
    rows = [r for r in rows if r[0] < 90]
    vector = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    found = Search(frame(spark, rows).repartition(partitions), metric="l2", digits=6).diverse(frame(spark, queries, "qid"), 4, 12)
    got = {}
    for r in found.orderBy("qid", "pick").collect():
        got.setdefault(r.qid, []).append(r.id)
    for q, v in queries:
        near = [i for i, _ in brute(rows, v, 12, "l2")]
        picks = greedy(np.array(v, dtype=np.float32).astype(float), [vector[i] for i in near], 4, 0.5)
        assert got[q] == [near[p] for p in picks]


@pytest.mark.parametrize("metric", [m.value for m in Metric])
def test_cells_equal_exact_when_all_are_probed(spark, data, metric, tmp_path):
    rows, queries = data
    corpus, asked = frame(spark, rows), frame(spark, queries, "qid")
    index = build_cells(corpus, 4, metric, iterations=3)
    exact = knn(corpus, asked, 4, metric, digits=6)
    everywhere = index.save(str(tmp_path / "index")).search(asked, 4, nprobe=4, digits=6)
    same(as_dict(everywhere), as_dict(exact))
    assert recall(index.search(asked, 4, nprobe=2, digits=6), exact).agg(F.avg("recall")).first()[0] > 0.4


def test_expand_hits_through_the_graph(spark):
    ends = [("e1", "a", "b", "N", "M"), ("e2", "c", "a", "M", "N"), ("e3", "a", "a", "N", "N")]
    edges = spark.createDataFrame(ends, "id string, start_id string, end_id string, src_label string, dst_label string")
    g = PropertyGraph({}, {"E": edges})
    hits = spark.createDataFrame([(1, "a", 0.5)], "qid int, node_id string, distance double")
    rows = expand(hits, g).collect()
    assert sorted((r.direction, r.neighbour_id, r.neighbour_label) for r in rows) == [("in", "c", "M"), ("out", "a", "N"), ("out", "b", "M")]
    assert expand(hits, g, direction="in").count() == 2
    assert expand(hits, g, context=lambda df: df.filter("neighbour_id = 'b'")).count() == 1


def test_question_context_keeps_first_rows(spark):
    rows = spark.createDataFrame([(1, i, f"v{i}") for i in range(20)], "question int, seq int, value string")
    row = question_context(rows).first()
    assert row.context == [f'{{"value":"v{i}"}}' for i in range(10)]


def test_with_documents(spark):
    corpus = spark.createDataFrame([(1, [1.0], "t", "{}", "n")], "id bigint, embedding array<float>, content string, metadata string, node_id string")
    hits = search(corpus, frame(spark, [(9, [1.0])], "qid"), 1)
    assert with_documents(hits, corpus).first().content == "t"


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_exact_search_skips_cells_of_clustered_vectors(spark, metric, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 10
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.2).tolist()) for i in range(3000)]
    rows += [(5000, None), (5001, [0.0] * 8), (5002, rows[0][1]), (5003, rows[0][1])]
    corpus = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    queries = spark.createDataFrame([(i, rows[i * 7][1]) for i in range(60)] + [(100, [0.0] * 8), (101, None)], "qid int, embedding array<double>")
    index = ann.build_cells(corpus, 40, metric, iterations=8).save(str(tmp_path / "cells"))
    for k in (1, 5):
        found = index.search_exact(queries, k, digits=6)
        truth = knn(corpus, queries, k, metric, digits=6)
        key = lambda df: sorted((r.qid, r["rank"], r.id, str(r.distance)) for r in df.collect())
        assert key(found) == key(truth)
    read = index.cells_read(queries.filter("qid < 100"), 5, digits=6).collect()
    assert len(read) == 60 and all(r.cells == 40 for r in read)
    if metric != "ip":  # no triangle inequality holds for inner products, so their bounds are loose
        assert sum(r.read for r in read) < 0.3 * 40 * 60


def test_number_of_cells_follows_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 50)
    corpus = spark.range(1000).select("id", F.array(F.sin("id"), F.cos("id")).alias("embedding"))
    assert len(ann.build_cells(corpus, metric="l2", iterations=2).centres) == 20
    monkeypatch.setattr(ann, "MOST_CELLS", 5)
    assert len(ann.build_cells(corpus, metric="l2", iterations=2).centres) == 5
    monkeypatch.setattr(ann, "MOST_FIT_ROWS", 100)
    index = ann.build_cells(corpus, metric="l2", iterations=2)
    assert index.cells.count() == 1000 and index.search(corpus.withColumnRenamed("id", "qid").limit(3), 1, nprobe=5).count() == 3


def test_large_query_sets_stay_off_the_driver(spark, data, monkeypatch):
    corpus, queries = frame(spark, data[0]), frame(spark, data[1], "qid")
    monkeypatch.setattr("vinework.operators.knn.SHIPPED_BYTES", 64)
    plan = knn(corpus, queries, 3)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_rows_become_a_matrix_in_bounded_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from vinework.functions import kernels

    rng = np.random.default_rng(3)
    rows, queries = rng.normal(size=(20_000, 8)), rng.normal(size=(30, 8))
    sizes, plain = [], kernels.matrix
    monkeypatch.setattr(kernels, "matrix", lambda column, dim: sizes.append(len(column)) or plain(column, dim))
    vectors = pa.array([None if i % 997 == 0 else v.tolist() for i, v in enumerate(rows)], pa.list_(pa.float64()))
    for metric in ("cosine", "l2", "ip"):
        state = kernels.NearestRows(pa.array(range(30)), queries, metric, 4, None, ["id"])
        state.add(pa.table({"id": pa.array(range(20_000)), "embedding": vectors}), "id", "embedding")
        found = np.asarray(state.result("qid").column("id")).reshape(30, 4)
        dist = kernels.rough_distances(queries, rows, metric)
        dist[:, ::997] = np.inf
        assert (found == np.argsort(dist, axis=1)[:, :4]).all()
    assert max(sizes) <= 8_192
