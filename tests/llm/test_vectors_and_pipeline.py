import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vinework.llm import queries, spann

sys.path.insert(0, ".")
import corpus_pipeline  # noqa: E402


def nearest(rows, query, k):
    """Exact neighbours of a row among (id, vector) rows."""
    own = np.array(dict(rows)[query], float)
    scored = [(-spann.cosines(own, np.array([v], float))[0], i) for i, v in rows if i != query]
    return [(i, -s) for s, i in sorted(scored)[:k]]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = {}
    for r in queries.op9_ann_search(spark, sf).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    asked = [i for i, _ in rows if i % 50 == 0]
    assert sorted(found) == sorted(asked)
    hits = 0
    for q in asked:
        mine = sorted(found[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        hits += len({m[1] for m in mine} & {i for i, _ in nearest(rows, q, 5)})
    assert hits >= 0.9 * 5 * len(asked)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0, None]),
        (8, [1.0, float("nan")]), (9, [1.0, float("inf")]), (10, [-1.0, 0.0]), (11, []), (12, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]),
        *[(100 + i, [1.0, 0.0]) for i in range(30)], (13, [1e300, 1e300]), (14, [1e-300, 0.0]), (4, [0.0, 1.0]),
    ]
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<double>, rank int")
    found = {}
    for r in spann.search(vectors, vectors, 5).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r["id"], round(r.score, 9)))
    assert set(found) == {1, 2, 3, 4, 10, 13, 14, *range(100, 130)}
    assert sorted(found[1]) == [(1, 2, 1.0), (2, 3, 1.0), (3, 14, 1.0), (4, 100, 1.0), (5, 101, 1.0)]
    assert sorted(found[100])[:3] == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]
    assert spann.search(vectors.limit(0), vectors, 5).count() == 0 and spann.search(vectors, vectors.limit(0), 5).count() == 0


def test_long_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spann, "LIST_PART", 7)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = spann.search(vectors, vectors.filter("vec_id % 20 = 0"), 5).collect()
    hits = sum(r["id"] in {i for i, _ in nearest(rows, r.query_id, 5)} for r in found)
    assert len(found) == 50 and hits >= 45


def test_small_samples_still_index_every_row(spark, monkeypatch):
    monkeypatch.setattr(spann, "SAMPLE", 50)
    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "vec_id bigint, embedding array<double>")
    found = spann.search(vectors, vectors.filter("vec_id % 10 = 0"), 3)
    assert found.count() == 90 and {r["id"] % 7 for r in found.collect()} == set(range(7))


def test_centroids_are_balanced_and_found():
    points = spann._unit(np.random.default_rng(1).normal(size=(4000, 16)))
    centroids = spann.fit(points)
    found, _ = centroids.search(points[:200].astype(np.float32), 5)
    exact = np.argsort(-(points[:200] @ centroids.points.T), axis=1)[:, 0]
    assert (found[:, 0] == exact).mean() > 0.95
    assert np.bincount(np.argmax(points @ centroids.points.T, axis=1)).max() < 8 * spann.PER_LIST


def expected_pipeline(spark, sf):
    """Ids and texts of every stage but the last, by the plain versions."""
    rows = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = [i for i in sorted(rows) if any(c.isalpha() for c in rows[i].text or "")]
    kept = sorted({least for _, _, least in brute.components([(i, rows[i].text) for i in kept])})
    words, seen = {}, set()
    for i in kept:
        mine = brute.raw(rows[i].text).split()
        gone = [False] * len(mine)
        for at in range(len(mine) - 19):
            window = b" ".join(mine[at : at + 20])
            if window in seen:
                gone[at : at + 20] = [True] * 20
            seen.add(window)
        words[i] = b" ".join(w for w, g in zip(mine, gone, strict=True) if not g).decode()
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in brute.contamination(list(words.items()), items) if r[-1]}
    return {i: w for i, w in words.items() if i not in hit}


def test_pipeline_matches_the_plain_versions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
    found = {r.doc_id: b" ".join(r.text.encode().split()).decode() for r in docs.collect()}
    assert found == expected_pipeline(spark, sf)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    ran = corpus_pipeline.run(spark, sf)
    assert ran.columns == [*columns, "copies", "taken"]
    keys = lambda df: sorted((r.doc_id, r.copies, r.taken) for r in df.collect())
    assert keys(ran) == keys(last) and all(c >= 1 for _, c, _ in keys(ran))


def test_stages_on_odd_rows(spark, odd, sf):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", F.col("n"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() <= docs.count()
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_languages_stage_without_known_languages(spark, odd, sf):
    """Null languages, or one named like the label of unknown ones, cost no document with letters."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for lang in (None, "und"):
        kept = corpus_pipeline.identify_languages(spark, docs.withColumn("lang", F.lit(lang).cast("string")), sf)
        expected = sorted(str((r.doc_id, r.text)) for r in docs.collect() if any(c.isalpha() for c in r.text or ""))
        assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == expected
