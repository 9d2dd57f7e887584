"""Nearest neighbours, relevance, filters, diversity, cells, graph expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from vinework.functions import vectors
from vinework.functions.embed import length_embedder
from vinework.functions.filters import MetadataFilter, metadata_filter
from vinework.functions.vectors import Metric
from vinework.operators.ann import build_cells, recall
from vinework.operators.knn import knn
from vinework.operators.rag import expand
from vinework.operators.search import Search
from vinework.plans.inputs import (
    CENTRES_SQL,
    COLLECTION_SQL,
    SCALED_SQL,
    collection,
    label_centres,
    scaled_vectors,
    table,
)
from vinework.plans.registry import query
from vinework.sources.graph import PropertyGraph

DIST_SQL = {
    "cosine": "list_cosine_distance({a}, {b})",
    "l2": "list_distance({a}, {b})",
    "ip": "-list_inner_product({a}, {b})",
}


def _knn_sql(metric: str, corpus: str, queries: str, k: int, where: str = "TRUE", more: str = "") -> str:
    dist = DIST_SQL[metric].format(a="q.embedding", b="c.embedding")
    return f"""
      SELECT qid, rank::INTEGER AS rank, id, distance{more} FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance NULLS LAST, id) AS rank FROM (
          SELECT q.qid, c.id, round({dist}, 6) + 0.0 AS distance FROM {queries} q, {corpus} c WHERE {where}))
      WHERE rank <= {k}"""


def _scaled_queries(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


_ASKED_SQL = "asked AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS embedding FROM embeddings)"


def _register_knn(metric: str) -> None:
    @query(f"knn_{metric}", f"WITH {SCALED_SQL}, {_ASKED_SQL} {_knn_sql(metric, 'scaled', 'asked', 4)}")
    def run(spark, sf_dir):
        return knn(scaled_vectors(spark, sf_dir), _scaled_queries(spark, sf_dir), 4, metric, digits=6)


for _metric in Metric:
    _register_knn(_metric.value)


@query("knn_blocks", f"WITH {SCALED_SQL}, {_ASKED_SQL} {_knn_sql('l2', 'scaled', 'asked', 4)}")
def knn_blocks(spark, sf_dir):
    """The distributed form for query batches too large to ship."""
    corpus, queries = scaled_vectors(spark, sf_dir), _scaled_queries(spark, sf_dir)
    return knn(corpus, queries, 4, Metric.L2, digits=6, plan="blocks")


@query("knn_batch", f"WITH {COLLECTION_SQL}, {CENTRES_SQL} {_knn_sql('cosine', 'collection', 'centres', 10)}")
def knn_batch(spark, sf_dir):
    return Search(collection(spark, sf_dir), digits=6).by_vector(label_centres(spark, sf_dir), 10)


@query(
    "knn_nulls_last",
    f"WITH {COLLECTION_SQL}, {CENTRES_SQL} {_knn_sql('cosine', 'collection', 'centres', 40, where=chr(34) + 'source' + chr(34) + ' = ' + chr(39) + 'src3' + chr(39))}",
)
def knn_nulls_last(spark, sf_dir):
    """More neighbours asked for than there are vectors in the filtered rows."""
    return Search(collection(spark, sf_dir), digits=6).by_vector(label_centres(spark, sf_dir), 40, {"source": "src3"})


@query(
    "knn_relevance",
    f"""WITH {SCALED_SQL}, {CENTRES_SQL}, hits AS ({_knn_sql('l2', 'scaled', 'centres', 5)})
        SELECT *, round(1 / (1 + distance), 6) AS relevance FROM hits""",
)
def knn_relevance(spark, sf_dir):
    engine = Search(scaled_vectors(spark, sf_dir), metric=Metric.L2, digits=6)
    hits = engine.with_relevance(label_centres(spark, sf_dir), 5)
    return hits.withColumn("relevance", F.round("relevance", 6))


@query(
    "knn_custom_score",
    f"""WITH {SCALED_SQL}, {CENTRES_SQL}, hits AS ({_knn_sql('cosine', 'scaled', 'centres', 5)})
        SELECT *, round(exp(-distance), 6) AS relevance FROM hits""",
)
def knn_custom_score(spark, sf_dir):
    engine = Search(scaled_vectors(spark, sf_dir), digits=6, score_fn=lambda d: F.exp(-d))
    hits = engine.with_relevance(label_centres(spark, sf_dir), 5)
    return hits.withColumn("relevance", F.round("relevance", 6))


@query(
    "knn_filtered",
    f"""WITH {COLLECTION_SQL}, {CENTRES_SQL}
        {_knn_sql('cosine', 'collection', 'centres', 5, where="lang IN ('en', 'de') AND n_chars >= 500")}""",
)
def knn_filtered(spark, sf_dir):
    wanted = {"$and": [{"lang": {"$in": ["en", "de"]}}, {"n_chars": {"$gte": 500}}]}
    return Search(collection(spark, sf_dir), digits=6).by_vector(label_centres(spark, sf_dir), 5, wanted)


@query(
    "knn_filtered_promoted",
    f"""WITH {COLLECTION_SQL}, {CENTRES_SQL}
        {_knn_sql('cosine', 'collection', 'centres', 5, where="lang IN ('en', 'de') AND n_chars >= 500")}""",
)
def knn_filtered_promoted(spark, sf_dir):
    """The same filter on typed columns, which reaches the Parquet scan."""
    filters = MetadataFilter(promoted={"lang": "lang", "n_chars": "n_chars"})
    wanted = {"$and": [{"lang": {"$in": ["en", "de"]}}, {"n_chars": {"$gte": 500}}]}
    engine = Search(collection(spark, sf_dir), digits=6, filters=filters)
    return engine.by_vector(label_centres(spark, sf_dir), 5, wanted)


@query(
    "distances_all",
    f"""WITH {SCALED_SQL}, {CENTRES_SQL}
        SELECT id, round({DIST_SQL['cosine'].format(a='s.embedding', b='c.embedding')}, 6) AS cosine,
               round({DIST_SQL['l2'].format(a='s.embedding', b='c.embedding')}, 6) AS l2,
               round({DIST_SQL['ip'].format(a='s.embedding', b='c.embedding')}, 6) AS ip
        FROM scaled s JOIN centres c ON c.qid = s.label""",
)
def distances_all(spark, sf_dir):
    centres = label_centres(spark, sf_dir).select(F.col("qid").alias("label"), F.col("embedding").alias("centre"))
    rows = scaled_vectors(spark, sf_dir).join(centres, "label")
    return rows.select(
        "id", *(F.round(vectors.distance(m, F.col("embedding"), F.col("centre")), 6).alias(m.value) for m in Metric)
    )


@query(
    "float32_vectors",
    f"""WITH {CENTRES_SQL}
        SELECT qid, round(list_sum([x::FLOAT::DOUBLE FOR x IN embedding]), 6) AS total, len(embedding)::INTEGER AS dim FROM centres""",
)
def float32_vectors(spark, sf_dir):
    stored = label_centres(spark, sf_dir).select("qid", vectors.float32(F.col("embedding"), 64).alias("v"))
    total = F.aggregate(vectors.doubles(F.col("v")), F.lit(0.0), lambda acc, x: acc + x)
    return stored.select("qid", F.round(total, 6).alias("total"), F.size("v").alias("dim"))


@query(
    "embed_text_test",
    """WITH docs AS (SELECT doc_id AS id, [((length(text) + i) % 4) / 4.0::DOUBLE FOR i IN [0, 1, 2, 3]] AS embedding FROM documents),
            asked AS (SELECT item_id AS qid, [((length(text) + i) % 4) / 4.0::DOUBLE FOR i IN [0, 1, 2, 3]] AS embedding FROM benchmark)
       """
    + _knn_sql("l2", "docs", "asked", 4),
)
def embed_text_test(spark, sf_dir):
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), length_embedder(F.col("text")).alias("embedding"))
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return Search(corpus, length_embedder, Metric.L2, digits=6).by_text(queries, 4)


# name -> (filter dictionary, SQL condition over the collection's metadata m)
FILTERS = {
    "filter_bare": ({"lang": "en"}, "m->>'lang' = 'en'"),
    "filter_eq": ({"quality": {"$eq": 1}}, "m->>'quality' = '1'"),
    "filter_ne": ({"quality": {"$ne": 1}}, "m->>'quality' <> '1'"),
    "filter_lt": ({"n_chars": {"$lt": 1000}}, "(m->>'n_chars')::DECIMAL(38,12) < 1000"),
    "filter_lte": ({"n_chars": {"$lte": 1000.5}}, "(m->>'n_chars')::DECIMAL(38,12) <= 1000.5"),
    "filter_gt": ({"n_chars": {"$gt": 1000}}, "(m->>'n_chars')::DECIMAL(38,12) > 1000"),
    "filter_gte": ({"quality": {"$gte": 1}}, "(m->>'quality')::DECIMAL(38,12) >= 1"),
    "filter_in": ({"source": {"$in": ["src1", "src3", "src7"]}}, "m->>'source' IN ('src1', 'src3', 'src7')"),
    "filter_nin": ({"quality": {"$nin": [0]}}, "m->>'quality' NOT IN ('0')"),
    "filter_between": ({"n_chars": {"$between": [400, 900]}}, "(m->>'n_chars')::DECIMAL(38,12) BETWEEN 400 AND 900"),
    "filter_like": ({"source": {"$like": "src1%"}}, "m->>'source' LIKE 'src1%'"),
    "filter_ilike": ({"lang": {"$ilike": "E_"}}, "m->>'lang' ILIKE 'E_'"),
    "filter_exists": ({"quality": {"$exists": True}}, "list_contains(json_keys(m), 'quality')"),
    "filter_not_exists": ({"quality": {"$exists": False}}, "NOT list_contains(json_keys(m), 'quality')"),
    "filter_and": (
        {"$and": [{"lang": "en"}, {"n_chars": {"$gt": 2000}}]},
        "m->>'lang' = 'en' AND (m->>'n_chars')::INT > 2000",
    ),
    "filter_or": (
        {"$or": [{"lang": "fr"}, {"$and": [{"quality": 0}, {"n_chars": {"$lt": 3000}}]}]},
        "m->>'lang' = 'fr' OR (m->>'quality' = '0' AND (m->>'n_chars')::INT < 3000)",
    ),
    "filter_several": (
        {"lang": "en", "n_chars": {"$gt": 500, "$lt": 2500}},
        "m->>'lang' = 'en' AND (m->>'n_chars')::INT > 500 AND (m->>'n_chars')::INT < 2500",
    ),
    "filter_none": (None, "TRUE"),
}


def _register_filter(name: str, spec, condition: str) -> None:
    @query(name, f"WITH {COLLECTION_SQL}, c AS (SELECT id, metadata::JSON AS m FROM collection) SELECT id FROM c WHERE {condition}")
    def run(spark, sf_dir):
        corpus = collection(spark, sf_dir, vectors=False)
        where = metadata_filter(spec)
        return (corpus if where is None else corpus.filter(where)).select("id")


for _name, (_spec, _condition) in FILTERS.items():
    _register_filter(_name, _spec, _condition)


def _mmr_sql() -> str:
    """Greedy picks by relevance minus likeness, one common table per pick."""
    picks = """p1 AS (SELECT qid, id, 1 AS pick FROM cand QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(to_q, 12) DESC, rank) = 1)"""
    for n in range(2, 5):
        before = " UNION ALL ".join(f"SELECT qid, id FROM p{i}" for i in range(1, n))
        picks += f""", p{n} AS (
          SELECT c.qid, c.id, {n} AS pick
          FROM cand c JOIN ({before}) p ON p.qid = c.qid JOIN vectors v ON v.id = p.id
          WHERE (c.qid, c.id) NOT IN (SELECT (qid, id) FROM ({before}))
          GROUP BY c.qid, c.id, c.rank, c.to_q
          QUALIFY row_number() OVER (PARTITION BY c.qid ORDER BY
            round(0.5 * c.to_q - 0.5 * max(list_cosine_similarity(c.embedding, v.embedding)), 12) DESC, c.rank) = 1)"""
    every = " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(1, 5))
    return f"""WITH vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS embedding FROM embeddings), {_ASKED_SQL},
      near AS ({_knn_sql('cosine', 'vectors', 'asked', 20)}),
      cand AS (
        SELECT n.*, v.embedding, list_cosine_similarity(q.embedding, v.embedding) AS to_q
        FROM near n JOIN vectors v ON v.id = n.id JOIN asked q ON q.qid = n.qid),
      {picks}
      SELECT e.qid, e.pick, e.id, n.distance FROM ({every}) e JOIN near n ON n.qid = e.qid AND n.id = e.id"""


@query("mmr", _mmr_sql())
def mmr_query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    picks = Search(rows, digits=6).diverse(_scaled_queries(spark, sf_dir), 4, 20, 0.5)
    return picks.select("qid", "pick", "id", "distance")


@query("ann_ivf")
def ann_ivf(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return build_cells(rows, n_lists=16, iterations=5).search(_scaled_queries(spark, sf_dir), 4, nprobe=6, digits=6)


@query("ann_all_cells", f"WITH vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS embedding FROM embeddings), {_ASKED_SQL} {_knn_sql('cosine', 'vectors', 'asked', 4)}")
def ann_all_cells(spark, sf_dir):
    """A search of all cells is exact."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return build_cells(rows, n_lists=16, iterations=5).search(_scaled_queries(spark, sf_dir), 4, nprobe=16, digits=6)


@query("ann_recall", "SELECT count(*)::BIGINT AS queries, TRUE AS enough FROM embeddings")
def ann_recall(spark, sf_dir):
    """Whether a search of twelve cells of sixteen finds nine tenths of the exact neighbours, on average."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = _scaled_queries(spark, sf_dir)
    found = build_cells(rows, n_lists=16, iterations=5).search(queries, 4, nprobe=12, digits=6)
    shares = recall(found, knn(rows, queries, 4, digits=6))
    return shares.agg(F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.9).alias("enough"))


def _register_skipping(metric: str) -> None:
    @query(f"knn_skipping_{metric}", f"WITH {SCALED_SQL}, {_ASKED_SQL} {_knn_sql(metric, 'scaled', 'asked', 4)}")
    def run(spark, sf_dir):
        """Exact neighbours from the cells that can hold them."""
        index = build_cells(scaled_vectors(spark, sf_dir), n_lists=32, metric=metric, iterations=5)
        return index.search_exact(_scaled_queries(spark, sf_dir), 4, digits=6)


for _metric in Metric:
    _register_skipping(_metric.value)


def document_graph(spark, sf_dir) -> PropertyGraph:
    """Documents with their source and language."""
    documents = table(spark, sf_dir, "documents")
    label = F.lit("Document").alias("src_label")

    def edges(column: str, name: str):
        return documents.select(
            F.concat_ws(":", F.lit(name), "doc_id").alias("id"), F.concat_ws(":", F.lit("doc"), "doc_id").alias("start_id"),
            F.concat_ws(":", F.lit(name), column).alias("end_id"), label, F.lit(name).alias("dst_label"),
        )

    return PropertyGraph({}, {"FROM": edges("source", "Source"), "IN": edges("lang", "Language")})


@query(
    "graph_rag_expand",
    f"""WITH {COLLECTION_SQL}, {CENTRES_SQL}, hits AS ({_knn_sql('cosine', 'collection', 'centres', 5)})
        SELECT qid, rank, id, distance, 'FROM' AS rel_type, 'Source:' || d.source AS neighbour_id, 'Source' AS neighbour_label
        FROM hits JOIN documents d ON d.doc_id = id
        UNION ALL
        SELECT qid, rank, id, distance, 'IN', 'Language:' || d.lang, 'Language' FROM hits JOIN documents d ON d.doc_id = id""",
)
def graph_rag_expand(spark, sf_dir):
    hits = Search(collection(spark, sf_dir), digits=6).by_vector(label_centres(spark, sf_dir), 5)
    hits = hits.withColumn("node_id", F.concat_ws(":", F.lit("doc"), "id"))
    return expand(hits, document_graph(spark, sf_dir)).select(
        "qid", "rank", "id", "distance", "rel_type", "neighbour_id", "neighbour_label"
    )
