"""Full-text match, text ranks and hybrid fusion."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vinework.functions import text as words
from vinework.functions.text import ENGLISH, SIMPLE, STOP_WORDS, UNSTEMMED
from vinework.operators import fulltext
from vinework.operators.hybrid import hybrid
from vinework.plans.inputs import BENCHMARK_SQL, COLLECTION_SQL, benchmark_queries, benchmark_texts, collection, scratch_path, table
from vinework.plans.registry import query
from vinework.runtime import cut_lineage
from vinework.sources.textindex import TextIndex

_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


@query(
    "term_postings",
    r"""SELECT term, id, count(*) AS tf, any_value(n)::INTEGER AS length
        FROM (SELECT doc_id AS id, unnest(toks) AS term, len(toks) AS n
              FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS toks FROM documents))
        GROUP BY 1, 2
        UNION ALL
        SELECT '', doc_id, 1, len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))::INTEGER FROM documents""",
)
def term_postings(spark, sf_dir):
    return fulltext.postings(_documents(spark, sf_dir), SIMPLE)


@query(
    "text_match",
    rf"""WITH wanted AS (
           SELECT item_id AS qid, w FROM (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS w FROM benchmark)
           WHERE w NOT IN {_STOP_SQL}),
         n AS (SELECT qid, count(*) AS n_terms FROM wanted GROUP BY 1),
         present AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS w FROM documents)
       SELECT qid, id FROM wanted JOIN present USING (w) JOIN n USING (qid)
       GROUP BY qid, id, n_terms HAVING count(*) = n_terms""",
)
def text_match(spark, sf_dir):
    """Documents that contain every word of a benchmark passage."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    asked = fulltext.query_terms(queries, UNSTEMMED)
    index = fulltext.query_postings(_documents(spark, sf_dir), asked, UNSTEMMED)
    return fulltext.match(index, asked).select("qid", "id")


@query("text_match_english")
def text_match_english(spark, sf_dir):
    """The same with stemming, which SQL cannot state."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    asked = fulltext.query_terms(queries, ENGLISH)
    index = fulltext.query_postings(_documents(spark, sf_dir), asked, ENGLISH)
    return fulltext.match(index, asked).select("qid", "id")


_BM25_SQL = f"""
  {BENCHMARK_SQL},
  tf AS (SELECT term, doc_id AS id, count(*) AS tf, any_value(n) AS len FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  size AS (SELECT count(*) AS n_docs, avg(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS mean FROM documents),
  scored AS (
    SELECT qid, id, sum(ln((n_docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS score
    FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN asked_n USING (qid), size
    GROUP BY qid, id, n_terms HAVING count(*) = n_terms)
"""


@query("bm25_rank", f"WITH {_BM25_SQL} SELECT qid, id, round(score, 6) AS score FROM scored")
def bm25_rank(spark, sf_dir):
    asked = fulltext.query_terms(benchmark_texts(spark, sf_dir), SIMPLE)
    index = fulltext.query_postings(_documents(spark, sf_dir), asked, SIMPLE)
    scored = fulltext.rank_bm25(index, asked)
    return scored.select("qid", "id", F.round("score", 6).alias("score"))


_PROXIMITY_SQL = f"""
  {BENCHMARK_SQL},
  counted AS (SELECT doc_id AS id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
  matched AS (
    SELECT qid, id, n_terms, max(tf) AS tf FROM counted JOIN asked USING (term) JOIN asked_n USING (qid)
    GROUP BY qid, id, n_terms HAVING count(*) = n_terms),
  found AS (
    SELECT qid, id, asked.term, pos FROM matched JOIN asked USING (qid) JOIN words ON words.doc_id = matched.id AND words.term = asked.term),
  pairs AS (
    SELECT a.qid, a.id, 1 - exp(sum(ln(1 - 0.1 * sqrt(1 / (1.005 + 0.05 * exp((b.pos - a.pos) / 1.5 - 2)))))) AS score
    FROM found a JOIN found b ON a.qid = b.qid AND a.id = b.id AND a.term <> b.term AND b.pos - a.pos BETWEEN 1 AND 100
    GROUP BY 1, 2),
  scored AS (
    SELECT qid, id, CASE WHEN n_terms = 1
             THEN list_sum([0.1 / (j * j) FOR j IN range(1, tf + 1)]) / 1.64493406685
             ELSE coalesce(score, 0) END AS score
    FROM matched LEFT JOIN pairs USING (qid, id))
"""


@query("proximity_rank", f"WITH {_PROXIMITY_SQL} SELECT qid, id, round(score, 6) AS score FROM scored")
def proximity_rank(spark, sf_dir):
    asked = fulltext.query_terms(benchmark_texts(spark, sf_dir), SIMPLE)
    index = fulltext.query_postings(_documents(spark, sf_dir), asked, SIMPLE, positions=True)
    scored = fulltext.rank_proximity(index, asked)
    return scored.select("qid", "id", F.round("score", 6).alias("score"))


def _hybrid_sql(ranked: str, join: str, k: int = 4) -> str:
    return f"""WITH {COLLECTION_SQL}, {ranked},
      vectors AS (SELECT item_id AS qid, e.embedding::DOUBLE[] AS embedding FROM benchmark JOIN embeddings e ON e.vec_id = item_id),
      near AS (
        SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY d NULLS LAST, id) AS rn
        FROM (SELECT q.qid, c.id, round(list_cosine_distance(q.embedding, c.embedding), 6) AS d FROM vectors q, collection c)
        QUALIFY rn <= {4 * k}),
      worded AS (
        SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, id) AS rn FROM scored
        QUALIFY rn <= {4 * k}),
      fused AS (
        SELECT coalesce(n.qid, w.qid) AS qid, coalesce(n.id, w.id) AS id,
               round(coalesce(1.0::DOUBLE / (60 + n.rn), 0) + coalesce(1.0::DOUBLE / (60 + w.rn), 0), 6) AS score
        FROM near n {join} JOIN (SELECT * FROM worded WHERE qid IN (SELECT qid FROM vectors)) w ON n.qid = w.qid AND n.id = w.id)
      SELECT qid, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, id))::INTEGER AS rank, id, score, round(1 - score, 6) AS distance
      FROM fused QUALIFY rank <= {k}"""


def _hybrid(spark, sf_dir, **options):
    hits = hybrid(
        collection(spark, sf_dir), benchmark_queries(spark, sf_dir), 4, config=SIMPLE, digits=6, **options
    )
    return hits.withColumn("distance", F.round("distance", 6))


@query("hybrid_rrf", _hybrid_sql(_PROXIMITY_SQL, "LEFT"))
def hybrid_rrf(spark, sf_dir):
    return _hybrid(spark, sf_dir, ranking="proximity")


@query("hybrid_rrf_bm25", _hybrid_sql(_BM25_SQL, "LEFT"))
def hybrid_rrf_bm25(spark, sf_dir):
    return _hybrid(spark, sf_dir, ranking="bm25")


@query("hybrid_rrf_text_only", _hybrid_sql(_BM25_SQL, "FULL"))
def hybrid_rrf_text_only(spark, sf_dir):
    return _hybrid(spark, sf_dir, ranking="bm25", keep_text_only=True)


@query(
    "text_terms",
    rf"""SELECT doc_id, len(t)::INTEGER AS n_terms, len(list_distinct(t))::INTEGER AS n_distinct
         FROM (SELECT doc_id, [w FOR w IN regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') IF w NOT IN {_STOP_SQL}] AS t FROM documents)""",
)
def text_terms(spark, sf_dir):
    terms = words.terms(F.col("text"), UNSTEMMED)
    return table(spark, sf_dir, "documents").select("doc_id", terms.alias("t")).select(
        "doc_id", F.size("t").alias("n_terms"), F.size(F.array_distinct("t")).alias("n_distinct")
    )


_TOP_SQL = """SELECT qid, rank, id, score FROM (
    SELECT qid, id, round(score, 6) AS score, (row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, id))::INTEGER AS rank FROM scored)
  WHERE rank <= 10"""


def _index(spark, **options):
    return TextIndex(spark, scratch_path(spark, "text"), SIMPLE, id_type="bigint", buckets=16, **options).create()


@query("text_index_search", f"WITH {_BM25_SQL} {_TOP_SQL}")
def text_index_search(spark, sf_dir):
    """The ten best documents of every benchmark passage, from a stored index."""
    index = _index(spark)
    index.add(_documents(spark, sf_dir))
    return index.search(benchmark_texts(spark, sf_dir), 10, digits=6)


# Statistics of the table "current", queries from "documents".
_PAIRS_SQL = r"""
  words AS (SELECT doc_id AS id, unnest(toks) AS term, len(toks) AS len
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS toks FROM current)),
  tf AS (SELECT term, id, count(*) AS tf, any_value(len) AS len FROM words GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  size AS (SELECT count(*) AS n_docs, avg(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS mean FROM current),
  frequent AS (
    SELECT row_number() OVER (ORDER BY df DESC, term) AS qid, [term, lead(term) OVER (ORDER BY df DESC, term)] AS terms
    FROM (SELECT term, count(DISTINCT doc_id) AS df FROM (
      SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents) GROUP BY 1)),
  asked AS (SELECT qid::INTEGER AS qid, unnest(terms) AS term, len(terms) AS n_terms FROM frequent WHERE qid <= 12),
  scored AS (
    SELECT qid, id, sum(ln((n_docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS score
    FROM asked JOIN tf USING (term) JOIN df USING (term), size
    GROUP BY qid, id, n_terms HAVING count(*) = n_terms)
"""


def _frequent_pairs(spark, sf_dir):
    """Queries of two frequent words: each of the twelve most frequent with the next one."""
    documents = _documents(spark, sf_dir)
    # Rows of an id that comes once are counted where they are read; only those of repeated ids are shuffled by term and id.
    repeated = cut_lineage(documents.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("id").alias("_id")), "repeated")
    same = F.col("id").eqNullSafe(F.col("_id"))
    each = documents.join(repeated, same, "left_anti").select(F.explode(F.array_distinct(words.terms(F.col("content"), SIMPLE))).alias("term"))
    again = fulltext.postings(documents.join(repeated, same, "left_semi"), SIMPLE).filter(F.col("term") != fulltext.WHOLE).select("term")
    found = each.unionByName(again)
    order = Window.orderBy(F.col("df").desc(), "term")
    ranked = found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).orderBy(F.col("df").desc(), "term").limit(13)
    ranked = ranked.select(F.row_number().over(order).alias("qid"), F.concat_ws(" ", "term", F.lead("term").over(order)).alias("text"))
    return ranked.filter("qid <= 12")


@query("text_index_frequent", f"WITH current AS (SELECT * FROM documents), {_PAIRS_SQL} {_TOP_SQL}")
def text_index_frequent(spark, sf_dir):
    """Words of nearly all documents: bounds leave most blocks unread."""
    index = _index(spark, block_docs=16)
    index.add(_documents(spark, sf_dir))
    return index.search(_frequent_pairs(spark, sf_dir), 10, digits=6)


@query(
    "text_index_cycle",
    f"""WITH current AS (
          SELECT doc_id, CASE WHEN lang = 'en' THEN text || ' ' || source ELSE text END AS text FROM documents WHERE coalesce(source, '') <> 'src7'),
        {_PAIRS_SQL} {_TOP_SQL}""",
)
def text_index_cycle(spark, sf_dir):
    """Documents are added, some replaced, some deleted; the index is opened again, compacted, changed once more and searched."""
    documents = table(spark, sf_dir, "documents")
    index, content = _index(spark, block_docs=16), F.col("text").alias("content")
    index.add(documents.select(F.col("doc_id").alias("id"), content))
    english = documents.filter("lang = 'en'")
    index.add(english.select(F.col("doc_id").alias("id"), F.reverse("text").alias("content")))
    index.delete(documents.filter("source = 'src7'").select(F.col("doc_id").alias("id")))
    index = TextIndex(spark, index.path, SIMPLE, id_type="bigint", buckets=16, block_docs=16)
    index.compact()
    changed = english.filter("coalesce(source, '') <> 'src7'")
    index.add(changed.select(F.col("doc_id").alias("id"), F.concat_ws(" ", "text", "source").alias("content")))
    return index.search(_frequent_pairs(spark, sf_dir), 10, digits=6)
