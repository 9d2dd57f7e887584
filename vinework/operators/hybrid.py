"""Hybrid search: reciprocal rank fusion of vector and text hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinework.functions.text import ENGLISH, TextConfig
from vinework.functions.vectors import Metric
from vinework.operators import fulltext
from vinework.operators.knn import knn
from vinework.sources.textindex import TextIndex

# Rank offset of the fusion, list length per requested row.
RANK_OFFSET = 60
OVERFETCH = 4


def hybrid(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 4,
    metric: Metric | str = Metric.COSINE,
    *,
    where: Column | None = None,
    config: TextConfig = ENGLISH,
    ranking: str = "bm25",
    index: DataFrame | TextIndex | None = None,
    keep_text_only: bool = False,
    digits: int | None = None,
    id_col: str = "id",
    vec_col: str = "embedding",
    text_col: str = "content",
    qid_col: str = "qid",
    query_vec: str = "embedding",
    query_text: str = "text",
) -> DataFrame:
    """Fuse the 4k nearest and the 4k best-matching rows of every query.

    Output ``qid, rank, id, score, distance`` with distance = 1 - score. The
    filter holds for both lists. A row found only by its text is dropped
    unless ``keep_text_only``. ``ranking`` is ``proximity`` or ``bm25``.
    ``index`` is a stored :class:`TextIndex` of the corpus, for ``bm25``, or a
    postings table (with positions for ``proximity``); a filter then selects
    its rows by document id.
    """
    fetch = OVERFETCH * k
    rows = corpus if where is None else corpus.filter(where)
    near = knn(
        rows, queries, fetch, metric, digits=digits,
        id_col=id_col, vec_col=vec_col, qid_col=qid_col, query_vec=query_vec,
    ).select(F.col(qid_col).alias("qid"), F.col(id_col).alias("id"), F.col("rank").alias("_near"))
    if isinstance(index, TextIndex):
        if ranking != "bm25":
            raise ValueError("a text index ranks by bm25")
        if where is None:
            worded = index.search(queries, fetch, digits=digits, text_col=query_text, qid_col=qid_col)
            worded = worded.select("qid", "id", F.col("rank").alias("_worded"))
            return fuse(near, worded, k, keep_text_only, digits).withColumnsRenamed({"qid": qid_col, "id": id_col})
        config = index.config
    asked = fulltext.query_terms(queries, config, text_col=query_text, qid_col=qid_col)
    if isinstance(index, TextIndex):
        index = index.postings(asked)
    if index is None:
        index = fulltext.query_postings(
            rows, asked, config, text_col=text_col, id_col=id_col, positions=ranking == "proximity"
        )
    elif where is not None:
        index = index.join(rows.select(F.col(id_col).alias("id")), "id", "left_semi")
    if ranking == "proximity":
        scored = fulltext.rank_proximity(index, asked)
    elif ranking == "bm25":
        scored = fulltext.rank_bm25(index, asked)
    else:
        raise ValueError("ranking must be 'proximity' or 'bm25'")
    worded = fulltext.top_texts(scored, fetch, digits).select("qid", "id", F.col("rank").alias("_worded"))
    fused = fuse(near, worded, k, keep_text_only, digits)
    return fused.withColumnsRenamed({"qid": qid_col, "id": id_col})


def fuse(near: DataFrame, worded: DataFrame, k: int, keep_text_only: bool = False, digits: int | None = None) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists per query."""
    joined = near.join(worded, ["qid", "id"], "full_outer" if keep_text_only else "left")

    def share(rank: str) -> Column:
        return F.coalesce(1.0 / (F.col(rank) + RANK_OFFSET), F.lit(0.0))

    score = share("_near") + share("_worded")
    scored = joined.select("qid", "id", (score if digits is None else F.round(score, digits)).alias("score"))
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id"))
    top = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select("qid", "rank", "id", "score", (1.0 - F.col("score")).alias("distance"))
