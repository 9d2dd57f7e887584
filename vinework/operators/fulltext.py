"""Full-text match and rank over a postings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vinework.functions import text as words
from vinework.functions.text import ENGLISH, TextConfig
from vinework.runtime import cut_lineage

# Term that stands for the whole document.
WHOLE = ""


def postings(
    corpus: DataFrame,
    config: TextConfig = ENGLISH,
    *,
    text_col: str = "content",
    id_col: str = "id",
    positions: bool = False,
    only: DataFrame | None = None,
) -> DataFrame:
    """Inverted index ``term, id, tf, length`` and optionally ``positions``.

    Positions count all words from 1. ``length`` is the document's number of
    words. The term ``""`` stands for the document itself, so that corpus size
    and mean length come from the index. ``only`` is a frame of terms to keep, a written one at best.

    A document's words are counted in the task that reads it; one row per
    document and term is shuffled.
    """
    texts = corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    entries = texts.select("id", words.marked_terms(F.coalesce("_text", F.lit("")), config).alias("_entries"))
    itself = F.concat("_entries", F.array(F.lit(WHOLE)))
    each = entries.select("id", F.size("_entries").alias("length"), F.posexplode(itself).alias("pos", "term"))
    each = each.filter(words.is_term(F.col("term"), config))
    if only is not None:
        each = each.join(only.select("term"), "term", "left_semi")
    counts = [F.count(F.lit(1)).alias("tf"), F.first("length").alias("length")]
    if positions:
        counts.append(F.array_sort(F.collect_list(F.col("pos") + 1)).alias("positions"))
    found = each.groupBy("term", "id").agg(*counts)
    return found.select("term", "id", "tf", "length", *(["positions"] if positions else []))


def query_postings(corpus: DataFrame, asked: DataFrame, config: TextConfig = ENGLISH, **options) -> DataFrame:
    """Postings of the asked terms only, written once for all later reads.

    Reads every text once and keeps what the queries need.
    """
    whole = asked.sparkSession.range(1).select(F.lit(WHOLE).alias("term"))
    only = cut_lineage(asked.select("term").union(whole).distinct(), "asked")
    return cut_lineage(postings(corpus, config, only=only, **options), "postings")


def save_postings(index: DataFrame, path: str) -> None:
    """Write postings ranged by term and id, so a term's rows sit together and a frequent term spans many files.

    Joins with asked terms read all of it; an index that is pruned by its terms
    and kept up to date is :class:`vinework.sources.textindex.TextIndex`.
    """
    order = ["term", "id"]
    index.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def query_terms(queries: DataFrame, config: TextConfig = ENGLISH, *, text_col: str = "text", qid_col: str = "qid") -> DataFrame:
    """Distinct terms per query and their number: ``qid, term, n_terms``."""
    distinct = F.array_distinct(words.terms(F.col(text_col), config))
    asked = queries.select(F.col(qid_col).alias("qid"), distinct.alias("_terms"))
    return asked.select("qid", F.size("_terms").alias("n_terms"), F.explode("_terms").alias("term"))


def hits(index: DataFrame, asked: DataFrame, *columns: str) -> DataFrame:
    """Postings of the documents that may match: ``qid, id, term, n_terms, df, *columns``.

    A document must have the query's rarest term. Only those documents are
    looked up under the other terms, so a frequent word that many queries ask
    costs what their rare words leave, and never queries times documents.
    """
    terms = asked.select("term").distinct()
    frequency = index.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = cut_lineage(asked.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0))), "weighed")
    rarest = weighed.groupBy("qid").agg(F.min(F.struct("df", "term")).alias("_r")).filter("_r.df > 0")
    possible = index.select("term", "id").join(rarest.select("qid", F.col("_r.term").alias("term")), "term").select("qid", "id")
    wanted = cut_lineage(possible, "possible").join(weighed, "qid")
    return wanted.join(index.select("term", "id", *columns), ["term", "id"])


def _all_terms(found: DataFrame) -> DataFrame:
    return found.filter(F.col("_n") == F.col("n_terms"))


def _matching(*more) -> tuple:
    return F.count(F.lit(1)).alias("_n"), F.first("n_terms").alias("n_terms"), *more


def match(index: DataFrame, asked: DataFrame) -> DataFrame:
    """Documents that contain all terms of a query: ``qid, id, n_terms``.

    A query without terms matches nothing.
    """
    return _all_terms(hits(index, asked).groupBy("qid", "id").agg(*_matching())).select("qid", "id", "n_terms")


def rank_bm25(index: DataFrame, asked: DataFrame) -> DataFrame:
    """BM25 of matching documents: ``qid, id, score``.

    Corpus size and mean length come from the document rows of the index,
    document frequencies from the rows of the query terms.
    """
    corpus = index.filter(F.col("term") == WHOLE).agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    n_docs = corpus.select(F.col("n").cast("double")).scalar()
    mean_length = corpus.select("mean").scalar()
    share = words.bm25(F.col("tf"), F.col("df"), F.col("length"), n_docs, mean_length)
    scored = hits(index, asked, "tf", "length").groupBy("qid", "id").agg(*_matching(F.sum(share).alias("score")))
    return _all_terms(scored).select("qid", "id", "score")


def rank_proximity(index: DataFrame, asked: DataFrame) -> DataFrame:
    """Frequency and proximity rank of matching documents: ``qid, id, score``.

    One term ranks by its occurrences, several by how close they stand: every
    two occurrences of different terms within ``REACH`` words add evidence that
    falls with their distance. The index needs positions. All occurrences count;
    each is compared with those in the words before it, so the work grows with
    the text and not with its square.
    """
    found = cut_lineage(hits(index, asked, "tf", "positions"), "hits")
    matched = _all_terms(found.groupBy("qid", "id").agg(*_matching(F.max("tf").alias("_tf"))))
    matched = cut_lineage(matched, "matched")
    several = found.join(matched.filter("n_terms > 1").select("qid", "id"), ["qid", "id"], "left_semi")
    placed = several.select("qid", "id", "term", F.explode("positions").alias("pos"))
    before = Window.partitionBy("qid", "id").orderBy("pos").rangeBetween(-words.REACH, -1)
    placed = placed.withColumn("_near", F.collect_list(F.struct("term", "pos")).over(before))
    doubt = F.aggregate(
        "_near",
        F.lit(0.0),
        lambda total, x: total + F.when(x["term"] != F.col("term"), words.miss(F.col("pos") - x["pos"])).otherwise(F.lit(0.0)),
    )
    close = placed.groupBy("qid", "id").agg(F.sum(doubt).alias("_doubt"))
    scored = matched.join(close, ["qid", "id"], "left")
    rank = F.when(F.col("n_terms") == 1, words.frequency_rank(F.col("_tf"))).otherwise(1.0 - F.exp(F.coalesce("_doubt", F.lit(0.0))))
    return scored.select("qid", "id", rank.alias("score"))


def top_texts(scored: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """Best k documents per query: ``qid, rank, id, score``."""
    score = F.col("score") if digits is None else F.round("score", digits)
    order = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id"))
    ranked = scored.withColumn("score", score).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("qid", "rank", "id", "score")
