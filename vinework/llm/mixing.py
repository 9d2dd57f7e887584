"""Mixing sources to target weights, in DataFrame functions only.

A document's place in its source is a hash. Words are summed by source and
hash bucket; running sums over at most 1,024 buckets of a source find the
bucket in which its budget ends; only the documents of that bucket are summed
again, by the next bits of the hash, until one hash is left. The result is a
threshold per source, and taking documents is a filter: nothing is sorted. What
the budget still lacks below the threshold is topped up by the one document
above it whose size comes nearest, if that is an improvement.

Defined results: a null text has size 0; documents without a source form a
source of their own, the last; documents with the same id share a hash and are
taken together (without an id the text stands in); sources of size 0 have
target 0; an empty table gives an empty result. Extra columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
HASH_BITS = 60
LEVEL_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place(id_col: Column, text: Column) -> Column:
    """A document's hash, 60 bits."""
    name = F.coalesce(id_col.cast("string"), F.concat(F.lit("text:"), text), F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _source_key(source: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _numbered(sources: DataFrame) -> DataFrame:
    """``_mx_rank``: place by code point from 0, null last. Ranges are numbered by themselves and shifted by the ranges before."""
    order = F.col("source").asc_nulls_last()
    ranged = cut_lineage(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(order))
    numbered = ranged.withColumn("inside", inside).join(shifts, "range")
    return numbered.withColumn("_mx_rank", F.col("inside") + F.col("shift") - 1).drop("range", "inside", "shift")


def _weight(weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_mx_rank") % len(weights) + 1).cast("int"))


def _targets(sources: DataFrame, most: int) -> DataFrame:
    """``target``: shares by weight, at most ``most`` times the source's size, the excess shared anew.

    Each round is one sum over the table of sources; sources at their limit
    stay there, so the rounds end.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit, level, at_limit = F.col("source_size") * most, 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > limit
        taken, free, n = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count(F.when(full, 1))
        ).first()
        if n == at_limit or not free:
            break
        at_limit, level = n, (total - taken) / free
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit.cast("double")))


def thresholds(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: ``source_size, target, whole`` (times everything is taken), ``below`` and ``extra`` (what is taken once more).

    ``sized`` is a written table with ``source, source_key, size, place``. Sums
    leave a task as one row per source, or source and bucket; rows are grouped
    by their hash only where the budget ends, and to find what tops it up.
    """
    sources = sized.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
    sources = _numbered(sources).withColumn("weight", _weight(weights))
    sources = _targets(cut_lineage(sources, "sources"), most)
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))
    whole = F.when(F.col("source_size") > 0, whole).otherwise(0)
    sources = sources.withColumn("whole", whole).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = cut_lineage(sources, "targets")
    rest = sized.select("source_key", "place", F.col("size").alias("words"))
    open_, found = sources.select("source_key", "left"), None
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("place", shift)
        sums = rest.groupBy("source_key", bucket.alias("bucket")).agg(
            F.sum("words").alias("words"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        upto = F.sum("words").over(Window.partitionBy("source_key").orderBy("bucket"))
        edge = sums.withColumn("upto", upto).join(open_, "source_key")
        edge = edge.filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
        edge = cut_lineage(edge.withColumn("left", F.col("left") - (F.col("upto") - F.col("words"))), "edge")
        single = (F.col("first") == F.col("last")) | F.lit(shift == 0)
        done = edge.filter(single).select("source_key", F.col("first").alias("below"), "left")
        found = done if found is None else found.unionByName(done)
        if shift == 0 or edge.filter(~single).isEmpty():
            break
        edge = edge.filter(~single)
        open_ = edge.select("source_key", "left")
        here = edge.select("source_key", "bucket")
        rest = rest.withColumn("bucket", bucket).join(here, ["source_key", "bucket"], "left_semi").drop("bucket")
        rest = cut_lineage(rest, "rest")
    found = cut_lineage(found, "found")
    extra = cut_lineage(_nearest_above(sized, found), "extra")
    out = sources.join(found.drop("left"), "source_key", "left").join(extra, "source_key", "left")
    below, extra = F.coalesce("below", F.lit(0).cast("bigint")), F.coalesce("best.place", F.lit(-1).cast("bigint"))
    return cut_lineage(out.select("source_key", "source_size", "target", "whole", below.alias("below"), extra.alias("extra")), "thresholds")


def _nearest_above(sized: DataFrame, found: DataFrame) -> DataFrame:
    """Per source, the hash at or above ``below`` whose words come nearest to ``left``, if that is nearer than nothing (``best``)."""
    off = F.abs(F.col("words") - F.col("left"))

    def nearest(rows: DataFrame) -> DataFrame:
        summed = rows.groupBy("source_key", "place").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
        return summed.filter(off < F.col("left")).groupBy("source_key").agg(F.min(F.struct(off.alias("off"), "place", "words")).alias("best"))

    above = sized.join(found, "source_key").filter(F.col("place") >= F.col("below"))
    # A hash that qualifies has no document of twice the words that are left, so the larger ones need no grouping.
    extra = cut_lineage(nearest(above.filter(F.col("size") < 2 * F.col("left"))), "nearest")
    # Unless documents of one id differ in size, and the larger of them was left out.
    chosen = extra.select("source_key", F.col("best.place").alias("place"), F.col("best.words").alias("words"))
    whole = sized.join(chosen, ["source_key", "place"]).groupBy("source_key", "place", "words").agg(F.sum("size").alias("all"))
    return extra if whole.filter("all <> words").isEmpty() else nearest(above)


def _copies(place_col: Column) -> Column:
    once_more = (place_col < F.col("below")) | (place_col == F.col("extra"))
    return (F.col("whole") + F.when(once_more, 1).otherwise(0)).cast("int")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, source_key, size, place`` of every document."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        _source_key(F.col(source_col)).alias("source_key"),
        text_size(F.col(text_col)).alias("size"),
        place(F.col(id_col), F.col(text_col)).alias("place"),
    )


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``id, size, source_size, target, copies, taken`` of every document."""
    sized = cut_lineage(sizes(docs), "sizes")
    taken = sized.join(thresholds(sized, weights, most), "source_key")
    taken = taken.withColumn("copies", _copies(F.col("place")))
    return taken.select("id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, with ``copies`` (1 to ``most``) and ``taken`` (words, copies counted)."""
    own = [F.col(f"document.{c}") for c in docs.columns if c not in ("copies", "taken")]
    document = F.struct(*docs.columns).alias("document")
    marked = docs.select(
        document, _source_key(F.col(source_col)).alias("source_key"), place(F.col(id_col), F.col(text_col)).alias("place"), text_size(F.col(text_col)).alias("size")
    )
    slim = cut_lineage(sizes(docs, id_col, text_col, source_col).drop("id"), "sizes")
    out = marked.join(thresholds(slim, weights, most), "source_key").withColumn("copies", _copies(F.col("place"))).filter("copies > 0")
    return out.select(*own, "copies", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))
