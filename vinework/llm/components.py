"""Connected components of links between 64-bit keys, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinework.runtime import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every key of ``links`` (two bigint columns ``a``, ``b``); root is the smallest key of the component.

    Each round moves every larger neighbour of a key to the key's smallest
    neighbour, then every smaller one; the number of rounds grows with the
    logarithm of the longest chain. Rounds are written tables, so a lost
    executor repeats one round at most. A link of a key to itself only names it.
    """
    edges = cut_lineage(links.select("a", "b").distinct(), "links")
    while not _stars(edges):
        before = _state(edges)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut_lineage(_star(both, F.col("b") > F.col("a")), "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = cut_lineage(_star(down, F.lit(True), center=True), "small-star")
        if _state(edges) == before:
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return found.unionByName(roots).distinct()


def _star(edges: DataFrame, moved, center: bool = False) -> DataFrame:
    """Links from the chosen neighbours of every key (and the key itself) to its smallest neighbour."""
    least = cut_lineage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    out = edges.filter(moved).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if center:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every key has one link, to a smaller key that has none: another round would leave that as it is."""
    out = F.struct(F.col("a").alias("key"), F.lit(1).alias("out"))
    into = F.struct(F.col("b").alias("key"), F.lit(0).alias("out"))
    ends = edges.select(F.explode(F.array(out, into)).alias("e"), (F.col("b") >= F.col("a")).alias("up")).select("e.key", "e.out", "up")
    seen = ends.groupBy("key").agg(F.sum("out").alias("links"), F.min("out").alias("least"), F.max("up").alias("up"))
    return not seen.filter("links > 1 or (links = 1 and least = 0) or up").head(1)


def _state(edges: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mark).first())
