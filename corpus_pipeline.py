"""The corpus pipeline: from raw documents to a mix of sources.

Every stage takes what its predecessor kept and returns the columns of
``documents``; the last adds how often the mix takes a document. Stages are
written tables in the shared folder, so each is computed once and a lost
executor costs one stage at most. Extra columns of ``documents`` pass through
all stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vinework.llm import decontaminate, langid, mixing, simhash, substrings
from vinework.runtime import cut_lineage


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those in none of the known languages, go; null languages are filled in.

    Languages are learned from the rows with one; where there are none, only
    documents without letters go. Null texts go, repeated rows stay.
    """
    return langid.keep_identified(docs, langid.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id, one without an id only if all are.

    Of repeated rows one stays; documents without words are near duplicates of each other.
    """
    return simhash.drop_near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat an earlier one are cut out; every document stays, also null, empty and repeated ones."""
    return substrings.drop_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go; null and empty texts stay, and all without a benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` and ``taken`` words; a null source is one, documents without words go."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# SimHash groups and repeated passages can't be stated in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
