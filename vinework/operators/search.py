"""One entry point for vector, text-embedded and hybrid search."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinework.functions.embed import Embedder
from vinework.functions.filters import MetadataFilter
from vinework.functions.text import ENGLISH, TextConfig
from vinework.functions.vectors import Metric, ScoreFn, relevance
from vinework.operators.hybrid import hybrid
from vinework.operators.knn import knn
from vinework.operators.mmr import mmr
from vinework.runtime import cut_lineage
from vinework.sources.textindex import TextIndex


@dataclass(frozen=True)
class Search:
    """Searches one collection; all methods take a frame of queries.

    ``mode`` is ``vector`` or ``hybrid`` and holds for queries given as text.
    A query given as a vector always searches by vector. ``filters`` compiles
    filter dictionaries, for instance with promoted metadata columns.
    """

    corpus: DataFrame
    embedder: Embedder | None = None
    metric: Metric | str = Metric.COSINE
    mode: str = "vector"
    score_fn: ScoreFn | None = None
    config: TextConfig = ENGLISH
    ranking: str = "bm25"
    index: DataFrame | TextIndex | None = None
    keep_text_only: bool = False
    digits: int | None = None
    filters: MetadataFilter = field(default_factory=MetadataFilter)

    def _where(self, filter: Mapping[str, Any] | Column | None) -> Column | None:
        return filter if filter is None or isinstance(filter, Column) else self.filters.compile(filter)

    def embedded(self, queries: DataFrame) -> DataFrame:
        """Queries with the vector of their text."""
        if "embedding" in queries.columns:
            return queries
        if self.embedder is None:
            raise ValueError("queries have no embedding and no embedder was given")
        # Written, so that the model sees each query once.
        return cut_lineage(queries.withColumn("embedding", self.embedder(F.col("text"))), "queries")

    def by_vector(self, queries: DataFrame, k: int = 4, filter: Mapping[str, Any] | Column | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
        """Nearest rows of ``qid, embedding`` queries."""
        return knn(self.corpus, queries, k, self.metric, where=self._where(filter), carry=carry, digits=self.digits)

    def by_text(self, queries: DataFrame, k: int = 4, filter: Mapping[str, Any] | Column | None = None) -> DataFrame:
        """Best rows of ``qid, text`` queries, in the search's mode."""
        queries = self.embedded(queries)
        if self.mode == "vector":
            return self.by_vector(queries, k, filter)
        if self.mode != "hybrid":
            raise ValueError("mode must be 'vector' or 'hybrid'")
        return hybrid(
            self.corpus, queries, k, self.metric, where=self._where(filter), config=self.config,
            ranking=self.ranking, index=self.index, keep_text_only=self.keep_text_only, digits=self.digits,
        )

    def with_relevance(self, queries: DataFrame, k: int = 4, filter: Mapping[str, Any] | Column | None = None) -> DataFrame:
        """As :meth:`by_text` plus ``relevance``; the score function applies once."""
        hits = self.by_text(queries, k, filter)
        return hits.withColumn("relevance", relevance(self.metric, F.col("distance"), self.score_fn))

    def diverse(
        self, queries: DataFrame, k: int = 4, fetch_k: int = 20, weight: float = 0.5,
        filter: Mapping[str, Any] | Column | None = None, carry: tuple[str, ...] = (),
    ) -> DataFrame:
        """Diverse rows among the ``fetch_k`` nearest."""
        return mmr(
            self.corpus, self.embedded(queries), k, fetch_k, weight, self.metric,
            where=self._where(filter), carry=carry, digits=self.digits,
        )


def search(corpus: DataFrame, queries: DataFrame, k: int = 4, filter=None, metric: Metric | str = Metric.COSINE, mode: str = "vector", **options: Any) -> DataFrame:
    """Search a collection with a frame of queries in one call."""
    engine = Search(corpus, metric=metric, mode=mode, **options)
    if "text" in queries.columns:
        return engine.by_text(queries, k, filter)
    return engine.by_vector(queries, k, filter)


def with_documents(hits: DataFrame, corpus: DataFrame, columns: tuple[str, ...] = ("content", "metadata", "node_id"), id_col: str = "id") -> DataFrame:
    """Add document columns to hits."""
    return hits.join(corpus.select(id_col, *columns), id_col)
