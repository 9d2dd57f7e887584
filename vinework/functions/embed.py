"""Text embedding as a column; the model is a function the caller passes in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Column of texts -> column of vectors.
Embedder = Callable[[Column], Column]


def length_embedder(text: Column) -> Column:
    """Deterministic test embedder: four dimensions from the text length."""
    size = F.char_length(text)
    return F.transform(F.sequence(size, size + 3), lambda i: ((i % 4) / F.lit(4)).cast("float"))


def model_embedder(load: Callable[[], Callable[[list[str]], list[list[float]]]]) -> Embedder:
    """Embedder around a model that embeds lists of texts.

    ``load`` runs once per Python worker and returns the batch function, so a
    model is read once and called with whole Arrow batches.
    """

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            filled = texts.fillna("")
            yield pd.Series(encode(filled.tolist()), index=texts.index)

    return embed
