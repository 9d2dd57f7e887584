"""Streaming upserts: the batch rule applied to every arriving batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vinework.runtime import scratch
from vinework.sources.collection import CollectionStore
from vinework.sources.graph import GraphStore
from vinework.streaming.ordered import newest_rows


def stream_documents(documents: DataFrame, store: CollectionStore, checkpoint: str, ordered: bool = False, **trigger) -> StreamingQuery:
    """Upsert a stream of documents into a collection.

    Upserts are keyed, so a batch that is replayed after a failure changes
    nothing. Only the hash buckets that a batch touches are rewritten. With
    ``ordered`` a row whose ``seq`` is smaller than one that came in an earlier
    batch is left out, so late batches overwrite nothing newer; rows then need
    an ``id`` and a ``seq``.
    """
    if ordered:
        documents = newest_rows(documents)

    def apply(batch: DataFrame, _: int) -> None:
        with scratch(batch.sparkSession):
            store.add(batch)

    return _start(documents, apply, checkpoint, trigger, "update" if ordered else "append")


def stream_graph(documents: DataFrame, store: GraphStore, checkpoint: str, include_source: bool = False, **trigger) -> StreamingQuery:
    """Upsert a stream of graph documents into a graph."""

    def apply(batch: DataFrame, _: int) -> None:
        with scratch(batch.sparkSession):
            store.merge(batch, include_source)

    return _start(documents, apply, checkpoint, trigger)


def _start(stream: DataFrame, apply, checkpoint: str, trigger: dict, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
