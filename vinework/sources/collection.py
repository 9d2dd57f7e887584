"""Document collections: creation, upsert, deletion, lookup, graph ingestion."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinework.functions.embed import Embedder
from vinework.functions.vectors import float32
from vinework.runtime import cut_lineage
from vinework.sources.buckets import BucketedTable, latest

if TYPE_CHECKING:
    from vinework.sources.textindex import TextIndex

COLLECTION_SCHEMA = (
    "id string, content string, embedding array<float>, metadata string, node_id string"
)
# A batch without an order holds different rows of one id.
REPEATED = "a seq column must order the rows of a repeated id: "
# Metadata key that moves into the column of the same name.
NODE_KEY = "node_id"


def prepare(
    documents: DataFrame,
    embedder: Embedder | None = None,
    *,
    dim: int | None = None,
) -> DataFrame:
    """Bring incoming rows into the shape of a collection.

    Needs ``content``; ``id`` defaults to a random UUID, ``metadata`` to
    ``{}``, ``embedding`` to the embedder's vector of the content. A node id
    inside the metadata moves to its own column. An optional ``seq`` column
    orders repeated ids.
    """
    names = set(documents.columns)
    vector = F.col("embedding") if "embedding" in names else F.lit(None)
    if "embedding" not in names and embedder is not None:
        vector = embedder(F.col("content"))
    elif "embedding" in names and embedder is not None:
        vector = F.coalesce(F.col("embedding"), embedder(F.col("content")))
    bag = F.coalesce(F.col("metadata"), F.lit("{}")) if "metadata" in names else F.lit("{}")
    node = F.get_json_object(bag, f"$.{NODE_KEY}")
    if "node_id" in names:
        node = F.coalesce(F.col("node_id").cast("string"), node)
    identity = F.col("id").cast("string") if "id" in names else F.uuid()
    return documents.select(
        identity.alias("id"),
        F.col("content"),
        float32(vector, dim).alias("embedding"),
        _without_key(bag, NODE_KEY).alias("metadata"),
        node.alias("node_id"),
        *([F.col("seq")] if "seq" in names else []),
    )


def _without_key(metadata: Column, key: str) -> Column:
    """JSON object text without one key; values keep their JSON type."""
    bag = F.from_json(metadata, "map<string,variant>")
    rest = F.to_json(F.map_filter(bag, lambda k, _: k != key))
    present = F.coalesce(F.array_contains(F.json_object_keys(metadata), key), F.lit(False))
    return F.when(present, rest).otherwise(metadata)


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Collection after ``incoming``: whole rows replaced, last of a batch wins."""
    fresh = last_of_batch(incoming)
    kept = existing.join(fresh.select("id"), "id", "left_anti")
    return kept.unionByName(fresh.select(*existing.columns))


def last_of_batch(incoming: DataFrame) -> DataFrame:
    """One row per id: the one with the highest ``seq``.

    Rows of a DataFrame have no order, so a batch without ``seq`` may repeat an
    id only with equal rows; others raise.
    """
    if "seq" in incoming.columns:
        return latest(incoming, ["id"], ["seq"]).drop("seq")
    row = F.struct(*incoming.columns)
    mark = F.xxhash64(F.to_json(row))
    rows = incoming.groupBy("id").agg(F.first(row).alias("_row"), F.min(mark).alias("_low"), F.max(mark).alias("_high"))
    known = F.when(F.col("_low") != F.col("_high"), F.raise_error(F.concat(F.lit(REPEATED), "id"))).otherwise(F.col("_row"))
    return rows.select(known.alias("_row")).select("_row.*")


def delete(existing: DataFrame, ids: DataFrame) -> DataFrame:
    """Collection without the given ids; unknown ids are ignored."""
    return existing.join(ids.select("id"), "id", "left_anti")


def get(existing: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the given ids; missing ids are silently absent."""
    return existing.join(ids.select("id"), "id", "left_semi").select("id", "content", "metadata")


def by_ids(existing: DataFrame, ids: Sequence[str] | None) -> DataFrame:
    """Rows of a literal id list; no list matches nothing."""
    return existing.filter(F.col("id").isin(list(ids)) if ids else F.lit(False))


def metadata_with_node(metadata: Column, node_id: Column) -> Column:
    """Metadata text with the node id folded back in, as search results show it."""
    bag = F.from_json(F.coalesce(metadata, F.lit("{}")), "map<string,variant>")
    added = F.map_from_entries(F.array(F.struct(F.lit(NODE_KEY), F.try_variant_get(F.to_variant_object(F.array(node_id)), "$[0]", "variant"))))
    return F.when(node_id.isNull() | (node_id == ""), metadata).otherwise(F.to_json(F.map_concat(bag, added)))


def node_texts(nodes: DataFrame, label: str, properties: Sequence[str]) -> DataFrame:
    """Documents from graph nodes: property values joined by one blank.

    Null properties are skipped and nodes without text give no document.
    """
    content = F.trim(F.concat_ws(" ", *(F.col(f"`{p}`").cast("string") for p in properties)))
    node = F.col("id").cast("string")
    bag = F.to_json(F.struct(F.lit(label).alias("node_label")))
    return nodes.select(
        node.alias("id"), content.alias("content"), bag.alias("metadata"), node.alias("node_id")
    ).filter(F.col("content") != "")


class CollectionStore:
    """Collection on disk, partitioned by a hash bucket of the document id.

    ``index`` is a text index (:class:`vinework.sources.textindex.TextIndex`)
    that every change keeps up to date. It changes after the rows do: if a job
    fails in between, repeating the call mends both.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        embedder: Embedder | None = None,
        *,
        dim: int | None = None,
        buckets: int = 256,
        index: TextIndex | None = None,
    ) -> None:
        self.embedder, self.dim, self.index = embedder, dim, index
        self.table = BucketedTable(spark, path.rstrip("/"), COLLECTION_SCHEMA, ("id",), buckets)

    def create(self, replace: bool = False) -> CollectionStore:
        """Create unless it exists; ``replace`` empties an existing collection."""
        self.table.create(replace)
        if self.index is not None:
            self.index.create(replace)
        return self

    def drop(self) -> None:
        self.table.drop()
        if self.index is not None:
            self.index.drop()

    def read(self) -> DataFrame:
        return self.table.read()

    def add(self, documents: DataFrame) -> None:
        """Embed and upsert documents; replaced rows of a batch are not embedded."""
        fresh = last_of_batch(documents) if "id" in documents.columns else documents
        rows = prepare(fresh, self.embedder, dim=self.dim)
        if self.index is not None:
            rows = cut_lineage(rows, "prepared")  # random ids must be the same in both
        self.table.put(rows)
        if self.index is not None:
            self.index.add(rows.select("id", "content"))

    def add_nodes(self, nodes: DataFrame, label: str, properties: Sequence[str]) -> None:
        """Embed and upsert the text of graph nodes."""
        self.add(node_texts(nodes, label, properties))

    def delete(self, ids: DataFrame) -> None:
        self.table.remove(ids)
        if self.index is not None:
            self.index.delete(ids)

    def get(self, ids: DataFrame) -> DataFrame:
        return get(self.read(), self.table_keys(ids))

    @staticmethod
    def table_keys(ids: DataFrame) -> DataFrame:
        return ids.select(F.col("id").cast("string").alias("id"))

    @classmethod
    def open(cls, spark: SparkSession, path: str, embedder: Embedder | None = None, **options) -> CollectionStore:
        """Open an existing collection without inserting anything."""
        store = cls(spark, path, embedder, **options)
        if not store.table.exists():
            raise FileNotFoundError(path)
        return store

    @classmethod
    def from_documents(
        cls, spark: SparkSession, path: str, documents: DataFrame, embedder: Embedder | None = None, **options
    ) -> CollectionStore:
        """Create a collection and fill it."""
        store = cls(spark, path, embedder, **options).create()
        store.add(documents)
        return store
