"""Writes to graphs: create, merge, overlay, set, delete, graph documents.

Properties are bags, ``map<string,string>`` of JSON scalars, where a null
value asks to remove the key. An overlay keeps, per key, the last value
written; "last per key" needs one row per key and task, so one node that
receives a third of all writes never gathers in one place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.runtime import cut_lineage

# Keys -> the stored rows that have them.
Lookup = Callable[[DataFrame], DataFrame]

NODE_KEY = ("label", "id")
EDGE_KEY = ("type", "src_label", "src_id", "dst_label", "dst_id")

# Shape of one graph document; ``seq`` orders documents.
DOCUMENT_SCHEMA = (
    "seq bigint, "
    "nodes array<struct<id:string,type:string,properties:map<string,string>>>, "
    "rels array<struct<src_id:string,src_type:string,dst_id:string,dst_type:string,"
    "type:string,properties:map<string,string>>>, "
    "source struct<content:string,metadata:string>"
)

# Fixed values of the source link.
SOURCE_LABEL = "Document"
SOURCE_EDGE = "MENTIONS"
UNKNOWN_SOURCE = "unknown"
# Sources have keys of their own, so that a user's node with the same label and id stays apart.
SOURCE_KEY = "source\x1f"
EXCERPT = 500


def json_text(value: Column, dtype: T.DataType) -> Column:
    """JSON encoding of a scalar, so that 30 and "30" stay apart in a bag."""
    if isinstance(dtype, T.StringType):
        # to_json of a one-field struct quotes the text; keep what follows the key.
        return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    return value.cast("string")


def create_nodes(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Append nodes or edges; duplicates are allowed."""
    return existing.unionByName(fresh, allowMissingColumns=True)


def merge_nodes(existing: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the nodes for which no existing node has all the given properties.

    Only ``keys`` are compared, so an existing node with further properties
    counts as a match. Repeated rows of a batch create one node.
    """
    new = fresh.dropDuplicates(list(keys)).join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def set_property(df: DataFrame, name: str, value: Column, condition: Column) -> DataFrame:
    """Set one property on the matching rows."""
    before = F.col(f"`{name}`") if name in df.columns else F.lit(None)
    return df.withColumn(name, F.when(condition, value).otherwise(before))


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame, *, check: bool = True) -> DataFrame:
    """Nodes without those in ``gone``; raises if an edge still refers to one."""
    if check and not _losing_an_end(edges, gone).isEmpty():
        raise ValueError("cannot delete a node that still has edges")
    return nodes.join(gone.select("id"), "id", "left_anti")


def dangling(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges that would lose an end, each once."""
    return _losing_an_end(edges, gone).distinct()


def _losing_an_end(edges: DataFrame, gone: DataFrame) -> DataFrame:
    out = edges.join(gone.select(F.col("id").alias("start_id")), "start_id", "left_semi")
    back = edges.join(gone.select(F.col("id").alias("end_id")), "end_id", "left_semi")
    return out.select("id", "start_id", "end_id").unionByName(back.select("id", "start_id", "end_id"))


def detach_delete(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes without those in ``gone``, and edges without theirs."""
    ids = gone.select("id")
    kept = edges.join(ids.select(F.col("id").alias("start_id")), "start_id", "left_anti")
    kept = kept.join(ids.select(F.col("id").alias("end_id")), "end_id", "left_anti")
    return nodes.join(ids, "id", "left_anti"), kept.select(*edges.columns)


def overlay(existing: DataFrame | None, writes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply property writes in order to existing bags: ``keys, props``.

    ``writes`` has the keys, ``props`` and ``seq`` (unique per key and order).
    Existing rows come first. A last value of null removes the key.
    """
    every = writes.select(*keys, "props", "seq")
    if existing is not None:
        never = F.lit(None).cast(writes.schema["seq"].dataType).alias("seq")
        every = existing.select(*keys, "props", never).unionByName(every)
    # The entry without a key says that the row exists, also when its bag is empty.
    entries = F.map_entries(F.coalesce(F.col("props"), F.create_map().cast("map<string,string>")))
    each = every.select(*keys, F.explode(F.concat(entries, F.array(_mark()))).alias("_entry"), _after("seq"))
    each = each.select(*keys, F.col("_entry.key").alias("_key"), F.col("_entry.value").alias("_value"), "_order")
    last = each.groupBy(*keys, "_key").agg(F.max_by(F.struct("_value"), "_order").alias("_last"))
    kept = F.filter(F.collect_list(F.struct("_key", F.col("_last._value"))), _stays)
    return last.groupBy(*keys).agg(F.map_from_entries(kept).alias("props"))


def _mark() -> Column:
    return F.lit(None).cast("struct<key:string,value:string>")


def _stays(entry: Column) -> Column:
    return entry["_key"].isNotNull() & entry["_value"].isNotNull()


def _after(seq: str) -> Column:
    """Order key that puts stored rows (no seq) before all writes."""
    return F.struct(F.col(seq).isNotNull().alias("fresh"), F.col(seq).alias("seq")).alias("_order")


def _position(document: str, at: str) -> Column:
    return F.struct(F.col(document).alias("doc"), F.col(at).cast("bigint").alias("at")).alias("seq")


def node_writes(documents: DataFrame, include_source: bool = False) -> DataFrame:
    """Node upserts in document order: ``label, id, props, seq``.

    A property named ``id`` replaces the node's id. The bag holds the id too.
    """
    each = documents.select(F.col("seq").alias("_doc"), F.posexplode("nodes").alias("_at", "_node"))
    bag = F.coalesce(F.col("_node.properties"), F.create_map().cast("map<string,string>"))
    given = F.try_element_at(bag, F.lit("id"))
    plain = F.coalesce(F.try_variant_get(F.try_parse_json(given), "$", "string"), given)
    identity = F.coalesce(plain, F.col("_node.id"))
    rest = F.map_filter(bag, lambda k, _: k != "id")
    own = F.create_map(F.lit("id"), F.coalesce(given, json_text(F.col("_node.id"), T.StringType())))
    nodes = each.select(
        F.col("_node.type").alias("label"), identity.alias("id"), F.map_concat(own, rest).alias("props"),
        _position("_doc", "_at"),
    )
    if not include_source:
        return nodes
    sources = _sources(documents).select(
        F.lit(SOURCE_LABEL).alias("label"), F.concat(F.lit(SOURCE_KEY), "_source").alias("id"),
        F.create_map(
            F.lit("source"), json_text(F.col("_source"), T.StringType()),
            F.lit("content"), json_text(F.substring(F.col("source.content"), 1, EXCERPT), T.StringType()),
        ).alias("props"),
        F.struct(F.col("seq").alias("doc"), F.lit(1 << 40).cast("bigint").alias("at")).alias("seq"),
    )
    return nodes.unionByName(sources)


def _sources(documents: DataFrame) -> DataFrame:
    name = F.coalesce(F.get_json_object(F.col("source.metadata"), "$.source"), F.lit(UNKNOWN_SOURCE))
    return documents.filter(F.col("source").isNotNull()).withColumn("_source", name)


def edge_writes(documents: DataFrame, include_source: bool = False) -> DataFrame:
    """Edge upserts in document order; the bag holds both end ids."""
    each = documents.select(F.col("seq").alias("_doc"), F.posexplode("rels").alias("_at", "_rel"))
    bag = F.coalesce(F.col("_rel.properties"), F.create_map().cast("map<string,string>"))
    rest = F.map_filter(bag, lambda k, _: ~k.isin("src_id", "tgt_id"))
    own = F.create_map(
        F.lit("src_id"), F.coalesce(F.try_element_at(bag, F.lit("src_id")), json_text(F.col("_rel.src_id"), T.StringType())),
        F.lit("tgt_id"), F.coalesce(F.try_element_at(bag, F.lit("tgt_id")), json_text(F.col("_rel.dst_id"), T.StringType())),
    )
    edges = each.select(
        F.col("_rel.type").alias("type"),
        F.col("_rel.src_type").alias("src_label"), F.col("_rel.src_id").alias("src_id"),
        F.col("_rel.dst_type").alias("dst_label"), F.col("_rel.dst_id").alias("dst_id"),
        F.map_concat(own, rest).alias("props"), _position("_doc", "_at"),
    )
    if not include_source:
        return edges
    mentions = _sources(documents).select("seq", "_source", F.posexplode("nodes").alias("_at", "_node"))
    links = mentions.select(
        F.lit(SOURCE_EDGE).alias("type"), F.lit(SOURCE_LABEL).alias("src_label"), F.concat(F.lit(SOURCE_KEY), "_source").alias("src_id"),
        F.col("_node.type").alias("dst_label"), F.col("_node.id").alias("dst_id"),
        F.create_map().cast("map<string,string>").alias("props"),
        F.struct(F.col("seq").alias("doc"), (F.lit(1 << 40) + F.col("_at")).cast("bigint").alias("at")).alias("seq"),
    )
    return edges.unionByName(links)


def with_existing_ends(writes: DataFrame, first_seen: DataFrame) -> DataFrame:
    """Edge writes whose two ends exist by the time of their document.

    ``first_seen`` has ``label, id, first_doc`` (null: stored before). Both
    joins read written tables, so that a hub's edges can be split.
    """
    source = first_seen.select(
        F.col("label").alias("src_label"), F.col("id").alias("src_id"), F.col("first_doc").alias("_src_doc")
    )
    target = first_seen.select(
        F.col("label").alias("dst_label"), F.col("id").alias("dst_id"), F.col("first_doc").alias("_dst_doc")
    )
    joined = writes.join(source, ["src_label", "src_id"]).join(target, ["dst_label", "dst_id"])
    soon_enough = (F.coalesce(F.col("_src_doc") <= F.col("seq.doc"), F.lit(True))) & (
        F.coalesce(F.col("_dst_doc") <= F.col("seq.doc"), F.lit(True))
    )
    return joined.filter(soon_enough).select(*writes.columns)


def writes(documents: DataFrame, include_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """Node and edge upserts, written once: all later steps read them several times."""
    return (
        cut_lineage(node_writes(documents, include_source), "node-writes"),
        cut_lineage(edge_writes(documents, include_source), "edge-writes"),
    )


def end_keys(edges: DataFrame) -> DataFrame:
    """Distinct ``label, id`` of both ends."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src_label").alias("label"), F.col("src_id").alias("id")),
            F.struct(F.col("dst_label").alias("label"), F.col("dst_id").alias("id")),
        )
    ).alias("_end")
    return edges.select(ends).select("_end.label", "_end.id").distinct()


def first_seen(new_nodes: DataFrame, stored: DataFrame | None) -> DataFrame:
    """First document of every node, null for stored ones: ``label, id, first_doc``.

    Written, so that both end joins shuffle a table, where AQE can split hubs.
    """
    seen = new_nodes.select(*NODE_KEY, F.col("seq.doc").alias("doc"))
    if stored is not None:
        seen = seen.unionByName(stored.select(*NODE_KEY, F.lit(None).cast("bigint").alias("doc")))
    was_stored = F.bool_or(F.col("doc").isNull())
    seen = seen.groupBy(*NODE_KEY).agg(F.min("doc").alias("_doc"), was_stored.alias("_stored"))
    return cut_lineage(seen.select(*NODE_KEY, F.when(~F.col("_stored"), F.col("_doc")).alias("first_doc")), "first-seen")


def merge_documents(
    documents: DataFrame,
    nodes: DataFrame | None = None,
    edges: DataFrame | None = None,
    *,
    include_source: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Graph of bags after upserting graph documents: all nodes and all edges.

    Documents count as processed in ``seq`` order: later writes win per
    property, and an edge is created only if both ends are stored or appear in
    the same or an earlier document.
    """
    new_nodes, new_edges = writes(documents, include_source)
    stored = None
    if nodes is not None:
        stored = nodes.select(*NODE_KEY).join(end_keys(new_edges), list(NODE_KEY), "left_semi")
    new_edges = with_existing_ends(new_edges, first_seen(new_nodes, stored))
    return overlay(nodes, new_nodes, NODE_KEY), overlay(edges, new_edges, EDGE_KEY)


def changed_rows(
    documents: DataFrame, find_nodes: Lookup, find_edges: Lookup, *, include_source: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The nodes and edges that graph documents touch, as they are afterwards.

    ``find_nodes`` and ``find_edges`` return the stored rows of a frame of
    keys, so that a large store is never read as a whole.
    """
    new_nodes, new_edges = writes(documents, include_source)
    stored = find_nodes(end_keys(new_edges))
    new_edges = with_existing_ends(new_edges, first_seen(new_nodes, stored))
    new_edges = cut_lineage(new_edges, "edges-with-ends")
    old_nodes = find_nodes(new_nodes.select(*NODE_KEY).distinct())
    old_edges = find_edges(new_edges.select(*EDGE_KEY).distinct())
    return overlay(old_nodes, new_nodes, NODE_KEY), overlay(old_edges, new_edges, EDGE_KEY)
