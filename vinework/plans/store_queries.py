"""Stores, layouts and entities: created, reopened, replaced and read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vinework.functions.embed import length_embedder
from vinework.operators.pattern import path_values, paths
from vinework.operators.rag import expand
from vinework.plans.inputs import commerce_graph, link_graph, table
from vinework.plans.registry import query
from vinework.runtime import shared_dir
from vinework.sources import collection as docs
from vinework.sources.collection import CollectionStore
from vinework.sources.graph import GraphStore
from vinework.sources.layout import cluster_by_properties, cluster_by_property
from vinework.streaming.upsert import stream_graph


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/vinework/{name}-{uuid.uuid4().hex}"


_TURNS_SQL = """SELECT 'Turn' AS label, conv_id || ':' || turn AS id FROM conversations
  UNION ALL SELECT DISTINCT 'Speaker', role FROM conversations"""


@query("graph_store_cycle", _TURNS_SQL)
def graph_store_cycle(spark, sf_dir):
    """A graph is created, filled, dropped, created again and filled; creating what exists changes nothing."""
    documents = _turns(table(spark, sf_dir, "conversations"))
    store = GraphStore(spark, _place(spark, "graph"), buckets=4).create()
    store.merge(documents.filter("seq % 2 = 1"))
    store.drop()
    store.create().merge(documents)
    return store.create().nodes().select("label", "id")


@query("graph_stream", _TURNS_SQL)
def graph_stream(spark, sf_dir):
    """The same graph from a stream of documents."""
    path, turns = _place(spark, "graph"), table(spark, sf_dir, "conversations")
    arriving = spark.readStream.schema(turns.schema).parquet(f"{sf_dir}/conversations.parquet*")
    store = GraphStore(spark, f"{path}/store", buckets=4).create()
    stream_graph(_turns(arriving), store, f"{path}/checkpoint").awaitTermination()
    return store.nodes().select("label", "id")


def _turns(conversations):
    """Conversation turns as graph documents: a turn and its speaker."""
    bag = F.create_map().cast("map<string,string>")
    key = F.concat_ws(":", "conv_id", "turn")
    turn = F.struct(key.alias("id"), F.lit("Turn").alias("type"), bag.alias("properties"))
    speaker = F.struct(F.col("role").alias("id"), F.lit("Speaker").alias("type"), bag.alias("properties"))
    rels = F.from_json(F.lit("[]"), "array<struct<src_id:string,src_type:string,dst_id:string,dst_type:string,type:string,properties:map<string,string>>>")
    source = F.lit(None).cast("struct<content:string,metadata:string>")
    return conversations.select(
        (F.col("conv_id") * (1 << 20) + F.col("turn")).alias("seq"), F.array(turn, speaker).alias("nodes"), rels.alias("rels"), source.alias("source")
    )

@query("collection_replace", "SELECT item_id::VARCHAR AS id, md5(text) AS content FROM benchmark")
def collection_replace(spark, sf_dir):
    """A collection of documents is emptied, filled with passages and opened again."""
    path = _place(spark, "collection")
    options = {"buckets": 4}
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("content"))
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), F.col("text").alias("content"))
    store = CollectionStore.from_documents(spark, path, parts, **options)
    store.create(replace=True).add(items)
    return CollectionStore.open(spark, path, **options).read().select("id", F.md5(F.col("content").cast("binary")).alias("content"))


@query(
    "collection_of_embedded_nodes",
    """SELECT ((3::BIGINT << 48) + p_partkey)::VARCHAR AS id, p_name AS content,
              round((length(p_name) % 4) / 4.0, 6)::DOUBLE AS first, round(((length(p_name) + 3) % 4) / 4.0, 6)::DOUBLE AS last
       FROM part WHERE trim(p_name) <> ''""",
)
def collection_of_embedded_nodes(spark, sf_dir):
    """Graph nodes become documents with vectors, twice; the second time replaces the first."""
    nodes = commerce_graph(spark, sf_dir, ["Part"], []).nodes("Part")
    store = CollectionStore(spark, _place(spark, "nodes"), length_embedder, buckets=4).create()
    store.add_nodes(nodes.withColumn("p_name", F.upper("p_name")), "Part", ["p_name"])
    store.add_nodes(nodes, "Part", ["p_name"])
    ends = (F.element_at("embedding", at).cast("double").alias(name) for at, name in ((1, "first"), (-1, "last")))
    return store.read().select("id", "content", *ends)


@query("indexed_lookup", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 7")
def indexed_lookup(spark, sf_dir):
    """A label's table laid out for look-ups on one property, by range and then by Bloom filter."""
    customers = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey"))
    ranged, filtered = _place(spark, "ranged"), _place(spark, "bloom")
    cluster_by_property(customers, "c_nationkey", ranged, index="range", files=4)
    cluster_by_property(spark.read.parquet(ranged), "c_mktsegment", filtered, index="bloom")
    return spark.read.parquet(filtered).filter("c_mktsegment = 'MACHINERY' AND c_nationkey = 7").select("c_custkey", "c_name")


@query(
    "zorder_lookup",
    """SELECT c_custkey, c_name, 'box' AS found FROM customer WHERE c_nationkey BETWEEN 5 AND 8 AND c_acctbal BETWEEN 1000 AND 3000
       UNION ALL SELECT c_custkey, c_name, 'pair' FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'MACHINERY'""",
)
def zorder_lookup(spark, sf_dir):
    """Look-ups on several properties of a table in Z-order."""
    customers, path = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey")), _place(spark, "zorder")
    cluster_by_properties(customers, ["c_nationkey", "c_acctbal", "c_mktsegment"], path, files=16)
    stored = spark.read.parquet(path)
    box = stored.filter("c_nationkey BETWEEN 5 AND 8 AND c_acctbal BETWEEN 1000 AND 3000").select("c_custkey", "c_name", F.lit("box").alias("found"))
    pair = stored.filter("c_nationkey = 7 AND c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name", F.lit("pair").alias("found"))
    return box.unionByName(pair)


_NEIGHBOURS = """
  SELECT n_nationkey, 'IN_NATION' AS rel_type, 'in' AS direction, 'Customer' AS label, c_name AS name FROM nation JOIN customer ON c_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey, 'IN_NATION', 'in', 'Supplier', s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey, 'IN_REGION', 'out', 'Region', r_name FROM nation JOIN region ON r_regionkey = n_regionkey"""


def _neighbours(spark, sf_dir, context=None):
    graph = commerce_graph(spark, sf_dir, ["Customer", "Supplier", "Region"], ["IN_NATION", "IN_REGION"])
    nations = commerce_graph(spark, sf_dir, ["Nation"], []).nodes("Nation").select("n_nationkey", F.col("id").alias("node_id"))
    found = expand(nations, graph, entities=True, context=context)
    name = F.coalesce(*[F.try_element_at("neighbour.properties", F.lit(k)) for k in ("c_name", "s_name", "r_name")])
    return found.select("n_nationkey", "rel_type", "direction", F.col("neighbour.label").alias("label"), name.alias("name"))


@query("rag_neighbours", _NEIGHBOURS)
def rag_neighbours(spark, sf_dir):
    """Nations expanded both ways, with the properties of their neighbours."""
    return _neighbours(spark, sf_dir)


@query("rag_context", f"SELECT * FROM ({_NEIGHBOURS}) WHERE direction = 'out'")
def rag_context(spark, sf_dir):
    """The same with a hook on the expanded context."""
    return _neighbours(spark, sf_dir, lambda found: found.filter("direction = 'out'"))


@query(
    "path_entities",
    """WITH n AS (SELECT count(*) AS n FROM customer),
         links AS (
           SELECT c_custkey * 2 AS id, c_custkey AS s, (c_custkey * 7 + 13) % n AS t FROM customer, n
           UNION ALL SELECT c_custkey * 2 + 1, c_custkey, (c_custkey * 13 + 7) % n FROM customer, n)
       SELECT a.s AS start_id, b.t AS end_id, concat_ws('>', x.c_name, 'LINKS ' || a.id, y.c_name, 'LINKS ' || b.id, z.c_name) AS path
       FROM links a JOIN links b ON a.t = b.s AND a.id <> b.id
       JOIN customer x ON x.c_custkey = a.s JOIN customer y ON y.c_custkey = b.s JOIN customer z ON z.c_custkey = b.t""",
)
def path_entities(spark, sf_dir):
    """Walks of two links as path values: nodes and edges in turn."""
    graph = link_graph(spark, sf_dir)
    values = path_values(graph, "LINKS", paths(graph, "LINKS", 2))
    name = lambda x: F.try_element_at(x["properties"], F.lit("c_name"))
    shown = F.transform("path", lambda x: F.when(x["start_id"].isNull(), name(x)).otherwise(F.concat_ws(" ", x["label"], x["id"])))
    whole = values.filter(F.size("path") == 5)
    return whole.select("start_id", "end_id", F.array_join(shown, ">").alias("path"))
