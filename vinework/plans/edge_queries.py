"""Inputs that are easy to get wrong: restricted schemas, names that meet, promoted keys, repeated ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from vinework.functions.filters import MetadataFilter
from vinework.operators import merge, schema
from vinework.plans.inputs import commerce_graph, table
from vinework.plans.registry import query
from vinework.plans.write_queries import bag_text
from vinework.sources import collection

_NO_EDGES = "chr(10) || chr(10) || 'Relationship types and properties:'"
_NO_TRIPLES = "chr(10) || chr(10) || 'Relationship patterns:'"


@query(
    "schema_one_label",
    f"""SELECT 'Node labels and properties:' || chr(10) || '  :Customer {{' || string_agg(column_name, ', ' ORDER BY column_name) || '}}'
          || {_NO_EDGES} || {_NO_TRIPLES} AS schema_text
        FROM (DESCRIBE customer)""",
)
def schema_one_label(spark, sf_dir):
    return schema.describe(commerce_graph(spark, sf_dir), include=["Customer"])


@query(
    "schema_one_type",
    f"""SELECT 'Node labels and properties:' || {_NO_EDGES} || chr(10) || '  [:PLACED] {{o_orderdate}}'
          || {_NO_TRIPLES} || chr(10) || '  (:Customer)-[:PLACED]->(:Order)' AS schema_text
        FROM orders HAVING count(*) > 0""",
)
def schema_one_type(spark, sf_dir):
    return schema.describe(commerce_graph(spark, sf_dir), include=["PLACED"])


@query(
    "source_beside_user_node",
    """SELECT 'user' AS kind, source AS name, count(*)::BIGINT AS n FROM documents GROUP BY source
       UNION ALL SELECT 'source', source, 1 FROM (SELECT DISTINCT source FROM documents)
       UNION ALL SELECT 'link', source, 1 FROM (SELECT DISTINCT source FROM documents)""",
)
def source_beside_user_node(spark, sf_dir):
    """Every document names its source, and has a node of the source's label with the same id."""
    bag = F.create_map(F.concat(F.lit("doc"), "doc_id"), F.lit("1"))
    node = F.struct(F.col("source").alias("id"), F.lit(merge.SOURCE_LABEL).alias("type"), bag.alias("properties"))
    rels = F.from_json(F.lit("[]"), "array<struct<src_id:string,src_type:string,dst_id:string,dst_type:string,type:string,properties:map<string,string>>>")
    source = F.struct(F.col("text").alias("content"), F.to_json(F.struct("source")).alias("metadata"))
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.array(node).alias("nodes"), rels.alias("rels"), source.alias("source")
    )
    nodes, edges = merge.merge_documents(documents, include_source=True)
    own = F.size(F.filter(F.map_keys("props"), lambda k: k.startswith("doc"))).cast("bigint")
    is_source = F.startswith(F.col("id"), F.lit(merge.SOURCE_KEY))
    name = F.replace(F.col("id"), F.lit(merge.SOURCE_KEY), F.lit(""))
    found = nodes.select(
        F.when(is_source, "source").otherwise("user").alias("kind"), name.alias("name"), F.when(is_source, F.lit(1).cast("bigint")).otherwise(own).alias("n")
    )
    links = edges.select(F.lit("link").alias("kind"), F.col("dst_id").alias("name"), F.lit(1).cast("bigint").alias("n"))
    return found.unionByName(links)


@query(
    "unnamed_property",
    """SELECT c_nationkey::VARCHAR AS id, '=' || arg_max(c_mktsegment, c_custkey) || ';name=' || arg_max(c_name, c_custkey) AS props
       FROM customer GROUP BY c_nationkey""",
)
def unnamed_property(spark, sf_dir):
    """A property may have the name ""."""
    writes = table(spark, sf_dir, "customer").select(
        F.lit("Nation").alias("label"), F.col("c_nationkey").cast("string").alias("id"),
        F.create_map(F.lit(""), "c_mktsegment", F.lit("name"), "c_name").alias("props"),
        F.col("c_custkey").alias("seq"),
    )
    return merge.overlay(None, writes, merge.NODE_KEY).select("id", bag_text(F.col("props")).alias("props"))


@query(
    "promoted_presence",
    """SELECT c_custkey, 'exists' AS test FROM customer WHERE c_custkey % 3 <> 0
       UNION ALL SELECT c_custkey, 'like' FROM customer WHERE c_custkey % 3 = 1 AND c_nationkey = 1
       UNION ALL SELECT c_custkey, 'above' FROM customer WHERE c_custkey % 3 = 1 AND c_nationkey > 20""",
)
def promoted_presence(spark, sf_dir):
    """Typed columns for metadata keys change no answer: absent, null and present keys, text patterns, numbers."""
    key = F.col("c_custkey") % 3
    bag = F.when(key == 0, "{}").when(key == 1, F.to_json(F.struct(F.col("c_nationkey").alias("n")))).otherwise('{"n": null}')
    rows = table(spark, sf_dir, "customer").select("c_custkey", bag.alias("metadata"), F.when(key == 1, F.col("c_nationkey").cast("double")).alias("n"))
    filters = MetadataFilter(promoted={"n": "n"})
    tests = {"exists": {"n": {"$exists": True}}, "like": {"n": {"$like": "1"}}, "above": {"n": {"$gt": 20}}}
    parts = [rows.filter(filters.compile(spec)).select("c_custkey", F.lit(name).alias("test")) for name, spec in tests.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "repeated_ids_last_wins",
    "SELECT user_id::VARCHAR AS id, arg_max(props, event_id) AS content FROM events GROUP BY user_id",
)
def repeated_ids_last_wins(spark, sf_dir):
    """Of a batch with repeated ids, the row with the highest seq stays."""
    batch = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), F.col("props").alias("content"), F.col("event_id").alias("seq")
    )
    return collection.last_of_batch(batch).select("id", "content")
