"""Graphs, collections and query batches derived from the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vinework.runtime import shared_dir
from vinework.sources.graph import PropertyGraph, graph_id, text_id

LABEL_NO = {"Customer": 1, "Order": 2, "Part": 3, "Supplier": 4, "Nation": 5, "Region": 6}


# Columns of the driver tables. Naming them saves one footer
# job per table; Parquet checks the types when it reads.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach."""
    return f"{shared_dir(spark)}/vinework/{name}-{uuid.uuid4().hex}"


def node_id(label: str, key: str) -> Column:
    return graph_id(LABEL_NO[label], F.col(key))


def commerce_graph(
    spark: SparkSession, sf_dir: str, labels: Sequence[str] | None = None, types: Sequence[str] | None = None
) -> PropertyGraph:
    """Customers, orders, parts, suppliers, nations and regions.

    ``labels`` and ``types`` name the frames that are opened; default is all.
    """

    def nodes(name: str, label: str, key: str) -> DataFrame:
        return table(spark, sf_dir, name).withColumn("id", node_id(label, key))

    def edges(name: str, edge_type: str, keys: list, src: str, src_key: str, dst: str, dst_key: str, *props: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            text_id(edge_type, F.concat_ws(":", *keys)).alias("id"),
            node_id(src, src_key).alias("start_id"), node_id(dst, dst_key).alias("end_id"),
            F.lit(src).alias("src_label"), F.lit(dst).alias("dst_label"), *props,
        )

    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    node_sources = {
        "Customer": lambda: nodes("customer", "Customer", "c_custkey"),
        "Order": lambda: nodes("orders", "Order", "o_orderkey"),
        "Part": lambda: nodes("part", "Part", "p_partkey"),
        "Supplier": lambda: nodes("supplier", "Supplier", "s_suppkey"),
        "Nation": lambda: nodes("nation", "Nation", "n_nationkey"),
        "Region": lambda: nodes("region", "Region", "r_regionkey"),
    }
    edge_sources = {
        "PLACED": lambda: edges("orders", "PLACED", ["o_orderkey"], "Customer", "o_custkey", "Order", "o_orderkey", "o_orderdate"),
        "CONTAINS": lambda: edges("lineitem", "CONTAINS", line, "Order", "l_orderkey", "Part", "l_partkey", "l_quantity"),
        "SUPPLIED_BY": lambda: edges("lineitem", "SUPPLIED_BY", line, "Part", "l_partkey", "Supplier", "l_suppkey"),
        "IN_NATION": lambda: edges(
            "customer", "IN_NATION", [F.lit("c"), "c_custkey"], "Customer", "c_custkey", "Nation", "c_nationkey"
        ).unionByName(
            edges("supplier", "IN_NATION", [F.lit("s"), "s_suppkey"], "Supplier", "s_suppkey", "Nation", "s_nationkey")
        ),
        "IN_REGION": lambda: edges("nation", "IN_REGION", ["n_nationkey"], "Nation", "n_nationkey", "Region", "n_regionkey"),
    }
    return PropertyGraph(
        {n: make() for n, make in node_sources.items() if labels is None or n in labels},
        {n: make() for n, make in edge_sources.items() if types is None or n in types},
    )


def link_graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Customers linked in a ring-like graph of out-degree two."""
    customer = table(spark, sf_dir, "customer")
    n = customer.count()
    key = F.col("c_custkey")
    ends = F.explode(
        F.array(
            F.struct((key * 2).alias("id"), ((key * 7 + 13) % n).alias("end_id")),
            F.struct((key * 2 + 1).alias("id"), ((key * 13 + 7) % n).alias("end_id")),
        )
    ).alias("_e")
    links = customer.select(key.alias("start_id"), ends).select(
        F.col("_e.id").alias("id"), "start_id", F.col("_e.end_id").alias("end_id"),
        F.lit("Customer").alias("src_label"), F.lit("Customer").alias("dst_label"),
    )
    return PropertyGraph({"Customer": customer.withColumn("id", key)}, {"LINKS": links})


# The link graph as SQL, for use in front of a check.
LINKS_SQL = """
  total AS (SELECT count(*) AS n FROM customer),
  links AS (
    SELECT 2 * c_custkey AS id, c_custkey AS s, (7 * c_custkey + 13) % n AS t FROM customer, total
    UNION ALL
    SELECT 2 * c_custkey + 1, c_custkey, (13 * c_custkey + 7) % n FROM customer, total)
"""


def relay_graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    """Customer -> order -> other customer, one edge type through two labels."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    n = customer.count()
    here, order = node_id("Customer", "o_custkey"), node_id("Order", "o_orderkey")
    other = graph_id(LABEL_NO["Customer"], (F.col("o_custkey") * 7 + 13) % n)
    hop = F.explode(
        F.array(
            F.struct(here.alias("s"), order.alias("t"), F.lit("Customer").alias("sl"), F.lit("Order").alias("tl"), F.lit("a").alias("k")),
            F.struct(order.alias("s"), other.alias("t"), F.lit("Order").alias("sl"), F.lit("Customer").alias("tl"), F.lit("b").alias("k")),
        )
    ).alias("h")
    steps = orders.select("o_orderkey", hop).select(
        F.concat_ws(":", "o_orderkey", "h.k").alias("id"), F.col("h.s").alias("start_id"), F.col("h.t").alias("end_id"),
        F.col("h.sl").alias("src_label"), F.col("h.tl").alias("dst_label"),
    )
    return PropertyGraph(
        {
            "Customer": customer.withColumn("id", node_id("Customer", "c_custkey")),
            "Order": orders.withColumn("id", node_id("Order", "o_orderkey")),
        },
        {"STEP": steps},
    )


def metadata_text() -> Column:
    """Metadata of a document joined to its label.

    ``quality`` is absent without a label and JSON null for toxic documents.
    """
    quality = (
        F.when(F.col("quality").isNull(), F.lit(""))
        .when(F.col("toxic") == 1, F.lit(', "quality": null'))
        .otherwise(F.concat(F.lit(', "quality": '), F.col("quality").cast("string")))
    )
    return F.concat(
        F.lit('{"lang": "'), "lang", F.lit('", "source": "'), "source", F.lit('", "n_chars": '),
        F.col("n_chars").cast("string"), quality, F.lit("}"),
    )


def collection(spark: SparkSession, sf_dir: str, vectors: bool = True) -> DataFrame:
    """Documents with the embedding of the same number; many have none."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    if vectors:
        known = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
        rows = rows.join(known, "doc_id", "left")
    return rows.select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), *(["embedding"] if vectors else []),
        metadata_text().alias("metadata"), "lang", "source", "n_chars",
    )


# The collection as SQL, for use in front of a check.
COLLECTION_SQL = """
  collection AS (
    SELECT d.doc_id AS id, d.text AS content, e.embedding::DOUBLE[] AS embedding, d.lang, d.source, d.n_chars,
           '{"lang": "' || d.lang || '", "source": "' || d.source || '", "n_chars": ' || d.n_chars
           || CASE WHEN l.quality IS NULL THEN '' WHEN l.toxic = 1 THEN ', "quality": null'
                   ELSE ', "quality": ' || l.quality END || '}' AS metadata
    FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


def scaled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of length 1, 2 or 3, so that the metrics rank differently."""
    rows = table(spark, sf_dir, "embeddings")
    factor = (F.col("vec_id") % 3 + 1).cast("double")
    return rows.select(
        F.col("vec_id").alias("id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x * factor).alias("embedding"),
        "label",
    )


SCALED_SQL = """
  scaled AS (SELECT vec_id AS id, label, [x::DOUBLE * (1 + vec_id % 3) FOR x IN embedding] AS embedding FROM embeddings)
"""


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean embedding per label: ``qid, embedding``."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = rows.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    gathered = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_v"))
    return gathered.select(F.col("label").alias("qid"), F.transform("_v", lambda v: v["x"]).alias("embedding"))


CENTRES_SQL = """
  centres AS (
    SELECT label AS qid, list(x ORDER BY pos) AS embedding
    FROM (SELECT label, pos, avg(x) AS x
          FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
          GROUP BY label, pos)
    GROUP BY label)
"""


def benchmark_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per benchmark item: its whole text."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the vector of the item's number, for items that have one."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")
    return benchmark_texts(spark, sf_dir).join(vectors, "qid")


BENCHMARK_SQL = r"""
  asked AS (SELECT DISTINCT item_id AS qid, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
  asked_n AS (SELECT qid, count(*) AS n_terms FROM asked GROUP BY qid),
  words AS (
    SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos, len(toks) AS n
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS toks FROM documents))
"""
