"""Value handling, query-log checks, profiles and question contexts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vinework.functions import querylog, values
from vinework.operators import sketches
from vinework.operators.profile import latency_profile
from vinework.operators.rag import question_context
from vinework.plans.inputs import commerce_graph, scratch_path, table
from vinework.plans.registry import query


@query("json_extract", "SELECT event_id, props->>'k' AS k, props->>'missing' AS missing FROM events")
def json_extract(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", values.json_value(props, "k").alias("k"), values.json_value(props, "missing").alias("missing")
    )


@query("json_keys", "SELECT event_type, k, count(*) AS n FROM (SELECT event_type, unnest(json_keys(props)) AS k FROM events) GROUP BY 1, 2")
def json_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "events").select("event_type", F.explode(values.bag_keys(F.col("props"))).alias("k"))
    return keys.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("excerpt", "SELECT doc_id, substring(text, 1, 500) AS excerpt FROM documents")
def excerpt(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.excerpt(F.col("text")).alias("excerpt"))


@query(
    "sanitise_text",
    """SELECT doc_id, md5(CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || '…' ELSE text END) AS text,
              'lang' AS keys, md5(CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || '…' ELSE text END) AS nested
       FROM documents""",
)
def sanitise_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.create_map(F.lit("lang"), "lang", F.lit("_source"), "source").alias("bag"),
        F.array(F.struct("text", F.lit(1).alias("_n"))).alias("nested"), F.lit(0).alias("_internal"),
    )
    clean = values.sanitise_frame(rows)
    return clean.select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text"), F.array_join(F.map_keys("bag"), ",").alias("keys"),
        F.md5(F.col("nested")[0]["text"].cast("binary")).alias("nested"),
    )


def _log(spark, sf_dir):
    """A query log with one line per order; the priority decides its form."""
    key = F.col("o_orderkey").cast("string")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("MATCH (o:Order {k: "), key, F.lit("}) RETURN o.total AS total, o.status LIMIT 5")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("```\nmatch (c)-[r]->(o) return c, count(o) as n order by n\n```\n// "), key))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("  MATCH (n) WHERE n.k = $$"), key, F.lit("$$ RETURN n")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(F.lit("please show order "), key))
        .otherwise(F.lit(" \t\n"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("q"))


_LOG_SQL = r"""
  log AS (
    SELECT o_orderkey, CASE o_orderpriority
      WHEN '1-URGENT' THEN 'MATCH (o:Order {k: ' || o_orderkey || '}) RETURN o.total AS total, o.status LIMIT 5'
      WHEN '2-HIGH' THEN '```' || chr(10) || 'match (c)-[r]->(o) return c, count(o) as n order by n' || chr(10) || '```' || chr(10) || '// ' || o_orderkey
      WHEN '3-MEDIUM' THEN '  MATCH (n) WHERE n.k = $$' || o_orderkey || '$$ RETURN n'
      WHEN '4-NOT SPECIFIED' THEN 'please show order ' || o_orderkey
      ELSE ' ' || chr(9) || chr(10) END AS q FROM orders)"""
_CHECK_SQL = rf"""CASE WHEN regexp_full_match(q, '\s*') THEN '{querylog.EMPTY}' WHEN contains(q, '$$') THEN '{querylog.DOLLARS.replace("'", "''")}'
  WHEN NOT regexp_matches(q, '(?i)\b({"|".join(querylog.CLAUSES)})\b') THEN '{querylog.NO_CLAUSE}' END"""


@query("query_log_check", f"WITH {_LOG_SQL} SELECT o_orderkey, {_CHECK_SQL} AS problem FROM log")
def query_log_check(spark, sf_dir):
    return _log(spark, sf_dir).select("o_orderkey", querylog.check_query(F.col("q")).alias("problem"))


@query("query_log_chat", f"WITH log AS (SELECT conv_id, turn, text AS q FROM conversations) SELECT conv_id, turn, {_CHECK_SQL} AS problem FROM log")
def query_log_chat(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", querylog.check_query(F.col("text")).alias("problem"))


@query(
    "return_columns",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'total,status' WHEN '2-HIGH' THEN 'c,n'
                               WHEN '3-MEDIUM' THEN 'n' ELSE 'result' END AS names FROM orders""",
)
def return_columns(spark, sf_dir):
    return _log(spark, sf_dir).select("o_orderkey", F.array_join(querylog.return_columns(F.col("q")), ",").alias("names"))


@query(
    "fence_strip",
    rf"""WITH {_LOG_SQL} SELECT o_orderkey, CASE WHEN starts_with(q, '```')
           THEN 'match (c)-[r]->(o) return c, count(o) as n order by n' || chr(10) || '// ' || o_orderkey
           ELSE regexp_replace(q, '^\s+|\s+$', '', 'g') END AS q FROM log""",
)
def fence_strip(spark, sf_dir):
    return _log(spark, sf_dir).select("o_orderkey", querylog.strip_fences(F.col("q")).alias("q"))


@query(
    "tagged_text_parse",
    """SELECT c_custkey, 'vertex' AS form, 'object' AS kind, c_name AS name, NULL AS num FROM customer
       UNION ALL SELECT c_custkey, 'number', 'number', NULL, c_acctbal FROM customer
       UNION ALL SELECT c_custkey, 'text', 'text', c_mktsegment, NULL FROM customer
       UNION ALL SELECT c_custkey, 'path', 'array', NULL, NULL FROM customer
       UNION ALL SELECT c_custkey, 'flag', 'boolean', NULL, NULL FROM customer""",
)
def tagged_text_parse(spark, sf_dir):
    vertex = F.concat(
        F.lit('{"id": '), "c_custkey", F.lit(', "label": "Customer", "properties": {"name": "'), "c_name", F.lit('"}}::vertex')
    )
    forms = F.array(
        F.struct(F.lit("vertex").alias("form"), vertex.alias("t")),
        F.struct(F.lit("number").alias("form"), F.concat(F.lit(" "), F.col("c_acctbal").cast("decimal(12,2)"), F.lit("::FLOAT ")).alias("t")),
        F.struct(F.lit("text").alias("form"), F.col("c_mktsegment").alias("t")),
        F.struct(F.lit("path").alias("form"), F.concat(F.lit("["), "c_custkey", F.lit(", 1]::path")).alias("t")),
        F.struct(F.lit("flag").alias("form"), F.when(F.col("c_acctbal") > 0, "true::boolean").otherwise("false").alias("t")),
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(forms).alias("f"))
    parsed = rows.select("c_custkey", "f.form", values.parse_tagged(F.col("f.t")).alias("p"))
    name = F.when(F.col("p.kind") == "text", F.col("p.raw")).otherwise(F.try_variant_get("p.value", "$.properties.name", "string"))
    number = F.when(F.col("p.kind") == "number", F.try_variant_get("p.value", "$", "double"))
    return parsed.select("c_custkey", "form", F.col("p.kind").alias("kind"), name.alias("name"), number.alias("num"))


_PROFILE_SQL = """
  WITH r AS (SELECT {g}value, row_number() OVER ({p} ORDER BY value) - 1 AS pos, count(*) OVER ({p}) AS n FROM events)
  SELECT {g}any_value(n) AS n, median(value) AS p50, max(value) FILTER (pos = least(floor(n * 0.99), n - 1)) AS p99,
         round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM r {b}"""


@query("latency_profile", _PROFILE_SQL.format(g="event_type, ", p="PARTITION BY event_type", b="GROUP BY event_type"))
def latency_profile_query(spark, sf_dir):
    return latency_profile(table(spark, sf_dir, "events"), "value", "event_type").withColumn("mean", F.round("mean", 6))


@query("latency_profile_total", _PROFILE_SQL.format(g="", p="", b=""))
def latency_profile_total(spark, sf_dir):
    return latency_profile(table(spark, sf_dir, "events"), "value").withColumn("mean", F.round("mean", 6))


@query(
    "context_topk",
    """SELECT conv_id, string_agg('{"role":"' || role || '","chars":' || length(text) || '}', ' ' ORDER BY turn) AS context
       FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations) WHERE i <= 3 GROUP BY conv_id""",
)
def context_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    found = question_context(rows, 3, question_col="conv_id", order_col="turn")
    return found.select("conv_id", F.array_join("context", " ").alias("context"))


@query(
    "degree_profile",
    """WITH d AS (SELECT c_mktsegment, count(*) AS value FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment)
       SELECT c_mktsegment, count(*) AS n, median(value) AS p50, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max
       FROM d GROUP BY 1""",
)
def degree_profile(spark, sf_dir):
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("value"))
    joined = counts.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return latency_profile(joined, "value", "c_mktsegment").drop("p99").withColumn("mean", F.round("mean", 6))


_ENDS = {"PLACED": ("orders", "o_orderkey"), "CONTAINS": ("lineitem", "l_partkey"), "SUPPLIED_BY": ("lineitem", "l_suppkey")}


@query(
    "distinct_ends_sketch",
    " UNION ALL ".join(f"SELECT '{t}' AS type, count(DISTINCT {c}) AS n, TRUE AS within FROM {f}" for t, (f, c) in _ENDS.items()),
)
def distinct_ends_sketch(spark, sf_dir):
    """Distinct ends per edge type: exact, and whether the sketches of four batches, merged, are within their bound."""
    ends = commerce_graph(spark, sf_dir, types=list(_ENDS)).edge_ends().select("type", "end_id", F.pmod(F.xxhash64("id"), F.lit(4)).alias("batch"))
    store = sketches.SketchTable(spark, scratch_path(spark, "sketches"), "type string")
    for batch in range(4):
        store.put(str(batch), sketches.distinct_sketches(ends.filter(F.col("batch") == batch), ["type"], "end_id"))
    estimates = sketches.distinct_counts(store.read(), ["type"])
    exact = ends.groupBy("type").agg(F.count_distinct("end_id").alias("n"))
    within = F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * sketches.distinct_error()
    return exact.join(estimates, "type").select("type", "n", within.alias("within"))


@query(
    "latency_sketch",
    """SELECT event_type, rank, n, TRUE AS within
       FROM (SELECT event_type, count(value) AS n FROM events GROUP BY 1), (SELECT unnest([0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS rank)""",
)
def latency_sketch(spark, sf_dir):
    """Quantiles per event type from a sketch per day: whether the exact rank of each estimate is within the bound."""
    events = table(spark, sf_dir, "events").select("event_type", "value", F.to_date("ts").alias("day"))
    daily = sketches.quantile_sketches(events, ["event_type", "day"], "value")
    found = sketches.quantiles(daily, ["event_type"], [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0])
    counted = events.filter("value IS NOT NULL").join(found, "event_type").groupBy("event_type", "rank", "n").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto")
    )
    error = sketches.rank_error() * F.col("n")
    within = (F.col("below") - error <= F.col("rank") * F.col("n")) & (F.col("upto") + error >= F.col("rank") * F.col("n"))
    return counted.select("event_type", "rank", "n", within.alias("within"))
