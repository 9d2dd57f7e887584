"""Scans, patterns, paths, traversals and schema profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vinework.functions.filters import label_allowed, text_equals_all
from vinework.operators import reach, schema
from vinework.operators.pattern import degree, keyed_pairs, match, paths
from vinework.operators.traverse import first_wins, traverse
from vinework.plans.inputs import COLLECTION_SQL, LINKS_SQL, collection, commerce_graph, link_graph, relay_graph, table
from vinework.plans.registry import query
from vinework.sources.graph import PropertyGraph, edge, vertex

GID = "(({no}::BIGINT << 48) + {key})"


def gid(no: int, key: str) -> str:
    return GID.format(no=no, key=key)


@query(
    "node_count",
    "SELECT 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'Supplier', count(*) FROM supplier "
    "UNION ALL SELECT 'Part', count(*) FROM part",
)
def node_count(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, ["Customer", "Supplier", "Part"], [])
    return graph.nodes().groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "node_scan_all",
    f"""SELECT {gid(1, 'c_custkey')} AS id, 'Customer' AS label, c_name, NULL AS s_name, NULL AS p_name FROM customer
        UNION ALL SELECT {gid(4, 's_suppkey')}, 'Supplier', NULL, s_name, NULL FROM supplier
        UNION ALL SELECT {gid(3, 'p_partkey')}, 'Part', NULL, NULL, p_name FROM part""",
)
def node_scan_all(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, ["Customer", "Supplier", "Part"], [])
    return graph.nodes().select("id", "label", "c_name", "s_name", "p_name")


@query(
    "point_lookup",
    "SELECT o_orderkey, o_totalprice AS total FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
)
def point_lookup(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, ["Order"], [])
    found = match(graph, "o", "Order", o_orderpriority="1-URGENT", o_orderstatus="F")
    return found.returns("o.o_orderkey", total="o.o_totalprice")


@query(
    "one_hop_out",
    "SELECT c_name, o_orderkey, o_totalprice AS total, o_orderdate AS placed FROM customer JOIN orders ON o_custkey = c_custkey",
)
def one_hop_out(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, ["Customer", "Order"], ["PLACED"]), "c", "Customer").out("r", "PLACED", "o", "Order")
    return pattern.returns("c.c_name", "o.o_orderkey", total="o.o_totalprice", placed="r.o_orderdate")


@query(
    "one_hop_in",
    f"""SELECT n_name, 'IN_NATION' AS rel, 'Customer' AS who, {gid(1, 'c_custkey')} AS who_id
        FROM nation JOIN customer ON c_nationkey = n_nationkey
        UNION ALL SELECT n_name, 'IN_NATION', 'Supplier', {gid(4, 's_suppkey')}
        FROM nation JOIN supplier ON s_nationkey = n_nationkey""",
)
def one_hop_in(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, ["Nation"]), "n", "Nation").into("r", None, "m")
    return pattern.returns("n.n_name", rel="r.type", who="m.label", who_id="m.id")


@query(
    "one_hop_undirected",
    f"""WITH {LINKS_SQL}
        SELECT s AS n, id AS r, t AS m FROM links UNION ALL SELECT t, id, s FROM links WHERE s <> t""",
)
def one_hop_undirected(spark, sf_dir):
    return match(link_graph(spark, sf_dir), "n", "Customer").both("r", "LINKS", "m", "Customer").returns("n", "r", "m")


@query(
    "one_hop_count",
    "SELECT c_custkey, c_name, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2",
)
def one_hop_count(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, ["Customer"], ["PLACED"])
    counts = degree(graph, "PLACED", src="Customer", dst="Order")
    return counts.join(graph.nodes("Customer").select("id", "c_custkey", "c_name"), "id").select("c_custkey", "c_name", "n")


@query(
    "two_hop_chain",
    """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def two_hop_chain(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, ["Customer", "Nation", "Region"], ["IN_NATION", "IN_REGION"]), "c", "Customer").out("a", "IN_NATION", "n", "Nation")
    return pattern.out("b", "IN_REGION", "r", "Region").returns("c.c_custkey", "n.n_name", "r.r_name")


@query(
    "chain_distinct_edges",
    f"""WITH {LINKS_SQL}
        SELECT a.s AS a, a.id AS r1, a.t AS b, x.id AS r2, x.s AS c
        FROM links a JOIN links x ON a.t = x.t AND a.id <> x.id""",
)
def chain_distinct_edges(spark, sf_dir):
    pattern = match(link_graph(spark, sf_dir), "a", "Customer").out("r1", "LINKS", "b", "Customer")
    return pattern.into("r2", "LINKS", "c", "Customer").returns("a", "r1", "b", "r2", "c")


def _khop_sql(hops: int) -> str:
    joins = " ".join(
        f"JOIN links e{i} ON e{i}.s = e{i - 1}.t " + "".join(f"AND e{i}.id <> e{j}.id " for j in range(1, i))
        for i in range(2, hops + 1)
    )
    return f"WITH {LINKS_SQL} SELECT e1.s AS start_id, count(DISTINCT e{hops}.t) AS n_ends FROM links e1 {joins} GROUP BY 1"


def _khop(spark, sf_dir, hops):
    walks = paths(link_graph(spark, sf_dir), "LINKS", hops)
    return walks.groupBy("start_id").agg(F.countDistinct("end_id").alias("n_ends"))


@query("khop3_distinct", _khop_sql(3))
def khop3_distinct(spark, sf_dir):
    return _khop(spark, sf_dir, 3)


@query("khop6_distinct", _khop_sql(6))
def khop6_distinct(spark, sf_dir):
    return _khop(spark, sf_dir, 6)


def _ends_sql(links: str, hops: int, start: str = "") -> str:
    joins = " ".join(
        f"JOIN links e{i} ON e{i}.s = e{i - 1}.t " + "".join(f"AND e{i}.id <> e{j}.id " for j in range(1, i))
        for i in range(2, hops + 1)
    )
    return f"WITH {links} SELECT DISTINCT e{hops}.t AS end_id FROM links e1 {joins} {start}"


@query("khop6_ends", _ends_sql(LINKS_SQL, 6, "WHERE e1.s IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"))
def khop6_ends(spark, sf_dir):
    """Ends of walks of six edges from many customers, with a bounded family of edge sets per node."""
    graph = link_graph(spark, sf_dir)
    return reach.distinct_ends(graph, "LINKS", 6, graph.nodes("Customer").filter(F.col("c_mktsegment") == "BUILDING"))


_HUB_SQL = """links AS (
    SELECT 2 * c_custkey AS id, c_custkey AS s, -1 - c_nationkey AS t FROM customer
    UNION ALL SELECT 2 * c_custkey + 1, -1 - c_nationkey, c_custkey FROM customer WHERE c_acctbal > 0)"""


@query("khop4_hub_ends", _ends_sql(_HUB_SQL, 4, "WHERE e1.s >= 0"))
def khop4_hub_ends(spark, sf_dir):
    """The same through hubs: customers to their nation and, if they have money, back."""
    customer = table(spark, sf_dir, "customer")
    key, hub = F.col("c_custkey"), (-1 - F.col("c_nationkey")).cast("bigint")
    out = customer.select((key * 2).alias("id"), key.alias("start_id"), hub.alias("end_id"), F.lit("Customer").alias("src_label"), F.lit("Nation").alias("dst_label"))
    back = customer.filter("c_acctbal > 0").select(
        (key * 2 + 1).alias("id"), hub.alias("start_id"), key.alias("end_id"), F.lit("Nation").alias("src_label"), F.lit("Customer").alias("dst_label")
    )
    nodes = {"Customer": customer.withColumn("id", key)}
    return reach.distinct_ends(PropertyGraph(nodes, {"AT": out.unionByName(back)}), "AT", 4, nodes["Customer"])


@query(
    "path_from_starts",
    f"""WITH {LINKS_SQL}
        SELECT a.s AS start_id, b.t AS end_id, a.id AS first_edge, b.id AS last_edge
        FROM links a JOIN links b ON b.s = a.t AND a.id <> b.id
        WHERE a.s IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def path_from_starts(spark, sf_dir):
    graph = link_graph(spark, sf_dir)
    starts = graph.nodes("Customer").filter(F.col("c_mktsegment") == "BUILDING")
    walks = paths(graph, "LINKS", 2, starts)
    return walks.select(
        "start_id", "end_id", F.col("edge_ids")[0].alias("first_edge"), F.col("edge_ids")[1].alias("last_edge")
    )


def _walk_sql(near: str, far: str, depth: int, name: str) -> str:
    return f"""{name} AS (
      SELECT {far} AS node_id, 1 AS depth FROM links JOIN customer ON {near} = c_custkey WHERE c_mktsegment = 'BUILDING'
      UNION
      SELECT l.{far}, w.depth + 1 FROM {name} w JOIN links l ON l.{near} = w.node_id WHERE w.depth < {depth})"""


START = {"c_mktsegment": "BUILDING"}


@query("traverse_out", f"WITH RECURSIVE {LINKS_SQL}, {_walk_sql('s', 't', 6, 'walk')} SELECT depth, node_id FROM walk")
def traverse_out(spark, sf_dir):
    return traverse(link_graph(spark, sf_dir), "Customer", START, "LINKS", 6, return_properties=False)


@query("traverse_in", f"WITH RECURSIVE {LINKS_SQL}, {_walk_sql('t', 's', 6, 'walk')} SELECT depth, node_id FROM walk")
def traverse_in(spark, sf_dir):
    graph = link_graph(spark, sf_dir)
    return traverse(graph, "Customer", START, "LINKS", 6, direction="incoming", return_properties=False)


@query(
    "traverse_both",
    f"""WITH RECURSIVE {LINKS_SQL}, {_walk_sql('s', 't', 4, 'walk')}, {_walk_sql('t', 's', 4, 'back')}
        SELECT coalesce(a.node_id, b.node_id) AS node_id, coalesce(a.depth, b.depth) AS depth
        FROM (SELECT node_id, min(depth) AS depth FROM walk GROUP BY 1) a
        FULL JOIN (SELECT node_id, min(depth) AS depth FROM back GROUP BY 1) b ON a.node_id = b.node_id""",
)
def traverse_both(spark, sf_dir):
    graph = link_graph(spark, sf_dir)
    return traverse(graph, "Customer", START, "LINKS", 4, direction="both", return_properties=False)


@query(
    "traverse_props",
    f"""WITH RECURSIVE {LINKS_SQL}, {_walk_sql('s', 't', 3, 'walk')}
        SELECT depth, node_id, c_name, c_acctbal FROM walk JOIN customer ON c_custkey = node_id""",
)
def traverse_props(spark, sf_dir):
    return traverse(link_graph(spark, sf_dir), "Customer", START, "LINKS", 3, properties=["c_name", "c_acctbal"])


_RELAY_SQL = f"""
  total AS (SELECT count(*) AS n FROM customer),
  steps AS (
    SELECT {gid(1, 'o_custkey')} AS s, {gid(2, 'o_orderkey')} AS t FROM orders
    UNION ALL SELECT {gid(2, 'o_orderkey')}, {gid(1, '(7 * o_custkey + 13) % n')} FROM orders, total),
  walk AS (
    SELECT t AS node_id, 1 AS depth FROM steps JOIN customer ON s = {gid(1, 'c_custkey')} WHERE c_mktsegment = 'BUILDING'
    UNION SELECT steps.t, depth + 1 FROM walk JOIN steps ON steps.s = walk.node_id WHERE depth < 4)"""


@query(
    "traverse_foreign_label",
    f"""WITH RECURSIVE {_RELAY_SQL}
        SELECT depth, node_id, c_name FROM walk JOIN customer ON {gid(1, 'c_custkey')} = node_id""",
)
def traverse_foreign_label(spark, sf_dir):
    return traverse(relay_graph(spark, sf_dir), "Customer", START, "STEP", 4, properties=["c_name"])


@query("traverse_all_labels", f"WITH RECURSIVE {_RELAY_SQL} SELECT depth, node_id FROM walk")
def traverse_all_labels(spark, sf_dir):
    return traverse(relay_graph(spark, sf_dir), "Customer", START, "STEP", 4, return_properties=False)


@query(
    "optional_match",
    """SELECT c_custkey, o_orderkey FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 400000""",
)
def optional_match(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, ["Customer", "Order"], ["PLACED"]), "c", "Customer").out("r", "PLACED", "o", "Order", optional=True)
    rich = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)
    return pattern.where("o", rich).returns("c.c_custkey", "o.o_orderkey")


@query(
    "edge_entities",
    f"""SELECT {gid(1, 'c_custkey')} AS a_id, 'Customer' AS a_label, 'PLACED:' || o_orderkey AS r_id, 'PLACED' AS r_type,
               {gid(1, 'o_custkey')} AS r_start, {gid(2, 'o_orderkey')} AS r_end, 'Order' AS b_labels, 0 AS b_keys
        FROM customer JOIN orders ON o_custkey = c_custkey""",
)
def edge_entities(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, [], ["PLACED"]), "a", "Customer").out("r", "PLACED", "b", "Order")
    whole = pattern.matches().select(vertex("a").alias("a"), edge("r").alias("r"), vertex("b").alias("b"))
    return whole.select(
        F.col("a.id").alias("a_id"), F.col("a.label").alias("a_label"), F.col("r.id").alias("r_id"),
        F.col("r.label").alias("r_type"), F.col("r.start_id").alias("r_start"), F.col("r.end_id").alias("r_end"),
        F.array_join(F.array("b.label"), ",").alias("b_labels"), F.size("b.properties").alias("b_keys"),
    )


@query(
    "keyed_pairs",
    f"""WITH {LINKS_SQL}
        SELECT 'node_' || s AS a, 'node_' || t AS b, s AS start_id, t AS end_id FROM links""",
)
def keyed_pairs_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    n = customer.count()
    nodes = customer.select(F.col("c_custkey").alias("id"), F.concat(F.lit("node_"), "c_custkey").alias("name"))
    here = F.concat(F.lit("node_"), "c_custkey").alias("a")
    targets = F.array((F.col("c_custkey") * 7 + 13) % n, (F.col("c_custkey") * 13 + 7) % n)
    rows = customer.select(here, F.explode(targets).alias("t")).select("a", F.concat(F.lit("node_"), "t").alias("b"))
    return keyed_pairs(rows, nodes, nodes, "a", "b", "name").select("a", "b", "start_id", "end_id")


@query(
    "group_by_output",
    """SELECT n_name, count(*) AS n_orders, count(DISTINCT c_custkey) AS n_customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
       GROUP BY n_name ORDER BY n_orders DESC, n_name LIMIT 10 OFFSET 2""",
)
def group_by_output(spark, sf_dir):
    pattern = match(commerce_graph(spark, sf_dir, ["Nation"], ["IN_NATION", "PLACED"]), "n", "Nation").into("a", "IN_NATION", "c", "Customer")
    rows = pattern.out("b", "PLACED", "o", "Order").returns("n.n_name", "c", "o")
    grouped = rows.groupBy("n_name").agg(F.count("o").alias("n_orders"), F.countDistinct("c").alias("n_customers"))
    return grouped.orderBy(F.col("n_orders").desc(), "n_name").offset(2).limit(10)


@query(
    "distinct_ends",
    f"WITH {LINKS_SQL} SELECT count(*) AS n_matches, count(DISTINCT t) AS n_ends FROM links",
)
def distinct_ends(spark, sf_dir):
    rows = match(link_graph(spark, sf_dir), "a", "Customer").out("r", "LINKS", "b", "Customer").returns("b")
    return rows.agg(F.count("b").alias("n_matches"), F.countDistinct("b").alias("n_ends"))


@query(
    "union_distinct",
    "SELECT c_nationkey AS nation, c_acctbal < 0 AS in_debt FROM customer UNION SELECT s_nationkey, s_acctbal < 0 FROM supplier",
)
def union_distinct(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") < 0).alias("in_debt"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") < 0).alias("in_debt"))
    # Each side is made distinct first, so only distinct rows are shuffled.
    return customer.union(supplier).distinct()


@query(
    "first_wins",
    """SELECT coalesce(a.node_id, b.node_id) AS node_id, coalesce(a.depth, b.depth) AS depth
       FROM (SELECT o_custkey AS node_id, min(o_orderkey) AS depth FROM orders GROUP BY 1) a
       FULL JOIN (SELECT c_custkey AS node_id, min(c_nationkey)::BIGINT AS depth FROM customer GROUP BY 1) b
       ON a.node_id = b.node_id""",
)
def first_wins_query(spark, sf_dir):
    first = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("node_id"), F.col("o_orderkey").alias("depth"))
    second = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node_id"), F.col("c_nationkey").cast("bigint").alias("depth"))
    return first_wins(first, second)


def _bags(spark, sf_dir):
    """Property bags of two tables, labelled by event type and by language."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("label"), F.from_json("props", "map<string,string>").alias("props")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("label"),
        F.map_filter(
            F.create_map(F.lit("source"), F.col("source"), F.lit("long"), F.when(F.col("n_chars") > 20000, "true")),
            lambda _, v: v.isNotNull(),
        ).alias("props"),
    )
    return events.unionByName(documents)


_PROPS_SQL = """
  keys AS (
    SELECT DISTINCT event_type AS label, unnest(json_keys(props)) AS k FROM events
    UNION SELECT lang, 'source' FROM documents UNION SELECT lang, 'long' FROM documents WHERE n_chars > 20000)"""


@query(
    "schema_node_props",
    f"WITH {_PROPS_SQL} SELECT label, string_agg(k, ',' ORDER BY k) AS properties FROM keys GROUP BY label",
)
def schema_node_props(spark, sf_dir):
    profile = schema.bag_properties(_bags(spark, sf_dir), "label")
    return profile.select("label", F.array_join("properties", ",").alias("properties"))


@query(
    "schema_typed_props",
    f"""WITH {COLLECTION_SQL},
          bags AS (SELECT event_type AS label, props AS bag FROM events UNION ALL SELECT lang, metadata FROM collection),
          entries AS (SELECT label, bag, unnest(json_keys(bag)) AS key FROM bags),
          typed AS (SELECT label, key, json_type(bag, '$."' || key || '"') AS t FROM entries)
        SELECT label, key,
               coalesce(max(CASE t WHEN 'NULL' THEN NULL WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' ELSE t END), 'VOID') AS type,
               count(*) AS n_rows, count(*) FILTER (t = 'NULL') AS n_null
        FROM typed GROUP BY label, key""",
)
def schema_typed_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), "props")
    documents = collection(spark, sf_dir, vectors=False).select(F.col("lang").alias("label"), F.col("metadata").alias("props"))
    return schema.variant_properties(events.unionByName(documents), "label")


_TRIPLES_SQL = """
  triples AS (
    SELECT DISTINCT 'Customer' AS "start", 'PLACED' AS type, 'Order' AS "end" FROM orders
    UNION SELECT 'Order', 'CONTAINS', 'Part' FROM lineitem UNION SELECT 'Part', 'SUPPLIED_BY', 'Supplier' FROM lineitem
    UNION SELECT 'Customer', 'IN_NATION', 'Nation' FROM customer UNION SELECT 'Supplier', 'IN_NATION', 'Nation' FROM supplier
    UNION SELECT 'Nation', 'IN_REGION', 'Region' FROM nation)"""


@query("schema_triples", f"WITH {_TRIPLES_SQL} SELECT * FROM triples")
def schema_triples(spark, sf_dir):
    return schema.graph_triples(commerce_graph(spark, sf_dir, []))


@query(
    "schema_store_restricted",
    f"""WITH {_TRIPLES_SQL} SELECT * FROM triples WHERE type IN ('PLACED', 'IN_NATION', 'IN_REGION') AND type <> 'IN_REGION'""",
)
def schema_store_restricted(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, [])
    found = schema.graph_triples(graph)
    include = ["Customer", "PLACED", "IN_NATION", "IN_REGION"]
    return schema.restrict_store(schema.typed_properties(graph, "edge"), found, include, ["IN_REGION"])[1]


@query(
    "schema_question_restricted",
    f"""WITH {_TRIPLES_SQL} SELECT * FROM triples WHERE "start" <> 'Supplier' AND "end" <> 'Supplier'""",
)
def schema_question_restricted(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir)
    found = schema.graph_triples(graph)
    return schema.restrict_question(schema.typed_properties(graph, "node"), found, exclude=["Supplier"])[1]


@query(
    "label_restriction",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'error') AND event_type <> 'error' GROUP BY 1",
)
def label_restriction(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kept = events.filter(label_allowed(F.col("event_type"), ["click", "view", "error"], ["error"]))
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "schema_text",
    f"""WITH {_PROPS_SQL}, {_TRIPLES_SQL},
        props AS (SELECT label, string_agg(k, ', ' ORDER BY k) AS p FROM keys GROUP BY label),
        empty AS (SELECT DISTINCT o_orderstatus AS label FROM orders)
        SELECT 'Node labels and properties:' || (SELECT string_agg(chr(10) || '  :' || label || ' {{' || p || '}}', '' ORDER BY label) FROM props)
          || chr(10) || chr(10) || 'Relationship types and properties:'
          || (SELECT string_agg(chr(10) || '  [:' || label || '] {{(no properties sampled)}}', '' ORDER BY label) FROM empty)
          || chr(10) || chr(10) || 'Relationship patterns:'
          || (SELECT string_agg(line, '' ORDER BY line) FROM
               (SELECT chr(10) || '  (:' || "start" || ')-[:' || type || ']->(:' || "end" || ')' AS line FROM triples)) AS schema_text
    """.replace("{{", "{").replace("}}", "}"),
)
def schema_text(spark, sf_dir):
    nodes = schema.bag_properties(_bags(spark, sf_dir), "label")
    status = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("type"), F.create_map().cast("map<string,string>").alias("props")
    )
    edges = schema.bag_properties(status, "type")
    return schema.render(nodes, edges, schema.graph_triples(commerce_graph(spark, sf_dir, [])))


@query(
    "start_filter",
    "SELECT c_custkey FROM customer WHERE c_nationkey::VARCHAR = '7' AND c_mktsegment = 'MACHINERY'",
)
def start_filter(spark, sf_dir):
    chosen = text_equals_all({"c_nationkey": 7, "c_mktsegment": "MACHINERY"})
    return table(spark, sf_dir, "customer").filter(chosen).select("c_custkey")


@query(
    "bound_values",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH' AND o_totalprice BETWEEN 100000 AND 200000",
)
def bound_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderpriority = :p AND o_totalprice BETWEEN :lo AND :hi",
        args={"p": "2-HIGH", "lo": 100000, "hi": 200000},
        orders=orders,
    )


@query("edge_scan", "SELECT o_custkey AS customer, o_orderkey AS \"order\", o_orderdate FROM orders")
def edge_scan(spark, sf_dir):
    graph = commerce_graph(spark, sf_dir, [], ["PLACED"])
    mask = (1 << 48) - 1
    return graph.edges("PLACED").select(
        F.col("start_id").bitwiseAND(F.lit(mask)).alias("customer"), F.col("end_id").bitwiseAND(F.lit(mask)).alias("order"), "o_orderdate"
    )
