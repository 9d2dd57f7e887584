import pytest
from pyspark.sql import functions as F

from vinework.operators import schema
from vinework.operators.pattern import degree, match, paths
from vinework.operators.traverse import traverse
from vinework.sources.graph import PropertyGraph, bag, graph_id


def graph(spark, edges, nodes=None, foreign=()):
    """Graph of label N (and F for foreign ids) with one edge type E."""
    ids = sorted({i for e in edges for i in e[1:3]} | set(nodes or ()))
    own = spark.createDataFrame([(i, f"n{i}") for i in ids if i not in foreign], "id bigint, name string")
    other = spark.createDataFrame([(i, f"f{i}") for i in foreign], "id bigint, name string")
    rows = [(e, s, t, "F" if s in foreign else "N", "F" if t in foreign else "N") for e, s, t in edges]
    frame = spark.createDataFrame(rows, "id bigint, start_id bigint, end_id bigint, src_label string, dst_label string")
    return PropertyGraph({"N": own, "F": other}, {"E": frame})


def walk(g, depth, start="n1", **options):
    options.setdefault("return_properties", False)
    rows = traverse(g, "N", {"name": start}, "E", depth, **options).collect()
    return sorted((r.depth, r.node_id) for r in rows)


CHAIN = [(1, 1, 2), (2, 2, 3), (3, 3, 4)]
CYCLE = [(1, 1, 2), (2, 2, 3), (3, 3, 1)]


@pytest.mark.parametrize("cut_every", [1, 2, 3, 62])
def test_cycle_returns_nodes_at_several_depths(spark, cut_every):
    expected = [(1, 2), (2, 3), (3, 1), (4, 2), (5, 3)]
    assert walk(graph(spark, CYCLE), 5, cut_every=cut_every) == expected


def test_depth_one_is_always_produced(spark):
    assert walk(graph(spark, CHAIN), 0) == [(1, 2)]


def test_self_loop_and_parallel_edges(spark):
    assert walk(graph(spark, [(1, 1, 1), (2, 1, 2), (3, 1, 2)]), 2) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_incoming(spark):
    assert walk(graph(spark, CHAIN), 2, start="n4", direction="incoming") == [(1, 3), (2, 2)]


def test_unknown_direction_is_outgoing(spark):
    assert walk(graph(spark, CHAIN), 1, direction="sideways") == [(1, 2)]


def test_outgoing_depth_wins_over_smaller_incoming_depth(spark):
    # 4 is reached outgoing at depth 3 and incoming at depth 1.
    assert (3, 4) in walk(graph(spark, [*CHAIN, (4, 4, 1)]), 3, direction="both")


def test_both_has_one_row_per_node(spark):
    found = walk(graph(spark, [*CHAIN, (4, 4, 1), (5, 9, 1)]), 3, direction="both")
    assert found == [(1, 2), (1, 9), (2, 3), (3, 4)]


def test_passes_through_foreign_labels_but_drops_them_with_properties(spark):
    g = graph(spark, CHAIN, foreign={3})
    assert walk(g, 3) == [(1, 2), (2, 3), (3, 4)]
    rows = traverse(g, "N", {"name": "n1"}, "E", 3).collect()
    assert sorted((r.depth, r.node_id, r.name) for r in rows) == [(1, 2, "n2"), (3, 4, "n4")]


def test_empty_start_filter_means_all_nodes(spark):
    rows = traverse(graph(spark, CHAIN), "N", None, "E", 1, return_properties=False).collect()
    assert sorted(r.node_id for r in rows) == [2, 3, 4]


def test_dead_end_stops_early(spark):
    assert walk(graph(spark, CHAIN), 30, cut_every=2) == [(1, 2), (2, 3), (3, 4)]


def test_hub_with_a_third_of_all_edges(spark):
    edges = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("start_id"),
        (F.col("id") * 7 % 100).alias("end_id"),
        F.lit("N").alias("src_label"), F.lit("N").alias("dst_label"),
    )
    nodes = spark.range(101).select("id", F.concat(F.lit("n"), "id").alias("name"))
    g = PropertyGraph({"N": nodes}, {"E": edges})
    adjacency = {}
    for r in edges.collect():
        adjacency.setdefault(r.start_id, set()).add(r.end_id)
    level, expected = {0}, set()
    for depth in range(1, 5):
        level = {t for s in level for t in adjacency.get(s, ())}
        expected |= {(depth, n) for n in level}
    assert set(walk(g, 4, start="n0")) == expected
    assert {r.id: r.n for r in degree(g, "E").collect()}[0] == 1000


def test_pattern_names_and_duplicates(spark):
    g = graph(spark, CHAIN)
    found = match(g, "a", "N").out("r", "E", "b", "N").returns("a.name", "r", to="b.name")
    assert found.columns == ["name", "r", "to"]
    assert sorted(tuple(r) for r in found.collect()) == [("n1", 1, "n2"), ("n2", 2, "n3"), ("n3", 3, "n4")]
    with pytest.raises(ValueError, match="duplicate"):
        match(g, "a", "N").out("r", "E", "b", "N").returns("a.name", "b.name")
    with pytest.raises(ValueError, match="twice"):
        match(g, "a", "N").out("a", "E", "b", "N")


def test_missing_property_is_null(spark):
    found = match(graph(spark, CHAIN), "a", "N").out("r", "E", "b").returns("a.nothing", "r.since").collect()
    assert {tuple(r) for r in found} == {(None, None)}


def test_undirected_self_loop_matches_once(spark):
    found = match(graph(spark, [(1, 1, 1), (2, 1, 2)]), "a", "N").both("r", "E", "b", "N").returns("a", "r", "b")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 1), (1, 2, 2), (2, 2, 1)]


def test_an_edge_is_used_once_per_match(spark):
    g = graph(spark, [(1, 1, 1), (2, 1, 2)])
    found = match(g, "a", "N").out("r", "E", "b", "N").out("q", "E", "c", "N").returns("r", "q")
    assert [tuple(r) for r in found.collect()] == [(1, 2)]


def test_optional_hop_keeps_unmatched_rows(spark):
    g = graph(spark, CHAIN)
    found = match(g, "a", "N").out("r", "E", "b", "N", optional=True).where("b", name="n3").returns("a", "b.name")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == [(1, None), (2, "n3"), (3, None), (4, None)]


def test_label_filter_without_node_tables(spark):
    g = graph(spark, CHAIN, foreign={3})
    pattern = match(g, "a", "N").out("r", "E", "b", "F")
    assert [tuple(r) for r in pattern.returns("a", "b").collect()] == [(2, 3)]
    assert "Join" not in pattern.returns("a", "b")._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("hops", [1, 2, 3, 4, 5])
def test_fixed_length_paths_against_brute_force(spark, hops):
    edges = [(1, 1, 2), (2, 2, 1), (3, 2, 3), (4, 3, 1), (5, 1, 1), (6, 1, 2)]
    found = paths(graph(spark, edges), "E", hops)
    got = sorted((r.start_id, r.end_id, tuple(r.edge_ids)) for r in found.collect())
    walks = [((e,), s, t) for e, s, t in edges]
    for _ in range(hops - 1):
        walks = [((*w, e), s, t) for w, s, m in walks for e, f, t in edges if f == m and e not in w]
    assert got == sorted((s, t, w) for w, s, t in walks)
    starts = spark.createDataFrame([(3,)], "id bigint")
    some = paths(graph(spark, edges), "E", hops, starts, cut_every=2)
    assert sorted(tuple(r.edge_ids) for r in some.collect()) == sorted(w for w, s, _ in walks if s == 3)


def test_graph_ids(spark):
    row = spark.range(1).select(graph_id(2, F.lit(5)).alias("a"), graph_id(2, F.lit(None)).alias("b")).first()
    assert (row.a, row.b) == ((2 << 48) + 5, None)
    with pytest.raises(Exception, match="does not fit"):
        spark.range(1).select(graph_id(2, F.lit(-1))).collect()
    g = PropertyGraph({"A": spark.range(3), "B": spark.range(2, 5)}, {})
    assert [(r.id, r.n) for r in g.duplicate_ids().collect()] == [(2, 2)]


def test_bag_keeps_json_types(spark):
    row = spark.createDataFrame([(30, "30", None)], "a int, b string, c string").select(bag("a", "b", "c").alias("p")).first()
    assert row.p == {"a": "30", "b": "30"}


def test_schema_of_bags(spark):
    rows = spark.createDataFrame(
        [("A", {"x": "1"}), ("A", {"y": None}), ("B", {}), ("_ag_label_vertex", {"z": "1"})],
        "label string, props map<string,string>",
    )
    found = {r.label: r.properties for r in schema.bag_properties(rows, "label").collect()}
    assert found == {"A": ["x", "y"], "B": []}
    edges = spark.createDataFrame([("T", "A", None)], "type string, src_label string, dst_label string")
    text = schema.render(schema.bag_properties(rows, "label"), rows.limit(0).select("label", F.array().cast("array<string>").alias("properties")), schema.triples(edges)).first()
    assert text.schema_text == (
        "Node labels and properties:\n  :A {x, y}\n  :B {(no properties sampled)}\n\n"
        "Relationship types and properties:\n\nRelationship patterns:\n  (:A)-[:T]->(:Unknown)"
    )


def test_describe_with_restriction(spark):
    g = graph(spark, CHAIN, foreign={3})
    text = schema.describe(g, exclude=["F"]).first().schema_text
    assert "  :N {name}" in text and "  :F {" not in text and "(:N)-[:E]->(:F)" in text


def test_typed_graph_over_bags_and_on_disk(spark, tmp_path):
    nodes = spark.createDataFrame(
        [("P", "1", {"id": '"1"', "name": '"Al"', "age": "30"}), ("P", "2", {"id": '"2"', "name": '"Bo"'})],
        "label string, id string, props map<string,string>",
    )
    edges = spark.createDataFrame(
        [("KNOWS", "P", "1", "P", "2", {"since": "2020"})],
        "type string, src_label string, src_id string, dst_label string, dst_id string, props map<string,string>",
    )
    g = PropertyGraph.from_bags(nodes, edges, {"P": "name string, age int"}, {"KNOWS": "since int"})
    g.save(str(tmp_path))
    for graph_ in (g, PropertyGraph.load(spark, str(tmp_path), ["P"], ["KNOWS"])):
        found = match(graph_, "a", "P", name="Al").out("r", "KNOWS", "b", "P").returns("a.age", "r.since", to="b.name")
        assert [tuple(r) for r in found.collect()] == [(30, 2020, "Bo")]
    reached = traverse(g, "P", {"name": "Al"}, "KNOWS", 2, properties=["name", "age"]).collect()
    assert [tuple(r) for r in reached] == [(1, "P:2", "Bo", None)]
