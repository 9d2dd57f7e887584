import json

import pytest
from pyspark.sql import functions as F

from vinework.functions.text import UNSTEMMED
from vinework.operators import merge
from vinework.sources import collection as docs
from vinework.sources.collection import CollectionStore
from vinework.sources.graph import GraphStore
from vinework.sources.layout import bucket_edges, cluster_by_property
from vinework.streaming.upsert import stream_documents, stream_graph


def node(identity, kind="P", **props):
    return (identity, kind, {k: None if v is None else json.dumps(v) for k, v in props.items()})


def rel(src, dst, kind="KNOWS", src_type="P", dst_type="P", **props):
    return (src, src_type, dst, dst_type, kind, {k: json.dumps(v) for k, v in props.items()})


def documents(spark, *rows):
    return spark.createDataFrame([(i, n, r, s) for i, (n, r, s) in enumerate(rows)], merge.DOCUMENT_SCHEMA)


def nodes_of(df):
    return {(r.label, r.id): {k: json.loads(v) for k, v in r.props.items()} for r in df.collect()}


def edges_of(df):
    return {(r.type, r.src_id, r.dst_id): {k: json.loads(v) for k, v in r.props.items()} for r in df.collect()}


def test_later_documents_win_per_property_and_null_removes(spark):
    found, _ = merge.merge_documents(
        documents(
            spark,
            ([node("1", name="A", age=30), node("1", age=31)], [], None),
            ([node("1", age=None, city="X")], [], None),
        )
    )
    assert nodes_of(found) == {("P", "1"): {"id": "1", "name": "A", "city": "X"}}


def test_property_named_id_replaces_the_id(spark):
    found, _ = merge.merge_documents(documents(spark, ([node("1", id="other", n=1)], [], None)))
    assert nodes_of(found) == {("P", "other"): {"id": "other", "n": 1}}


def test_edges_need_both_ends_in_time(spark):
    _, found = merge.merge_documents(
        documents(
            spark,
            ([node("1")], [rel("1", "2")], None),
            ([node("2")], [rel("1", "2", kind="LATE", since=1), rel("2", "9")], None),
            ([], [rel("1", "2", kind="LATE", since=2, place="Y")], None),
        )
    )
    assert edges_of(found) == {("LATE", "1", "2"): {"src_id": "1", "tgt_id": "2", "since": 2, "place": "Y"}}


def test_stored_nodes_count_as_ends_and_keep_properties(spark):
    first = documents(spark, ([node("1", a=1), node("2", b=1)], [rel("1", "2", w=1)], None))
    nodes, edges = merge.merge_documents(first)
    second = documents(spark, ([node("2", c=2)], [rel("1", "2", v=2)], None))
    nodes, edges = merge.merge_documents(second, nodes, edges)
    assert nodes_of(nodes) == {("P", "1"): {"id": "1", "a": 1}, ("P", "2"): {"id": "2", "b": 1, "c": 2}}
    assert edges_of(edges) == {("KNOWS", "1", "2"): {"src_id": "1", "tgt_id": "2", "w": 1, "v": 2}}


def test_sources_link_to_their_nodes(spark):
    docs_ = documents(
        spark,
        ([node("1"), node("1")], [], ("x" * 600, '{"source": "s1"}')),
        ([node("2")], [], ("no name", "{}")),
    )
    nodes, edges = merge.merge_documents(docs_, include_source=True)
    found = nodes_of(nodes)
    assert found[("Document", f"{merge.SOURCE_KEY}s1")] == {"source": "s1", "content": "x" * 500}
    assert found[("Document", f"{merge.SOURCE_KEY}unknown")]["content"] == "no name"
    assert set(edges_of(edges)) == {
        ("MENTIONS", f"{merge.SOURCE_KEY}s1", "1"), ("MENTIONS", f"{merge.SOURCE_KEY}unknown", "2"),
    }


def test_hot_node_with_a_third_of_all_writes(spark):
    rows = spark.range(3000).select(
        F.lit("P").alias("label"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.create_map(F.concat(F.lit("k"), F.col("id") % 5), F.col("id").cast("string")).alias("props"),
        F.struct(F.col("id").alias("doc"), F.lit(0).cast("bigint").alias("at")).alias("seq"),
    )
    found = merge.overlay(None, rows.repartition(13), merge.NODE_KEY)
    assert nodes_of(found.filter("id = 'hot'"))[("P", "hot")] == {f"k{i}": max(x for x in range(0, 3000, 3) if x % 5 == i) for i in range(5)}
    assert found.count() == 2001


def test_merge_node_matches_on_given_keys_only(spark):
    old = spark.createDataFrame([("Bob", 1)], "name string, age int")
    new = spark.createDataFrame([("Bob",), ("Eve",), ("Eve",)], "name string")
    assert sorted((r.name, r.age) for r in merge.merge_nodes(old, new, ["name"]).collect()) == [("Bob", 1), ("Eve", None)]


def test_delete_checks_edges(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    edges = spark.createDataFrame([(7, 1, 2)], "id bigint, start_id bigint, end_id bigint")
    with pytest.raises(ValueError, match="still has edges"):
        merge.delete_nodes(nodes, edges, nodes.filter("id = 2"))
    assert merge.delete_nodes(nodes, edges, nodes.filter("id = 3")).count() == 2
    left, kept = merge.detach_delete(nodes, edges, nodes.filter("id = 2"))
    assert (sorted(r.id for r in left.collect()), kept.count()) == ([1, 3], 0)


def texts(spark, *rows):
    return spark.createDataFrame([(i, t, m, s) for i, t, m, s in rows], "id string, content string, metadata string, seq int")


def stored(store):
    return {r.id: (r.content, r.metadata, r.node_id) for r in store.read().collect()}


def test_collection_store(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "c"), buckets=4).create()
    store.add(texts(spark, ("a", "one", '{"node_id": "n1", "k": 1}', 0), ("b", "two", None, 0), ("a", "uno", '{"x": true}', 1)))
    assert stored(store) == {"a": ("uno", '{"x": true}', None), "b": ("two", "{}", None)}
    store.add(texts(spark, ("c", "three", '{"node_id": "n3", "k": 1, "s": "t"}', 0)))
    assert stored(store)["c"] == ("three", '{"k":1,"s":"t"}', "n3")
    store.create()
    assert len(stored(store)) == 3
    ids = spark.createDataFrame([("a",), ("zz",)], "id string")
    assert [(r.id, r.content) for r in store.get(ids).collect()] == [("a", "uno")]
    store.delete(ids)
    assert set(stored(store)) == {"b", "c"}
    store.delete(spark.createDataFrame([("b",), ("c",)], "id string"))
    assert stored(store) == {}
    store.add(texts(spark, ("d", "four", "{}", 0)))
    again = CollectionStore.open(spark, str(tmp_path / "c"), buckets=4)
    assert set(stored(again)) == {"d"}
    store.create(replace=True)
    assert stored(store) == {}
    store.drop()
    with pytest.raises(FileNotFoundError):
        CollectionStore.open(spark, str(tmp_path / "c"))


def test_collection_from_documents_and_nodes(spark, tmp_path):
    rows = spark.createDataFrame([("hello world",), ("bye",)], "content string")
    store = CollectionStore.from_documents(spark, str(tmp_path / "c"), rows, buckets=2)
    found = store.read().collect()
    assert len({r.id for r in found}) == 2 and all(len(r.id) == 36 for r in found)
    nodes = spark.createDataFrame([(1, "Bolt", "steel"), (2, "Nut", None), (3, None, None)], "id bigint, name string, desc string")
    store.add_nodes(nodes, "Product", ["name", "desc"])
    added = {r.node_id: r.content for r in store.read().filter("node_id is not null").collect()}
    assert added == {"1": "Bolt steel", "2": "Nut"}


def test_ids_lookup_of_nothing(spark):
    rows = texts(spark, ("a", "one", "{}", 0))
    assert docs.by_ids(rows, None).count() == 0 and docs.by_ids(rows, ["a"]).count() == 1


def test_node_id_is_folded_back(spark):
    rows = spark.createDataFrame([('{"k":1}', "7"), ('{"k":1}', None)], "m string, n string")
    shown = [r.x for r in rows.select(docs.metadata_with_node(F.col("m"), F.col("n")).alias("x")).collect()]
    assert [json.loads(x) for x in shown] == [{"k": 1, "node_id": "7"}, {"k": 1}]


def test_graph_store_and_stream(spark, tmp_path):
    batches = [
        [(0, [node("1", a=1), node("2")], [rel("1", "2", w=1)], None)],
        [(1, [node("1", b=2), node("3")], [rel("1", "3"), rel("1", "2", w=2)], ("text", '{"source": "s"}'))],
    ]
    store = GraphStore(spark, str(tmp_path / "g"), buckets=3).create()
    for rows in batches:
        store.merge(spark.createDataFrame(rows, merge.DOCUMENT_SCHEMA), include_source=True)
    streamed = GraphStore(spark, str(tmp_path / "s"), buckets=3).create()
    source = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, merge.DOCUMENT_SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(spark.read.parquet(str(source)).schema).parquet(str(source))
        stream_graph(stream, streamed, str(tmp_path / "cp"), include_source=True).awaitTermination()
    whole = merge.merge_documents(spark.createDataFrame(sum(batches, []), merge.DOCUMENT_SCHEMA), include_source=True)
    for s in (store, streamed):
        assert nodes_of(s.nodes()) == nodes_of(whole[0])
        assert edges_of(s.edges()) == edges_of(whole[1])
    # A replayed batch changes nothing.
    store.merge(spark.createDataFrame(batches[1], merge.DOCUMENT_SCHEMA), include_source=True)
    assert nodes_of(store.nodes()) == nodes_of(whole[0])
    store.drop()
    assert not store.node_table.exists()


def test_document_stream_equals_one_batch(spark, tmp_path):
    batches = [[("a", "one", "{}", 0), ("b", "two", "{}", 1)], [("b", "zwei", "{}", 2), ("c", "three", "{}", 3)]]
    store = CollectionStore(spark, str(tmp_path / "c"), buckets=2).create()
    for rows in batches:
        texts(spark, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        schema = "id string, content string, metadata string, seq int"
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream_documents(stream, store, str(tmp_path / "cp")).awaitTermination()
    once = docs.upsert(docs.prepare(texts(spark, *batches[0])).drop("seq"), docs.prepare(texts(spark, *sum(batches, []))))
    assert {i: c for i, (c, _, _) in stored(store).items()} == {r.id: r.content for r in once.collect()}


def test_layouts_keep_results(spark, tmp_path):
    nodes = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("name"))
    for index in ("range", "bloom"):
        cluster_by_property(nodes, "name", str(tmp_path / index), index=index)
        assert spark.read.parquet(str(tmp_path / index)).filter("name = '1'").count() == 333
    with pytest.raises(ValueError):
        cluster_by_property(nodes, "name", str(tmp_path / "x"), index="tree")


def test_bucketed_edges_need_no_shuffle(spark):
    edges = spark.range(1000).select((F.col("id") % 10).alias("start_id"), F.col("id").alias("end_id"))
    table = bucket_edges(edges, "vinework_test_edges", 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        frontier = spark.range(5).select(F.col("id").alias("start_id"))
        plan = table.join(frontier, "start_id", "left_semi")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.sql("DROP TABLE vinework_test_edges")


def test_late_rows_do_not_replace_newer_ones(spark, tmp_path):
    """Batches in any order, over restarts, give the newest row of every key."""
    schema = "id string, content string, seq bigint"
    batches = [[("a", "a5", 5), ("b", "b1", 1), ("a", "a4", 4)], [("a", "a3", 3), ("b", "b2", 2), (None, "x", 9), ("c", "none", None)], [("a", "a6", 6), ("b", "b0", 0), ("c", "c1", 1)]]
    store = CollectionStore(spark, str(tmp_path / "c"), buckets=2).create()
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream_documents(stream, store, str(tmp_path / "cp"), ordered=True).awaitTermination()
    assert sorted((r.id, r.content) for r in store.read().collect()) == [("a", "a6"), ("b", "b2"), ("c", "c1")]
