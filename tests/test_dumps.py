import gzip
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vinework.operators import schema
from vinework.operators.pattern import match
from vinework.sources import dumps
from vinework.sources.dumps import Split, _lines, _splits, dump_graph, read_dump, stream_dump


def line(tag, id_, label, properties, **ends):
    return json.dumps({"id": id_, "label": label, "properties": properties, **ends}) + f"::{tag}"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump")
    person, town = 1 << 48, 2 << 48
    people = [line("vertex", person + i, "Person", {"name": f"né {i}", "age": i if i % 2 else None}) for i in range(50)]
    towns = [line("VERTEX", town + i, "Tøwn", {"label": "Person", "label2": "LIVES"}) for i in range(3)]
    lives = [line("edge", (3 << 48) + i, "LIVES", {"since": 1990 + i}, start_id=person + i, end_id=town + i % 3) for i in range(50)]
    odd = ["", "  ", "hello", "{broken}::vertex", '[{"id": 1}]::path', '{"id": "x", "label": "Person"}::vertex', '{"label": 5}::vertex', "é" * 5000]
    (path / "a.txt").write_text("\n".join(people + odd), encoding="utf-8")
    (path / "deep").mkdir()
    (path / "deep" / "b.txt").write_bytes(("\r\n".join(towns) + "\r\n").encode())
    with gzip.open(path / "c.gz", "wt") as file:
        file.write("\n".join(lives))
    (path / "_SUCCESS").write_text("Person::vertex")
    (path / "empty.txt").write_text("")
    return str(path)


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet="ab\n", max_size=40), step=st.integers(1, 12))
def test_splits_give_every_line_once(tmp_path_factory, text, step):
    path = tmp_path_factory.mktemp("lines") / "x"
    path.write_text(text)
    found = [x for split in _splits(str(path), 0, len(text), step) for x in _lines(split)]
    assert [x for x in found if x] == [x.encode() for x in text.split("\n") if x]


@pytest.mark.parametrize("size", [17, 400, 1 << 20])
def test_rows_and_odd_lines(spark, folder, size):
    rows = read_dump(spark, folder, split_bytes=size).collect()
    counts = {}
    for row in rows:
        counts[row.kind, row.label] = counts.get((row.kind, row.label), 0) + 1
    assert counts == {("vertex", "Person"): 51, ("vertex", "Tøwn"): 3, ("edge", "LIVES"): 50, ("other", None): 5}
    assert {r.raw for r in rows if r.kind == "other"} == {"hello", "{broken}::vertex", '[{"id": 1}]::path', '{"label": 5}::vertex', "é" * 5000}
    assert [r.properties for r in rows if r.label == "Person" and r.id is None] == ["{}"]


def test_kinds_and_labels_are_judged_in_the_reader(spark, folder):
    assert read_dump(spark, folder, kinds=["vertex"], labels=["Person"]).count() == 51
    assert read_dump(spark, folder, labels=["LIVES", "Tøwn"]).count() == 53
    assert read_dump(spark, folder, kinds=["other"]).count() == 5 and read_dump(spark, folder, labels=[]).count() == 0
    reader = dumps.DumpReader({"path": folder, "labels": '["LIVES"]'})
    read = [batch for split in reader.partitions() for batch in reader.read(split)]
    assert sum(len(batch) for batch in read) == 50


def test_one_frame_with_different_filters(spark, folder):
    rows = read_dump(spark, folder)
    people, towns = rows.filter(F.col("label") == "Person"), rows.filter(F.col("label") == "Tøwn")
    assert people.union(towns).count() == 54 and rows.count() == 109


def test_pattern_on_a_dump(spark, folder):
    graph = dump_graph(spark, folder, {"Person": "name string, age int", "Tøwn": ""}, {"LIVES": "since int"})
    rows = match(graph, "p", "Person").out("r", "LIVES", "t", "Tøwn").returns("p.name", "p.age", since="r.since", town="t")
    found = {r.name: (r.age, r.since, r.town - (2 << 48)) for r in rows.collect()}
    assert found == {f"né {i}": (i if i % 2 else None, 1990 + i, i % 3) for i in range(50)}


def test_stream_takes_new_whole_lines_once(spark, tmp_path):
    source, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    source.mkdir()

    def drain():
        rows = stream_dump(spark, str(source), split_bytes=40).select("id")
        query = rows.writeStream.option("checkpointLocation", progress).trigger(availableNow=True).start(target, format="parquet")
        query.awaitTermination()
        return sorted(r.id for r in spark.read.schema("id bigint").parquet(target).collect())

    half = line("vertex", 3, "A", {})
    (source / "a").write_text(line("vertex", 1, "A", {}) + "\n" + line("vertex", 2, "A", {}) + "\n" + half[:9])
    assert drain() == [1, 2]
    with (source / "a").open("a") as file:
        file.write(half[9:] + "\n")
    (source / "b").write_text(line("vertex", 4, "A", {}) + "\n")
    assert drain() == [1, 2, 3, 4]
    assert drain() == [1, 2, 3, 4]


def test_missing_folder_and_bad_split(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFoundError"):
        read_dump(spark, str(tmp_path / "none")).count()
    with pytest.raises(ValueError, match="splitBytes"):
        dumps.DumpReader({"path": "x", "splitBytes": "0"})
    assert list(_lines(Split(__file__, 0, 1)))[0].startswith(b"import gzip")


def test_typed_profile(spark):
    texts = ['{"a": 1, "b": null, "c": {"x": 1}}', '{"a": 2.5, "c": {"x": "q"}, "d": "t"}', "[1]", "7", "oops", None, "{}"]
    rows = spark.createDataFrame([("L", t) for t in texts] + [("M", "{}"), ("_ag_x", '{"a": 1}')], "label string, props string")
    found = {(r.label, r.key): (r.type, r.n_rows, r.n_null) for r in schema.variant_properties(rows, "label").collect()}
    assert found[("L", "b")] == ("VOID", 1, 1) and found[("L", "d")] == ("STRING", 1, 0)
    assert found[("L", "a")][0].startswith("DECIMAL") and found[("L", "c")] == ("OBJECT<x: VARIANT>", 2, 0)
    assert set(found) == {("L", k) for k in "abcd"}
    variants = rows.select("label", F.try_parse_json("props").alias("props"))
    assert {(r.label, r.key): (r.type, r.n_rows, r.n_null) for r in schema.variant_properties(variants, "label").collect()} == found
    columns = schema.discover(rows, "label")
    assert columns["M"] == "" and columns["L"].endswith("`b` string, `c` string, `d` string") and set(columns) == {"L", "M"}


def test_typed_profile_of_maps_and_nothing(spark):
    rows = spark.createDataFrame([("L", {"a": "1", "b": "x y", "c": None}), ("L", {"a": "3", "b": "5"})], "label string, props map<string,string>")
    found = {r.key: (r.type, r.n_rows, r.n_null) for r in schema.variant_properties(rows, "label").collect()}
    assert found == {"a": ("BIGINT", 2, 0), "b": ("VARIANT", 2, 0), "c": ("VOID", 1, 1)}
    assert schema.variant_properties(rows.limit(0), "label").collect() == [] and schema.discover(rows.limit(0), "label") == {}


def test_lines_of_other_kinds_are_not_parsed(monkeypatch):
    from vinework.sources import dumps

    lines = [b'{"id": 1, "label": "A", "properties": {"x": 1}}::vertex', b'{"id": 2, "label": "B"}::edge', b"junk", b'{"id": 3, "label": "A"}:: Vertex ', b"{::edge"]
    plain, parsed = dumps._entity, []
    monkeypatch.setattr(dumps, "_entity", lambda line, *more: parsed.append(line) or plain(line, *more))

    def ids(kinds):
        return [i for b in dumps._batches(iter(lines), {"kinds": kinds}) for i in b.column("id").to_pylist()]

    assert ids({"vertex"}) == [1, 3] and len(parsed) == 3
    parsed.clear()
    assert ids({"edge", "other"}) == [2, None, None] and len(parsed) == 5
