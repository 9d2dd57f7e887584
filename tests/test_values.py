import pytest
from pyspark.sql import functions as F

from vinework.functions import querylog, values
from vinework.operators.profile import latency_profile


def column(spark, rows, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {dtype}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_tagged_texts(spark):
    rows = [
        '{"id": 1, "label": "A", "properties": {}}::vertex', "42::integer", " 3.14::FLOAT ", "true", "hello world",
        None, '[{"id": 1}, {"id": 2}]::path', '"quoted"', "null", "1::integer::numeric",
    ]
    parsed = column(spark, rows, values.parse_tagged)
    assert [p.kind for p in parsed] == ["object", "number", "number", "boolean", "text", None, "array", "string", "null", "text"]
    assert parsed[0].raw == '{"id": 1, "label": "A", "properties": {}}'
    assert (parsed[1].raw, parsed[2].raw, parsed[4].raw, parsed[9].raw) == ("42", "3.14", "hello world", "1::integer")


def test_sanitise_nested_values(spark):
    df = spark.createDataFrame(
        [("x" * 1001, {"a": "y" * 1001, "_b": "z"}, ["w" * 1000, "w" * 1001], 5)],
        "t string, m map<string,string>, l array<string>, n int",
    )
    df = df.withColumn("_hidden", F.lit(1)).withColumn("s", F.struct("t", F.lit(1).alias("_k")))
    row = values.sanitise_frame(df).first()
    assert row.t == "x" * 1000 + "…" and row.m == {"a": "y" * 1000 + "…"} and row.l == ["w" * 1000, "w" * 1000 + "…"]
    assert row.n == 5 and row.s.asDict() == {"t": "x" * 1000 + "…"} and "_hidden" not in row.asDict()


def test_json_access(spark):
    rows = ['{"a": 1, "b": null, "c": {"d": 2}}', None]
    assert column(spark, rows, lambda v: values.json_value(v, "a")) == ["1", None]
    assert column(spark, rows, lambda v: values.json_value(v, "b")) == [None, None]
    assert column(spark, rows, lambda v: values.json_value(v, "c")) == ["{\"d\":2}", None]
    assert column(spark, rows, values.bag_keys) == [["a", "b", "c"], None]


@pytest.mark.parametrize(
    ("text", "problem"),
    [
        ("MATCH (n) RETURN n", None),
        ("unwind [1] as x", None),
        ("", querylog.EMPTY),
        (" \n\t ", querylog.EMPTY),
        ("RETURN $$", querylog.DOLLARS),
        ("hello", querylog.NO_CLAUSE),
        ("rematch settle", querylog.NO_CLAUSE),
    ],
)
def test_query_check(spark, text, problem):
    assert column(spark, [text], querylog.check_query) == [problem]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("MATCH (n) RETURN n", ["n"]),
        ("MATCH (n) RETURN n.name AS person, n.age", ["person", "age"]),
        ("MATCH (n) return count(n) as total ORDER BY total", ["total"]),
        ("MATCH (n) RETURN n.a,\n n.b LIMIT 3", ["a", "b"]),
        ("CREATE (n)", ["result"]),
        ("MATCH (n) RETURN coalesce(n.a, max(1, f(2, 3))) AS x, n.b", ["x", "b"]),
        ("MATCH (n) RETURN {a: 1, b: 2} AS m, [1, 2] AS l, 'p, q' AS t SKIP 2", ["m", "l", "t"]),
        ("MATCH (n) RETURN DISTINCT n", ["n"]),
    ],
)
def test_return_columns(spark, text, names):
    assert column(spark, [text], querylog.return_columns) == [names]


def test_fences(spark):
    rows = ["```cypher\nMATCH (n)\nRETURN n\n```", " RETURN 1 ", "a ``` b"]
    assert column(spark, rows, querylog.strip_fences) == ["MATCH (n)\nRETURN n", "RETURN 1", "a ``` b"]


@pytest.mark.parametrize("n", [1, 2, 99, 100, 101, 1000])
def test_profile_positions(spark, n):
    rows = spark.range(n).select((F.col("id") * 37 % n).cast("double").alias("v"))
    row = latency_profile(rows, "v").first()
    ordered = list(range(n))
    middle = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    assert (row.n, row.p50, row.p99, row.min, row.max) == (n, middle, ordered[int(n * 0.99)], 0, n - 1)
    assert row["mean"] == pytest.approx((n - 1) / 2)


def test_profile_with_a_hot_group(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 100).cast("string")).alias("g"),
        F.when(F.col("id") % 6 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("v"),
    )
    found = {r.g: r for r in latency_profile(rows.repartition(9), "v", "g").collect()}
    values_ = {}
    for r in rows.collect():
        values_.setdefault(r.g, []).append(r.v)
    for g, vs in values_.items():
        vs.sort()
        n = len(vs)
        assert (found[g].n, found[g].p99) == (n, vs[int(n * 0.99)])
        assert found[g].p50 == (vs[(n - 1) // 2] + vs[n // 2]) / 2
