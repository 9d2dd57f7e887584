import pytest
from pyspark.sql import functions as F

from vinework.functions.filters import MetadataFilter, label_allowed, metadata_filter, text_equals_all

ROWS = [
    (1, '{"k": 5, "s": "Alpha"}'),
    (2, '{"k": 7.5, "s": "beta"}'),
    (3, '{"k": null, "s": "alpha"}'),
    (4, '{"s": "5"}'),
    (5, '{"k": true}'),
    (6, None),
    (7, "{}"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, metadata string")


def ids(rows, spec, **options):
    where = metadata_filter(spec, **options)
    return sorted(r.id for r in (rows if where is None else rows.filter(where)).collect())


# The non-numeric row 5 makes numeric comparisons fail unless bad values are nulls.
@pytest.mark.parametrize(
    ("spec", "expected"),
    [
        ({"k": 5}, [1]),
        ({"k": "5"}, [1]),
        ({"k": True}, [5]),
        ({"k": {"$eq": 5}}, [1]),
        ({"k": {"$ne": 5}}, [2, 5]),
        ({"k": {"$lt": 7.5}}, [1]),
        ({"k": {"$lte": 7.5}}, [1, 2]),
        ({"k": {"$gt": 5}}, [2]),
        ({"k": {"$gte": 5}}, [1, 2]),
        ({"k": {"$between": [5, 7.5]}}, [1, 2]),
        ({"k": {"$in": [5, 7.5]}}, [1, 2]),
        ({"k": {"$in": []}}, []),
        ({"k": {"$nin": [5]}}, [2, 5]),
        ({"k": {"$nin": []}}, [1, 2, 5]),
        ({"k": {"$exists": True}}, [1, 2, 3, 5]),
        ({"k": {"$exists": False}}, [4, 6, 7]),
        ({"s": {"$like": "%lpha"}}, [1, 3]),
        ({"s": {"$like": "a%"}}, [3]),
        ({"s": {"$ilike": "A%"}}, [1, 3]),
        ({"s": "Alpha", "k": {"$gt": 1, "$lt": 6}}, [1]),
        ({"$and": [{"s": {"$ilike": "a%"}}, {"k": {"$exists": True}}]}, [1, 3]),
        ({"$or": [{"s": "5"}, {"$and": [{"k": 5}, {"s": "Alpha"}]}]}, [1, 4]),
        ({}, [1, 2, 3, 4, 5, 6, 7]),
        (None, [1, 2, 3, 4, 5, 6, 7]),
    ],
)
def test_truth_table(rows, spec, expected):
    assert ids(rows, spec, on_bad="null") == expected


def test_non_numeric_value_raises_by_default(rows):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ids(rows, {"k": {"$lt": 3}})


def test_map_column_gives_the_same(spark, rows):
    bags = rows.withColumn("metadata", F.from_json("metadata", "map<string,string>"))
    assert ids(bags, {"k": {"$exists": True}}, is_map=True) == [1, 2, 3, 5]


def test_nesting_limit(spark):
    spec = {"k": 1}
    for _ in range(10):
        spec = {"$and": [spec]}
    assert metadata_filter(spec) is not None
    with pytest.raises(ValueError, match="maximum depth"):
        metadata_filter({"$or": [spec]})


@pytest.mark.parametrize(
    ("spec", "message"),
    [
        ({"k": {"$foo": 1}}, "Unsupported filter operator"),
        ({"$and": []}, "at least one"),
        ({"k": {}}, "no operator"),
    ],
)
def test_malformed_filters_raise(spark, spec, message):
    with pytest.raises(ValueError, match=message):
        metadata_filter(spec)


def test_siblings_of_and_are_ignored_or_raise(rows):
    spec = {"$and": [{"s": "Alpha"}], "s": "beta"}
    assert ids(rows, spec) == [1]
    with pytest.raises(ValueError, match="ignored"):
        metadata_filter(spec, strict=True)


def test_promoted_column_is_pushed_down(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 7).alias("year")).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    where = MetadataFilter(F.lit("{}"), promoted={"year": "year"}).compile({"year": {"$gte": 5}})
    plan = rows.filter(where)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(year,5)" in plan
    assert rows.filter(where).count() == 28


def test_boolean_start_filter_reads_as_json(spark):
    rows = spark.createDataFrame([(1, True), (2, False)], "id int, flag boolean")
    assert [r.id for r in rows.filter(text_equals_all({"flag": True})).collect()] == [1]


def test_labels_whitelist_then_blacklist(spark):
    rows = spark.createDataFrame([("A",), ("B",), ("C",)], "label string")

    def kept(**lists):
        return sorted(r.label for r in rows.filter(label_allowed(F.col("label"), **lists)).collect())

    assert kept() == ["A", "B", "C"]
    assert kept(include=["A", "B"], exclude=["B"]) == ["A"]
    assert kept(exclude=["A"]) == ["B", "C"]
