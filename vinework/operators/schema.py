"""Graph schema profiles: property keys, connection triples, rendered text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.functions.filters import label_allowed
from vinework.sources.graph import EDGE_COLUMNS, INTERNAL_PREFIX, PropertyGraph

# Headings and placeholder of the rendered schema.
NODE_HEADING = "Node labels and properties:"
EDGE_HEADING = "Relationship types and properties:"
TRIPLE_HEADING = "Relationship patterns:"
NO_PROPERTIES = "(no properties sampled)"
UNKNOWN_LABEL = "Unknown"


def bag_properties(rows: DataFrame, label: str, props: str = "props") -> DataFrame:
    """Sorted distinct keys of property bags per label: ``label, properties``.

    Keys are made distinct before they are collected, so a group never holds
    more than one entry per property name.
    """
    keys = rows.filter(~F.col(label).startswith(INTERNAL_PREFIX)).select(
        F.col(label).alias("label"), F.explode_outer(F.map_keys(props)).alias("_key")
    )
    return keys.distinct().groupBy("label").agg(F.array_sort(F.collect_list("_key")).alias("properties"))


def variant_properties(rows: DataFrame, label: str, props: str = "props") -> DataFrame:
    """Typed keys of property bags: ``label, key, type, n_rows, n_null``.

    ``props`` is a VARIANT, a JSON text, which is parsed once for all keys, or
    a map of JSON scalars, in which other texts are strings. ``type`` is the
    least type that holds all values of the key, ``VARIANT`` where there is
    none and ``VOID`` where all are JSON null. ``n_rows`` counts the bags with
    the key and ``n_null`` those where it is JSON null. Bags that are no object
    have no keys. Tasks merge types first, so a row per label, key and task is
    shuffled, whatever the number of bags.
    """
    return _keyed_values(rows, label, props).filter(F.col("key").isNotNull()).groupBy("label", "key").agg(
        F.schema_of_variant_agg("_value").alias("type"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_value").isNull() | F.is_variant_null("_value")).alias("n_null"),
    )


def _keyed_values(rows: DataFrame, label: str, props: str) -> DataFrame:
    """``label, key, _value``; a bag without keys has one row without a key."""
    named = rows.filter(~F.col(label).startswith(INTERNAL_PREFIX)).select(F.col(label).alias("label"), F.col(props).alias("_bag"))
    if isinstance(named.schema["_bag"].dataType, T.MapType):
        found = named.select("label", F.explode_outer("_bag").alias("key", "_text"))
        value = F.coalesce(F.try_parse_json("_text"), F.col("_text").cast("variant"))
        return found.select("label", "key", value.alias("_value"))
    if isinstance(named.schema["_bag"].dataType, T.StringType):
        named = named.withColumn("_bag", F.try_parse_json("_bag"))
    entries = rows.sparkSession.tvf.variant_explode_outer(F.col("_bag").outer())
    return named.lateralJoin(entries).select("label", "key", F.col("value").alias("_value"))


# Variant types that a column can have as they are; columns of all other properties hold texts.
COLUMN_TYPES = ("BIGINT", "DOUBLE", "BOOLEAN", "STRING", "DECIMAL", "DATE", "TIMESTAMP", "FLOAT")


def discover(rows: DataFrame, label: str, props: str = "props") -> dict[str, str]:
    """Every label with the typed column list of its properties, as ``PropertyGraph.from_bags`` takes it.

    What reaches the driver is a row per label. The property ``id`` is the key
    of a node and is left out.
    """
    wanted = F.col("key").isNotNull() & (F.col("key") != "id")
    typed = _keyed_values(rows, label, props).groupBy("label", "key").agg(F.schema_of_variant_agg("_value").alias("type"))
    kept = reduce(lambda a, b: a | b, [F.col("type").startswith(t) for t in COLUMN_TYPES])
    quoted = F.concat(F.lit("`"), F.replace("key", F.lit("`"), F.lit("``")), F.lit("` "))
    entry = F.when(wanted, F.concat(quoted, F.when(kept, F.lower("type")).otherwise("string")))
    listed = typed.groupBy("label").agg(F.array_join(F.array_sort(F.collect_list(entry)), ", ").alias("columns"))
    return {row["label"]: row["columns"] for row in listed.collect()}


def typed_properties(graph: PropertyGraph, kind: str) -> DataFrame:
    """Property columns per label or edge type, read from the schemas alone."""
    frames, hidden = (graph.node_frames, {"id"}) if kind == "node" else (graph.edge_frames, set(EDGE_COLUMNS))
    names = graph.labels if kind == "node" else graph.types
    rows = [(n, sorted(c for c in frames[n].columns if c not in hidden)) for n in names]
    return SparkSession.active().createDataFrame(rows, "label string, properties array<string>")


def triples(edges: DataFrame) -> DataFrame:
    """Distinct ``start, type, end`` over all edges."""
    start = F.coalesce(F.nullif(F.col("src_label"), F.lit("")), F.lit(UNKNOWN_LABEL))
    end = F.coalesce(F.nullif(F.col("dst_label"), F.lit("")), F.lit(UNKNOWN_LABEL))
    named = edges.select(start.alias("start"), F.col("type"), end.alias("end"))
    return named.filter(~F.col("type").startswith(INTERNAL_PREFIX)).distinct()


def graph_triples(graph: PropertyGraph) -> DataFrame:
    """Triples of a typed graph; each type is reduced before the union. A graph without edge types has none."""
    found = [triples(graph.edge_ends(name)) for name in graph.types]
    none = [] if found else [SparkSession.active().createDataFrame([], "start string, type string, end string")]
    return reduce(DataFrame.unionByName, found or none)


def restrict_store(profile: DataFrame, found: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Store-level restriction: the lists apply to labels and to edge types."""
    return (
        profile.filter(label_allowed(F.col("label"), include, exclude)),
        found.filter(label_allowed(F.col("type"), include, exclude)),
    )


def restrict_question(profile: DataFrame, found: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Question-level restriction: triples are judged by both end labels only."""
    ends = label_allowed(F.col("start"), include, exclude) & label_allowed(F.col("end"), include, exclude)
    return profile.filter(label_allowed(F.col("label"), include, exclude)), found.filter(ends)


def render(node_profile: DataFrame, edge_profile: DataFrame, found: DataFrame) -> DataFrame:
    """Schema text as one row with the column ``schema_text``.

    The inputs have one row per label, type or triple, so the text is small.
    """

    def lines(df: DataFrame, template: str) -> DataFrame:
        shown = F.coalesce(F.nullif(F.array_join("properties", ", "), F.lit("")), F.lit(NO_PROPERTIES))
        line = F.format_string(template, F.col("label"), shown)
        return _section(df.select(line.alias("line")))

    nodes = lines(node_profile, "  :%s {%s}")
    edges = lines(edge_profile, "  [:%s] {%s}")
    shape = _section(found.select(F.format_string("  (:%s)-[:%s]->(:%s)", "start", "type", "end").alias("line")))
    return nodes.select(
        F.concat_ws(
            "\n",
            F.concat(F.lit(NODE_HEADING), F.col("body")),
            F.lit(""),
            F.concat(F.lit(EDGE_HEADING), edges.scalar()),
            F.lit(""),
            F.concat(F.lit(TRIPLE_HEADING), shape.scalar()),
        ).alias("schema_text")
    )


def _section(lines: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list("line"))
    return lines.agg(F.array_join(F.transform(ordered, lambda line: F.concat(F.lit("\n"), line)), "").alias("body"))


def describe(graph: PropertyGraph, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Rendered schema of a typed graph, optionally restricted at store level."""
    kept = graph.restricted(include, exclude)
    return render(typed_properties(kept, "node"), typed_properties(kept, "edge"), graph_triples(kept))
