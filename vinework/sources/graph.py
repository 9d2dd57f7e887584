"""Property graphs as node and edge DataFrames, and their bucketed storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.functions.filters import label_allowed
from vinework.sources.buckets import BucketedTable

EDGE_COLUMNS = ("id", "start_id", "end_id", "src_label", "dst_label")

# Fixed value: prefix of labels that belong to the system.
INTERNAL_PREFIX = "_ag_"

# Bits of a graph id left to the key below the label number.
KEY_BITS = 48


def graph_id(label_no: int, key: Column) -> Column:
    """Graph id from a label number and a whole-number key: no collisions.

    A key outside 0 .. 2**48-1 raises, since it would run into another label.
    """
    wide = key.cast("bigint")
    fits = (wide >= 0) & (wide < (1 << KEY_BITS))
    combined = F.shiftleft(F.lit(label_no).cast("bigint"), KEY_BITS).bitwiseOR(wide)
    complaint = F.raise_error(F.concat(F.lit("key does not fit a graph id: "), wide.cast("string")))
    return F.when(wide.isNull() | fits, combined).otherwise(complaint)


def text_id(label: str | Column, key: Column) -> Column:
    """Graph id for text keys: the label and the key, hence unique."""
    label = F.lit(label) if isinstance(label, str) else label
    return F.concat_ws(":", label, key.cast("string"))


@dataclass(frozen=True)
class PropertyGraph:
    """Node frames by label and edge frames by type.

    Node frames have ``id`` plus property columns, edge frames have
    ``id, start_id, end_id, src_label, dst_label`` plus property columns. Edges
    refer to existing nodes, so a pattern needs a node table only when it uses
    a node property.
    """

    node_frames: Mapping[str, DataFrame] = field(default_factory=dict)
    edge_frames: Mapping[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for label, frame in self.node_frames.items():
            if "id" not in frame.columns:
                raise ValueError(f"nodes of {label!r} need a column id")
        for name, frame in self.edge_frames.items():
            missing = [c for c in EDGE_COLUMNS if c not in frame.columns]
            if missing:
                raise ValueError(f"edges of {name!r} lack {missing}")

    @property
    def labels(self) -> list[str]:
        return sorted(label for label in self.node_frames if not label.startswith(INTERNAL_PREFIX))

    @property
    def types(self) -> list[str]:
        return sorted(name for name in self.edge_frames if not name.startswith(INTERNAL_PREFIX))

    def nodes(self, label: str | None = None) -> DataFrame:
        """Nodes of one label, or of all labels with missing properties null."""
        if label is not None:
            return self.node_frames[label].withColumn("label", F.lit(label))
        return _union([self.nodes(name) for name in self.labels])

    def edges(self, edge_type: str | None = None) -> DataFrame:
        """Edges of one type, or of all types."""
        if edge_type is not None:
            return self.edge_frames[edge_type].withColumn("type", F.lit(edge_type))
        return _union([self.edges(name) for name in self.types])

    def edge_ends(self, edge_type: str | None = None) -> DataFrame:
        """Edges without properties, for operators that need only the shape."""
        if edge_type is not None:
            return self.edges(edge_type).select(*EDGE_COLUMNS, "type")
        return _union([self.edge_ends(name) for name in self.types])

    def restricted(self, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> PropertyGraph:
        """Graph with only the allowed labels and edge types."""

        def keep(names: Sequence[str]) -> list[str]:
            return [n for n in names if (not include or n in include) and n not in exclude]

        return PropertyGraph(
            {n: self.node_frames[n] for n in keep(self.labels)},
            {n: self.edge_frames[n] for n in keep(self.types)},
        )

    @classmethod
    def from_bags(
        cls, nodes: DataFrame, edges: DataFrame, labels: Mapping[str, str], types: Mapping[str, str]
    ) -> PropertyGraph:
        """Typed graph over tables of property bags.

        ``labels`` and ``types`` give the properties to expose per label and
        edge type as a column list such as ``"name string, age bigint"``. The
        key of a node within its label is its property ``id`` and becomes the
        column ``key``; graph ids are label and key.
        """
        node_frames = {
            label: nodes.filter(F.col("label") == label).select(
                text_id(label, F.col("id")).alias("id"), F.col("id").alias("key"), *_exposed(columns)
            )
            for label, columns in labels.items()
        }
        edge_frames = {
            name: edges.filter(F.col("type") == name).select(
                F.concat_ws("|", "type", "src_label", "src_id", "dst_label", "dst_id").alias("id"),
                text_id(F.col("src_label"), F.col("src_id")).alias("start_id"),
                text_id(F.col("dst_label"), F.col("dst_id")).alias("end_id"),
                "src_label", "dst_label", *_exposed(columns),
            )
            for name, columns in types.items()
        }
        return cls(node_frames, edge_frames)

    def save(self, path: str) -> None:
        """Write every frame to its own Parquet folder."""
        for label, frame in self.node_frames.items():
            frame.write.mode("overwrite").parquet(f"{path.rstrip('/')}/nodes/{label}")
        for name, frame in self.edge_frames.items():
            frame.write.mode("overwrite").parquet(f"{path.rstrip('/')}/edges/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, labels: Sequence[str], types: Sequence[str]) -> PropertyGraph:
        """Open the named frames of a saved graph."""
        path = path.rstrip("/")
        return cls(
            {n: spark.read.parquet(f"{path}/nodes/{n}") for n in labels},
            {n: spark.read.parquet(f"{path}/edges/{n}") for n in types},
        )

    def entities(self) -> DataFrame:
        """Every node as ``id`` and ``entity``, its ``struct<id,label,properties>``; ids as text, so labels may differ in type."""
        parts = []
        for name in self.labels:
            frame = self.node_frames[name]
            properties = [c for c in frame.columns if c != "id"]
            filled = bag(*properties) if properties else empty_bag()
            id_ = F.col("id").cast("string")
            parts.append(frame.select(id_.alias("id"), F.struct(id_.alias("id"), F.lit(name).alias("label"), filled.alias("properties")).alias("entity")))
        return _union(parts)

    def duplicate_ids(self) -> DataFrame:
        """Node ids that occur more than once over all labels; empty when sound."""
        ids = reduce(DataFrame.unionAll, [self.node_frames[n].select("id") for n in self.labels])
        return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _exposed(columns: str) -> list[Column]:
    """Bag entries as typed columns; JSON texts lose their quotes, other texts are strings."""
    if not columns.strip():
        return []
    fields = T._parse_datatype_string(columns).fields
    values = [(f, F.try_element_at("props", F.lit(f.name))) for f in fields]
    # A text that is no JSON stands for itself.
    parsed = [(f, F.coalesce(F.try_parse_json(v), v.cast("variant"))) for f, v in values]
    return [F.try_variant_get(v, "$", f.dataType.simpleString()).alias(f.name) for f, v in parsed]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("the graph has no such frames")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def vertex(prefix: str, properties: Column | None = None) -> Column:
    """Node entity ``struct<id,label,properties>`` from pattern columns."""
    bag = F.coalesce(properties, empty_bag()) if properties is not None else empty_bag()
    return F.struct(
        F.col(f"{prefix}.id").alias("id"), F.col(f"{prefix}.label").alias("label"), bag.alias("properties")
    )


def edge(prefix: str, properties: Column | None = None) -> Column:
    """Edge entity ``struct<id,label,start_id,end_id,properties>``."""
    bag = F.coalesce(properties, empty_bag()) if properties is not None else empty_bag()
    return F.struct(
        F.col(f"{prefix}.id").alias("id"),
        F.col(f"{prefix}.type").alias("label"),
        F.col(f"{prefix}.start_id").alias("start_id"),
        F.col(f"{prefix}.end_id").alias("end_id"),
        bag.alias("properties"),
    )


def empty_bag() -> Column:
    return F.from_json(F.lit("{}"), "map<string,string>")


def bag(*names: str) -> Column:
    """Property bag of typed columns: JSON scalars, null properties left out."""
    # to_json writes no null fields; parsing keeps each value's JSON text.
    return F.from_json(F.to_json(F.struct(*(F.col(f"`{n}`").alias(n) for n in names))), "map<string,string>")


def allowed(df: DataFrame, column: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    return df.filter(label_allowed(F.col(column), include, exclude))


NODE_SCHEMA = "label string, id string, props map<string,string>"
EDGE_SCHEMA = (
    "type string, src_label string, src_id string, dst_label string, dst_id string, props map<string,string>"
)


class GraphStore:
    """Graph of property bags on disk: one node table and one edge table.

    Both are partitioned by a hash bucket of the key, so an upsert rewrites
    only the buckets it touches.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.node_table = BucketedTable(spark, f"{self.path}/nodes", NODE_SCHEMA, ("label", "id"), buckets)
        self.edge_table = BucketedTable(
            spark, f"{self.path}/edges", EDGE_SCHEMA, ("type", "src_label", "src_id", "dst_label", "dst_id"), buckets
        )

    def create(self) -> GraphStore:
        """Create the graph unless it exists."""
        self.node_table.create()
        self.edge_table.create()
        return self

    def drop(self) -> None:
        """Delete the graph and all its data."""
        self.node_table.drop()
        self.edge_table.drop()

    def nodes(self) -> DataFrame:
        return self.node_table.read()

    def edges(self) -> DataFrame:
        return self.edge_table.read()

    def graph(self, labels: Mapping[str, str], types: Mapping[str, str]) -> PropertyGraph:
        """Typed view for patterns and traversals; see :meth:`PropertyGraph.from_bags`."""
        return PropertyGraph.from_bags(self.nodes(), self.edges(), labels, types)

    def discovered(self) -> PropertyGraph:
        """Typed view of all labels, edge types and properties that the store holds, with the types its values have."""
        from vinework.operators.schema import discover

        return self.graph(discover(self.nodes(), "label"), discover(self.edges(), "type"))

    def merge(self, documents: DataFrame, include_source: bool = False) -> None:
        """Upsert graph documents; see :func:`vinework.operators.merge.changed_rows`."""
        from vinework.operators.merge import changed_rows

        nodes, edges = changed_rows(
            documents, self.node_table.matching, self.edge_table.matching, include_source=include_source
        )
        self.node_table.put(nodes)
        self.edge_table.put(edges)
