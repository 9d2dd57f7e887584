"""Graph patterns as joins: single hops, chains, optional hops, fixed-length paths."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinework.functions.filters import equals_all
from vinework.runtime import cut_lineage
from vinework.sources.graph import EDGE_COLUMNS, PropertyGraph, bag, empty_bag

# Node columns that every edge already knows about its ends.
KNOWN = ("id", "label")


@dataclass(frozen=True)
class _Hop:
    edge: str
    edge_type: str | None
    node: str
    direction: str
    optional: bool


@dataclass(frozen=True)
class Pattern:
    """A chain of hops, built step by step and turned into joins at the end.

    Node tables are joined only for variables whose properties are used;
    ids and labels come from the edges. An edge is used at most once per match.
    """

    graph: PropertyGraph
    labels: tuple[tuple[str, str | None], ...]
    hops: tuple[_Hop, ...] = ()
    conditions: tuple[tuple[str, Column], ...] = ()

    def out(self, edge: str, edge_type: str | None, node: str, label: str | None = None, optional: bool = False) -> Pattern:
        """Follow edges from start to end."""
        return self._hop(edge, edge_type, node, label, "out", optional)

    def into(self, edge: str, edge_type: str | None, node: str, label: str | None = None, optional: bool = False) -> Pattern:
        """Follow edges from end to start."""
        return self._hop(edge, edge_type, node, label, "in", optional)

    def both(self, edge: str, edge_type: str | None, node: str, label: str | None = None, optional: bool = False) -> Pattern:
        """Follow edges either way; a self-loop matches once."""
        return self._hop(edge, edge_type, node, label, "both", optional)

    def _hop(self, edge, edge_type, node, label, direction, optional) -> Pattern:
        taken = {name for name, _ in self.labels} | {h.edge for h in self.hops}
        if edge in taken or node in taken or edge == node:
            raise ValueError(f"variable used twice: {edge!r}, {node!r}")
        hop = _Hop(edge, edge_type, node, direction, optional)
        return replace(self, labels=(*self.labels, (node, label)), hops=(*self.hops, hop))

    def where(self, variable: str, condition: Column | None = None, **equals) -> Pattern:
        """Restrict one variable by a condition on its properties or by equality.

        The condition names plain columns of that variable's table.
        """
        terms = [c for c in (condition, equals_all(equals)) if c is not None]
        return replace(self, conditions=(*self.conditions, *((variable, c) for c in terms)))

    def returns(self, *items: str, **named: str) -> DataFrame:
        """Project ``var.property`` items; ``alias='var.property'`` renames.

        An item is named after its property and a bare variable gives its id
        under the variable's name. Names must be unique.
        """
        wanted = [(_output_name(item), item) for item in items] + list(named.items())
        names = [name for name, _ in wanted]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate output names: {names}")
        used = [(item.split(".", 1) if "." in item else [item, "id"]) for _, item in wanted]
        matches = self.matches(*(f"{var}.{prop}" for var, prop in used))
        return matches.select(*(F.col(f"{var}.{prop}").alias(name) for (name, _), (var, prop) in zip(wanted, used)))

    def matches(self, *items: str) -> DataFrame:
        """One row per match with a struct column per variable.

        ``items`` lists the ``var.property`` values that are needed. An edge
        variable has ``id, type, start_id, end_id``, a node variable ``id`` and
        ``label``, each plus the requested properties.
        """
        needed: dict[str, list[str]] = {}
        for item in items:
            var, prop = item.split(".", 1)
            needed.setdefault(var, [])
            if prop not in needed[var]:
                needed[var].append(prop)
        label_of = dict(self.labels)
        first = self.labels[0][0]
        rows = None
        earlier: list[_Hop] = []
        at = first
        for hop in self.hops:
            step = self._edges(hop, needed.get(hop.edge, []), at if rows is None else None, label_of)
            if rows is None:
                if hop.optional or self._touches(first, needed):
                    rows = self._node(first, label_of[first], needed)
                else:
                    rows = step.withColumnsRenamed({"_near": first, "_far": hop.node})
                    rows = self._bind_far(rows, hop, label_of, needed)
                    earlier.append(hop)
                    at = hop.node
                    continue
            rows = self._join(rows, step, hop, at, earlier, label_of, needed)
            earlier.append(hop)
            at = hop.node
        return rows if rows is not None else self._node(first, label_of[first], needed)

    def _touches(self, var: str, needed: dict[str, list[str]]) -> bool:
        wants = any(prop not in KNOWN for prop in needed.get(var, []))
        return wants or any(v == var for v, _ in self.conditions)

    def _restricted(self, var: str, frame: DataFrame) -> DataFrame:
        return reduce(lambda df, c: df.filter(c[1]) if c[0] == var else df, self.conditions, frame)

    def _node(self, var: str, label: str | None, needed: dict[str, list[str]]) -> DataFrame:
        frame = self._restricted(var, self.graph.nodes(label))
        props = [p for p in needed.get(var, []) if p not in KNOWN]
        fields = [F.col("id"), F.col("label")]
        fields += [(F.col(f"`{p}`") if p in frame.columns else F.lit(None)).alias(p) for p in props]
        return frame.select(F.struct(*fields).alias(var))

    def _edges(self, hop: _Hop, props: Sequence[str], near_var: str | None, label_of: dict) -> DataFrame:
        base = self._restricted(hop.edge, self.graph.edges(hop.edge_type))
        extra = [p for p in props if p not in ("id", "type", "start_id", "end_id")]
        fields = [F.col(c) for c in ("id", "type", "start_id", "end_id")]
        fields += [(F.col(f"`{p}`") if p in base.columns else F.lit(None)).alias(p) for p in extra]
        entity = F.struct(*fields).alias(hop.edge)
        start = F.struct(F.col("start_id").alias("id"), F.col("src_label").alias("label"))
        end = F.struct(F.col("end_id").alias("id"), F.col("dst_label").alias("label"))
        parts = []
        if hop.direction in ("out", "both"):
            parts.append(base.select(entity, start.alias("_near"), end.alias("_far")))
        if hop.direction in ("in", "both"):
            back = base.filter(F.col("start_id") != F.col("end_id")) if hop.direction == "both" else base
            parts.append(back.select(entity, end.alias("_near"), start.alias("_far")))
        step = reduce(DataFrame.unionByName, parts)
        if label_of[hop.node] is not None:
            step = step.filter(F.col("_far.label") == label_of[hop.node])
        if near_var is not None and label_of[near_var] is not None:
            step = step.filter(F.col("_near.label") == label_of[near_var])
        return step

    def _bind_far(self, step: DataFrame, hop: _Hop, label_of: dict, needed: dict) -> DataFrame:
        """Replace the bare end of a step by the node entity when it is used."""
        if not self._touches(hop.node, needed):
            return step
        nodes = self._node(hop.node, label_of[hop.node], needed).withColumnRenamed(hop.node, "_node")
        joined = step.join(nodes, F.col(f"{hop.node}.id") == F.col("_node.id"))
        return joined.drop(hop.node).withColumnRenamed("_node", hop.node)

    def _join(self, rows, step, hop, at, earlier, label_of, needed) -> DataFrame:
        step = self._bind_far(step.withColumnRenamed("_far", hop.node), hop, label_of, needed)
        condition = F.col(f"{at}.id") == F.col("_near.id")
        for other in earlier:
            if other.edge_type == hop.edge_type or None in (other.edge_type, hop.edge_type):
                condition &= F.col(f"{other.edge}.id") != F.col(f"{hop.edge}.id")
        return rows.join(step, condition, "left" if hop.optional else "inner").drop("_near")


def match(graph: PropertyGraph, node: str, label: str | None = None, **equals) -> Pattern:
    """Start a pattern at a node variable."""
    pattern = Pattern(graph, ((node, label),))
    return pattern.where(node, **equals) if equals else pattern


def _output_name(item: str) -> str:
    return item.rsplit(".", 1)[-1]


def degree(graph: PropertyGraph, edge_type: str | None, direction: str = "out", *, src: str | None = None, dst: str | None = None) -> DataFrame:
    """Matches per node of a single hop: ``id, n``.

    Counts before any join, so a hub is reduced to one number in each task.
    """
    ends = graph.edge_ends(edge_type)
    if src is not None:
        ends = ends.filter(F.col("src_label") == src)
    if dst is not None:
        ends = ends.filter(F.col("dst_label") == dst)
    near = "start_id" if direction == "out" else "end_id"
    return ends.groupBy(F.col(near).alias("id")).agg(F.count(F.lit(1)).alias("n"))


def paths(graph: PropertyGraph, edge_type: str, hops: int, starts: DataFrame | None = None, cut_every: int = 4) -> DataFrame:
    """Every walk of exactly ``hops`` edges without a repeated edge.

    Output ``start_id, end_id, edge_ids``. With ``starts`` (a frame with
    ``id``) walks grow hop by hop from few nodes. Without, walks of half the
    length are joined with each other, which moves the short halves through
    the shuffle instead of the long walks.
    """
    if hops < 1:
        raise ValueError("hops must be at least 1")
    single = graph.edge_ends(edge_type).select("start_id", "end_id", F.array("id").alias("edge_ids"))
    if starts is None:
        return _halves(single, hops)
    walks = single.join(starts.select(F.col("id").alias("start_id")), "start_id", "left_semi")
    for hop in range(2, hops + 1):
        walks = _concatenate(walks, single)
        if hop % cut_every == 0 and hop < hops:
            walks = cut_lineage(walks, "walks")
    return walks


def _halves(single: DataFrame, hops: int) -> DataFrame:
    """Walks from walks of half the length; a half of several edges is used twice and written once.

    Both sides grow with the graph, so they are always shuffled. Edges made
    from files that compress well look small enough to broadcast; then every
    executor and the driver hold all of them, and all walks are made in the
    tasks that read the first edges, often a single one.
    """
    if hops == 1:
        return single
    if hops % 2:
        return _concatenate(_halves(single, hops - 1), single.hint("merge"))
    half = _halves(single, hops // 2)
    if hops > 2:
        half = cut_lineage(half, "half-walks")
    return _concatenate(half, half.hint("merge"))


def _concatenate(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join walks end to start, keeping those that share no edge."""
    head = left.select("start_id", F.col("end_id").alias("_mid"), F.col("edge_ids").alias("_head"))
    tail = right.select(F.col("start_id").alias("_mid"), "end_id", F.col("edge_ids").alias("_tail"))
    joined = head.join(tail, "_mid").filter(~F.arrays_overlap("_head", "_tail"))
    return joined.select("start_id", "end_id", F.concat("_head", "_tail").alias("edge_ids"))


def path_values(graph: PropertyGraph, edge_type: str, walks: DataFrame) -> DataFrame:
    """Walks as path values: ``start_id, end_id, path``, entities of nodes and edges in turn.

    ``walks`` is the output of :func:`paths`. An entity is
    ``struct<id,label,start_id,end_id,properties>``; for nodes the two ends are
    null. Ids are text.
    """
    properties = [c for c in graph.edge_frames[edge_type].columns if c not in EDGE_COLUMNS]
    text = lambda name: F.col(name).cast("string")
    edges = graph.edges(edge_type).select(
        F.col("id").alias("_edge"), text("start_id").alias("_from"), text("end_id").alias("_to"),
        F.struct(
            text("id").alias("id"), F.col("type").alias("label"), text("start_id").alias("start_id"), text("end_id").alias("end_id"),
            (bag(*properties) if properties else empty_bag()).alias("properties"),
        ).alias("_entity"),
    )
    no_end = F.lit(None).cast("string")
    nodes = graph.entities().select(
        F.col("id").alias("_node"),
        F.struct("entity.id", "entity.label", no_end.alias("start_id"), no_end.alias("end_id"), "entity.properties").alias("_entity"),
    )
    walk = ["start_id", "end_id", "edge_ids"]
    steps = cut_lineage(walks.select(*walk, F.posexplode("edge_ids").alias("_at", "_edge")).join(edges, "_edge"), "steps")
    # The edge at place i stands at 2i + 1, the node after it at 2i + 2, the first node at 0.
    ends = steps.select(*walk, (F.col("_at") * 2 + 2).alias("_place"), F.col("_to").alias("_node"))
    first = steps.filter("_at = 0").select(*walk, F.lit(0).alias("_place"), F.col("_from").alias("_node"))
    placed = cut_lineage(ends.unionByName(first), "ends").join(nodes, "_node").select(*walk, "_place", "_entity")
    placed = placed.unionByName(steps.select(*walk, (F.col("_at") * 2 + 1).alias("_place"), "_entity"))
    # Maps have no order, so places are sorted and entities looked up by place.
    found = placed.groupBy(*walk).agg(F.map_from_entries(F.collect_list(F.struct("_place", "_entity"))).alias("_all"))
    in_order = F.transform(F.array_sort(F.map_keys("_all")), lambda place: F.element_at("_all", place))
    return found.select("start_id", "end_id", in_order.alias("path"))


def keyed_pairs(rows: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str, key: str) -> DataFrame:
    """Two keyed node look-ups per row: ``start_id, end_id`` and the row.

    The comma pattern ``(a {k: row.x}), (b {k: row.y})`` as two equi-joins.
    """
    starts = left.select(F.col("id").alias("start_id"), F.col(key).alias(left_key))
    ends = right.select(F.col("id").alias("end_id"), F.col(key).alias(right_key))
    return rows.join(starts, left_key).join(ends, right_key)
