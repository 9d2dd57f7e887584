"""Exported graph dumps as a Spark data source: one tagged entity per line.

A line is the JSON of a vertex or edge and its type tag, such as
``{"id": 1, "label": "Person", "properties": {…}}::vertex``. Files are read in
splits of some megabytes, so one large dump spreads over all tasks. Labels and
kinds given to :func:`read_dump` are judged while lines are read, before any row
is made. Filters are not pushed by themselves: Spark keeps the filters pushed to
a Python source with the frame, not with its use, so two uses of one frame with
different filters would both lose rows.

Columns: ``kind`` (``vertex``, ``edge`` or ``other``), ``label``, ``id``,
``start_id``, ``end_id``, ``properties`` (JSON text) and ``raw``, the line of an
``other``. Lines that are no entity, by their tag or their JSON, are ``other``;
blank lines are skipped. An id that is no whole number is null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from vinework.sources.graph import KEY_BITS, PropertyGraph

FORMAT = "graph_dump"
SCHEMA = "kind string, label string, id bigint, start_id bigint, end_id bigint, properties string, raw string"
TYPES = [("kind", pa.string()), ("label", pa.string()), *((n, pa.int64()) for n in ("id", "start_id", "end_id")),
         ("properties", pa.string()), ("raw", pa.string())]
KINDS = ("vertex", "edge")
# Bytes of a split, rows of a batch, and bytes looked at for the end of a growing file's last whole line.
SPLIT = 64 << 20
ROWS = 8_192
TAIL = 1 << 16
PACKED = (".gz", ".bz2", ".zst")


@dataclass
class Split(InputPartition):
    """Lines that start in ``[first, end)`` of a file; the whole file where ``end`` is None."""

    path: str
    first: int = 0
    end: int | None = None


class DumpSource(DataSource):
    """Options: ``path`` (a file or folder every executor can reach), ``splitBytes``, ``kinds`` and ``labels`` (JSON lists), ``bags``.

    With ``bags`` "false" properties are null, for readers of ids and labels.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DumpReader:
        return DumpReader(self.options)

    def streamReader(self, schema) -> DumpStream:
        return DumpStream(self.options)


class DumpReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.size = int(options.get("splitBytes", SPLIT))
        if self.size < 1:
            raise ValueError("splitBytes must be at least 1")
        self.wanted = _wanted(options)
        self.bags = options.get("bags", "true").lower() != "false"

    def partitions(self) -> list[Split]:
        return [split for path, size in _files(self.path) for split in _splits(path, 0, size, self.size)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(_lines(partition), self.wanted, self.bags)


class DumpStream(DataSourceStreamReader):
    """New files, and new whole lines of files that grow; an unfinished last line waits for its end.

    An offset holds a number per file, so a folder should have some ten
    thousand files at most. Packed files count once they are there.
    """

    def __init__(self, options: Mapping[str, str]) -> None:
        self.path = options["path"]
        self.size = int(options.get("splitBytes", SPLIT))
        self.wanted = _wanted(options)
        self.seen: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for path, size in _files(self.path):
            if self.seen.get(path, (-1, 0))[0] != size:
                self.seen[path] = (size, size if path.endswith(PACKED) else _whole(path, size))
        return {path: whole for path, (_, whole) in self.seen.items() if whole}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        grown = [(path, start.get(path, 0), size) for path, size in sorted(end.items()) if size > start.get(path, 0)]
        return [split for path, first, size in grown for split in _splits(path, first, size, self.size)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _batches(_lines(partition), self.wanted)

    def commit(self, end: dict) -> None:
        pass


def _wanted(options: Mapping[str, str]) -> dict[str, set[str]]:
    return {name: set(json.loads(options[name])) for name in ("kinds", "labels") if name in options}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> list[tuple[str, int]]:
    """Files of a folder at any depth with their sizes; names that begin with ``_`` or ``.`` are no data."""
    system, inner = _open(path)
    found = system.get_file_info(inner)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == fs.FileType.File:
        return [(path, found.size)]
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else path.split("://")[0] + "://"
    below = system.get_file_info(fs.FileSelector(inner, recursive=True))
    hidden = lambda p: any(part[:1] in ("_", ".") for part in p[len(inner) :].strip("/").split("/"))
    return sorted((prefix + f.path, f.size) for f in below if f.type == fs.FileType.File and not hidden(f.path))


def _splits(path: str, first: int, size: int, step: int) -> list[Split]:
    if path.endswith(PACKED):
        return [Split(path)]
    return [Split(path, at, min(at + step, size)) for at in range(first, size, step)]


def _whole(path: str, size: int) -> int:
    """Bytes up to and with the last line end among the first ``size``."""
    system, inner = _open(path)
    with system.open_input_file(inner) as file:
        end = size
        while end > 0:
            first = max(0, end - TAIL)
            at = file.read_at(end - first, first).rfind(b"\n")
            if at >= 0:
                return first + at + 1
            end = first
    return 0


def _lines(split: Split) -> Iterator[bytes]:
    """Lines that start in the split; the last may end behind it."""
    system, inner = _open(split.path)
    if split.end is None:
        with system.open_input_stream(inner, compression="detect") as file:
            yield from _cut(file, None)
        return
    with system.open_input_file(inner) as file:
        # From the byte before, so that a line that starts with the split is not taken for the rest of another.
        file.seek(max(0, split.first - 1))
        lines = _cut(file, split.end - max(0, split.first - 1))
        if split.first:
            next(lines, None)
        yield from lines


def _cut(file, limit: int | None) -> Iterator[bytes]:
    """Lines of a file that start before ``limit`` bytes from here."""
    parts: list[bytes] = []
    at = 0
    while block := file.read(1 << 20):
        *ended, rest = block.split(b"\n")
        for piece in ended:
            line = b"".join([*parts, piece]) if parts else piece
            parts = []
            if limit is not None and at >= limit:
                return
            yield line
            at += len(line) + 1
        if rest:
            parts.append(rest)
        if limit is not None and at >= limit:
            return
    if parts and (limit is None or at < limit):
        yield b"".join(parts)


def _batches(lines: Iterator[bytes], wanted: Mapping[str, set[str]], bags: bool = True) -> Iterator[pa.RecordBatch]:
    kinds, labels = wanted.get("kinds"), wanted.get("labels")
    # A plain label stands in its line as it is; other lines need no parsing.
    plain = labels is not None and all(v.isalnum() and v.isascii() for v in labels)
    marks = [v.encode() for v in labels] if plain else []
    # Lines with the tag of another kind are that kind or other, and need none either.
    judged = kinds is not None and "other" not in kinds
    foreign = [kind.encode() for kind in KINDS if kind not in kinds] if judged else []
    rows: list[tuple] = []
    for line in lines:
        if not line.strip() or (plain and b"\\u" not in line and not any(m in line for m in marks)):
            continue
        if foreign and line[line.rfind(b"::") + 2 :].strip().lower() in foreign:
            continue
        row = _entity(line, bags)
        if (kinds is None or row[0] in kinds) and (labels is None or row[1] in labels):
            rows.append(row)
            if len(rows) == ROWS:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows, strict=True), TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in TYPES])


def _entity(line: bytes, bags: bool = True) -> tuple:
    text = line.decode("utf-8", "replace").strip()
    body, _, tag = text.rpartition("::")
    kind = tag.strip().lower()
    try:
        found = json.loads(body) if kind in KINDS else None
    except ValueError:
        found = None
    if not isinstance(found, dict) or not isinstance(found.get("label"), str):
        return ("other", None, None, None, None, None, text)
    ids = [v if type(v) is int and -(1 << 63) <= v < 1 << 63 else None for v in map(found.get, ("id", "start_id", "end_id"))]
    if not bags:
        return (kind, found["label"], *ids, None, None)
    bag = found.get("properties")
    return (kind, found["label"], *ids, json.dumps(bag if isinstance(bag, dict) else {}, ensure_ascii=False), None)


def read_dump(
    spark: SparkSession, path: str, *, kinds: Sequence[str] | None = None, labels: Sequence[str] | None = None, split_bytes: int = SPLIT
) -> DataFrame:
    """Entities of a dump, of the given kinds and labels only where these are given."""
    spark.dataSource.register(DumpSource)
    return spark.read.format(FORMAT).options(**_options(kinds, labels, split_bytes)).load(path)


def stream_dump(
    spark: SparkSession, path: str, *, kinds: Sequence[str] | None = None, labels: Sequence[str] | None = None, split_bytes: int = SPLIT
) -> DataFrame:
    """Entities of a dump folder as a stream of new files and lines."""
    spark.dataSource.register(DumpSource)
    return spark.readStream.format(FORMAT).options(**_options(kinds, labels, split_bytes)).load(path)


def _options(kinds: Sequence[str] | None, labels: Sequence[str] | None, split_bytes: int) -> dict[str, str]:
    lists = {name: json.dumps(list(v)) for name, v in (("kinds", kinds), ("labels", labels)) if v is not None}
    return {"splitBytes": str(split_bytes), **lists}


def dump_graph(spark: SparkSession, path: str, labels: Mapping[str, str], types: Mapping[str, str], split_bytes: int = SPLIT) -> PropertyGraph:
    """Typed graph over a dump; ``labels`` and ``types`` list the properties to expose, as in ``PropertyGraph.from_bags``.

    The label of an edge's end follows from the label number in its id, by a
    table with one row per label of the dump.
    """

    def exposed(columns: str) -> list:
        if not columns.strip():
            return []
        kind = f"struct<{columns}>"
        return [F.from_json("properties", kind).alias("_p")]

    def entities(kind: str, name: str, columns: str, *keys: str) -> DataFrame:
        rows = read_dump(spark, path, kinds=[kind], labels=[name], split_bytes=split_bytes)
        parsed = rows.select(*keys, *exposed(columns))
        return parsed.select(*keys, "_p.*") if columns.strip() else parsed

    spark.dataSource.register(DumpSource)
    vertices = spark.read.format(FORMAT).options(**_options(["vertex"], None, split_bytes), bags="false").load(path)
    numbers = vertices.select(F.shiftright("id", KEY_BITS).alias("_no"), "label").distinct()

    def with_ends(edges: DataFrame) -> DataFrame:
        for end, label in (("start_id", "src_label"), ("end_id", "dst_label")):
            named = numbers.select(F.col("_no").alias(f"_{end}"), F.col("label").alias(label))
            edges = edges.join(named, F.shiftright(end, KEY_BITS) == F.col(f"_{end}")).drop(f"_{end}")
        return edges

    return PropertyGraph(
        {name: entities("vertex", name, columns, "id") for name, columns in labels.items()},
        {name: with_ends(entities("edge", name, columns, "id", "start_id", "end_id")) for name, columns in types.items()},
    )
