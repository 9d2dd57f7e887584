"""Near duplicates by SimHash fingerprints within a small Hamming distance.

The index is inverted by byte position. Two 64-bit fingerprints that differ in
at most d bits share at least 8 - d of their 8 positional bytes. A posting list
holds the fingerprints with the same bytes at 8 - d positions, 4 at most, so
that its key has up to 32 bits and unlike fingerprints seldom share it; each
pair with the guaranteed matches meets in a posting list. There its shared
bytes are tallied, pairs with fewer matches go, and the rest is verified by the
distance itself. A posting list never becomes pairs: what leaves it are links
from each member to the smallest member it is connected with.

Only distinct fingerprints are indexed, so exact copies cost one entry. Long
posting lists are cut into parts, and every two parts meet in a task of their
own.

Defined results: a text without words (also null) has fingerprint zero and is
linked like any other; rows without an id belong to a group but never name it;
repeated rows are copies of each other. Extra columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels
from vinework.llm.components import connected
from vinework.runtime import cut_lineage

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Posting lists above this length are worked off in parts.
LONG_LIST = 4096
HASHES_AT_ONCE = 1 << 16

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_POSITION = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one UTF-8 text over its word shingles."""
    words = text.translate(kernels.LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(len(words) - shingle + 1, 1)
    begins, stops = (ends - lengths)[:n], ends[-n:]
    counts = np.zeros(2048, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHES_AT_ONCE):
        some = zip(begins[at : at + HASHES_AT_ONCE].tolist(), stops[at : at + HASHES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in some], np.uint64)
        counts += np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _POSITION).ravel(), minlength=2048)
    set_bits = (counts.reshape(8, 256) @ _BYTE_BITS * 2 > n).ravel()
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "_sh_fp") -> DataFrame:
    """All columns of ``docs`` but the text, and the fingerprint as a signed bigint."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.buffers(batch.column(text_col))
            found = [fingerprint(data[i:j].tobytes(), shingle) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            values = np.array(found, np.uint64).view(np.int64)
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text_col]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + [pa.array(values)], [n for n, _ in kept] + [out])

    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col]).add(out, "long")
    return docs.mapInArrow(add, schema)


def position_sets(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any 8 - distance positions hold one of them: all of that size, of 4 if it is larger."""
    if not 0 <= distance <= 5:
        raise ValueError("sets of bytes find distances up to 5")
    return list(combinations(range(8), min(8 - distance, 4)))


def _links(distance: int):
    """Reduces posting lists, sorted by list and part, to links between connected members."""
    need = 8 - distance

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            same = _starts(table)
            cut = int(same[-1]) if len(same) else 0  # the last list may go on
            held = table.slice(cut)
            if cut:
                yield _star_links(table.slice(0, cut), need, distance)
        if held is not None and held.num_rows:
            yield _star_links(held, need, distance)

    return reduce


def _starts(table: pa.Table) -> np.ndarray:
    key, cell = (np.asarray(table.column(c)) for c in ("key", "cell"))
    change = np.ones(len(key), bool)
    change[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    return np.flatnonzero(change)


def _star_links(table: pa.Table, need: int, distance: int) -> pa.RecordBatch:
    starts = _starts(table)
    n = table.num_rows
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    fp = np.asarray(table.column("fp")).view(np.uint64)
    part = np.asarray(table.column("part"))
    crossing = np.asarray(table.column("crossing"))
    label = np.arange(n)
    at, shift = np.arange(n), 0
    firsts, seconds, waiting = [], [], 0
    while True:
        shift += 1
        at = at[at + shift < n]
        at = at[group[at] == group[at + shift]]
        if not len(at):
            break
        differ = fp[at] ^ fp[at + shift]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = (shared >= need) & ~(crossing[at] & (part[at] == part[at + shift]))
        near[near] = np.bitwise_count(differ[near]) <= distance
        if near.any():
            firsts.append(at[near])
            seconds.append(at[near] + shift)
            waiting += len(firsts[-1])
        if waiting > 1 << 20:
            label = _join(label, np.concatenate(firsts), np.concatenate(seconds))
            firsts, seconds, waiting = [], [], 0
    if waiting:
        label = _join(label, np.concatenate(firsts), np.concatenate(seconds))
    member = np.flatnonzero(label != np.arange(n))
    signed = fp.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(signed[member]), pa.array(signed[label[member]])], ["a", "b"])


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: the smallest index of each component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            deeper = label[label]
            if (deeper == label).all():
                break
            label = deeper


def near_links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of ``fps`` within the distance."""
    keys = []
    for i, positions in enumerate(position_sets(distance)):
        value = F.lit(i).cast("bigint")
        for byte in positions:
            value = F.shiftleft(value, 8).bitwiseOR(F.shiftrightunsigned(F.col("fp"), 8 * byte).bitwiseAND(F.lit(255)))
        keys.append(value)
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    sizes = cut_lineage(sizes.select("key", F.ceil(F.col("n") / LONG_LIST).cast("int").alias("parts")), "lists")
    # Lists grow with the fingerprints, so they are never sent to all tasks.
    met = postings.join(sizes.hint("merge"), "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = met.select("key", "fp", "parts", "part", other)
    low, high = F.least("part", "other"), F.greatest("part", "other")
    met = met.select("key", (low.cast("bigint") * F.col("parts") + high).alias("cell"), "fp", "part", (low != high).alias("crossing"))
    met = met.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
    return met.mapInArrow(_links(distance), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: its columns but the text, ``_sh_fp``, ``_sh_group`` (smallest fingerprint of the group) and ``_sh_id`` (smallest id)."""
    marked = cut_lineage(fingerprints(docs, text_col, shingle), "fingerprints")
    fps = cut_lineage(marked.groupBy(F.col("_sh_fp").alias("fp")).agg(F.min(id_col).alias("least")), "distinct")
    groups = connected(near_links(fps.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    rooted = fps.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = cut_lineage(rooted, "rooted")
    named = cut_lineage(rooted.groupBy("root").agg(F.min("least").alias("_sh_id")), "named")
    labels = rooted.join(named, "root").select(F.col("fp").alias("_sh_fp"), F.col("root").alias("_sh_group"), "_sh_id")
    return marked.join(cut_lineage(labels, "labels"), "_sh_fp").select(*marked.columns, "_sh_group", "_sh_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id (rows without an id last, then by a hash).

    Rows are told apart by 128 bits of id and text.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    row = F.unhex(F.substring(F.sha2(F.concat(part(id_col), F.lit("|"), part(text_col)), 256), 1, 32))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row.alias("_sh_row"))
    found = near_duplicates(slim, "id", "text", shingle, distance)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("_sh_row"))).alias("first")
    kept = found.groupBy("_sh_group").agg(first).select(F.col("first._sh_row").alias("_sh_row"))
    kept = cut_lineage(kept, "kept")
    out = docs.withColumn("_sh_row", row).join(kept, "_sh_row", "left_semi")
    return out.dropDuplicates(["_sh_row"]).drop("_sh_row")
