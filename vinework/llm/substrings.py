"""Removal of passages that repeat an earlier passage, within or across documents.

Every window of ``width`` consecutive words gets a Rabin-Karp hash. Hashes are
counted per chunk of documents first and then over all chunks in Spark, so a
passage that stands in a third of all documents gives one entry per chunk.
Chunks are ranges of the document id, hence "starts earlier" is "lower chunk,
or earlier in the same chunk". Windows that are not the first of their hash
are merged to maximal intervals of words, which go.

Chunks and key ranges hold about ``CHUNK_BYTES`` of text each, whatever
``spark.sql.shuffle.partitions`` is. Up to ``DIRECT`` chunks send their hashes
straight to the key ranges. More are gathered in groups first, about as many
chunks to a group as there are groups: a group sends one run per key range for
all its chunks, so the number of packed rows grows with the power 1.5 of the
data and not with its square, and a run keeps some tens of kilobytes at a
terabyte.

Defined results: a null text has no words and stays null; texts shorter than a
window keep all words; rows without an id come after all others; they, and the
rows of an id that has more text than a chunk, count in the order of a hash of
their texts, by which they are dealt to chunks, and of their texts where that
is equal; rows with the same id count in the order of their texts otherwise;
identical rows repeat each other, and share a chunk. Extra columns are
untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels, packed

WIDTH = 20
# Bytes of text of a chunk; small tables are dealt to all tasks in chunks of LEAST_BYTES or more.
CHUNK_BYTES = 12 << 20
LEAST_BYTES = 1 << 20
# Chunks that exchange without groups: runs have 3 kB or more then, and groups write their hashes once more.
DIRECT = 4096
# Ranges of the id, by rows, from which chunks of like bytes are put together, per chunk.
FINE = 4
# Ids above are not exact as doubles.
EXACT = 1 << 53
# Names that no input column is likely to have; the caller's columns travel beside them.
CHUNK, ID, TEXT = "_sd_chunk", "_sd_id", "_sd_text"
KEYS = "_sd_bucket int, _sd_chunk int, _sd_keys binary"
RUNS = f"_sd_group int, {KEYS}"
SPAN = T.StructType().add("start", "long").add("stop", "long")
RESULT = (
    T.StructType()
    .add("_sd_words", "long")
    .add("_sd_removed", "long")
    .add("_sd_spans", T.ArrayType(SPAN))
    .add("_sd_kept", "string")
    .add("_sd_sha256", "string")
)


def find_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: all columns but the text, and the columns of ``RESULT``.

    ``_sd_spans`` are the removed byte ranges of the text; ``_sd_kept`` is the
    text without them and the white space after them; ``_sd_sha256`` is the
    SHA-256 of the kept words joined by single spaces.
    """
    keyed, n = _chunked(docs, id_col, text_col)
    # Both uses group the same rows by the same key, so Spark deals the texts once.
    chunks = keyed.groupBy(CHUNK)
    later = _later_direct(chunks, width, n) if n <= DIRECT else _later_grouped(chunks, width, n)
    own = [f for f in keyed.schema.fields if f.name not in (CHUNK, ID, TEXT)]
    schema = T.StructType([*own, *RESULT.fields])
    return chunks.cogroup(later.groupBy(CHUNK)).applyInArrow(_remove(width), schema)


def _later_direct(chunks: GroupedData, width: int, n: int) -> DataFrame:
    """Keys of every chunk that a lower chunk has too."""
    return chunks.applyInArrow(_emit(width, n, n), RUNS).groupBy("_sd_bucket").applyInArrow(_later_chunks, KEYS)


def _later_grouped(chunks: GroupedData, width: int, n: int) -> DataFrame:
    """The same by groups: one exchange inside each group, one between groups, and the way back."""
    size = math.isqrt(n - 1) + 1  # chunks of a group, coarse ranges, and fine ranges in a coarse one
    place = ["_sd_group", "_sd_bucket"]
    runs = chunks.applyInArrow(_emit(width, size, size), RUNS)
    merged = runs.groupBy(*place).applyInArrow(_merge(size), KEYS)
    between = merged.groupBy("_sd_bucket").applyInArrow(_later_chunks, KEYS)
    coarse = (F.col("_sd_bucket") / size).cast("int").alias("_sd_bucket")
    answers = between.select(F.col("_sd_chunk").alias("_sd_group"), coarse, "_sd_keys")
    return runs.groupBy(*place).cogroup(answers.groupBy(*place)).applyInArrow(_back, KEYS)


def _chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``docs`` with the chunk number, the id and the text under private names, and the number of chunks."""
    if id_col not in docs.columns:
        raise ValueError(f"no column {id_col!r}")
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    tasks = packed.PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = min(CHUNK_BYTES, max(LEAST_BYTES, total // tasks))
    ranges = FINE * (total // target + 1)
    at = docs[id_col].cast("double")
    wanted = [i / ranges for i in range(1, ranges)]
    found = sorted(docs.select(at.alias("k")).approxQuantile("k", wanted, 0.25 / ranges))
    borders = set(found)
    # An id that is a border twice has ranges of its own.
    hot = {x for x, y in zip(found, found[1:], strict=False) if x == y and abs(x) < EXACT}
    borders = sorted(borders | {math.nextafter(x, math.inf) for x in hot})
    fine = _cut(docs.withColumn("_sd_at", at), borders)
    sums = fine.groupBy("_sd_place").agg(F.sum(size).alias("n"))
    bytes_of = {-1 if row[0] is None else int(row[0]): row[1] for row in sums.collect()}
    kept, parts = _chunk_borders(borders, hot, bytes_of, target)
    nulls = bytes_of.get(-1, 0) // target + 1
    cut = _cut(docs.withColumn("_sd_at", at), kept)
    # Rows without an id, and those of an id with more text than a chunk, are dealt by a hash of their text.
    share = lambda n: F.floor((F.xxhash64(text_col) / F.lit(2.0**64) + 0.5) * n).cast("int")
    place = F.col("_sd_place").cast("int")
    chunk, before = F.lit(0), 0
    for at_place, n in parts:
        chunk = chunk + F.when(place > at_place, F.lit(n - 1)).when(place == at_place, F.least(share(n), F.lit(n - 1))).otherwise(0)
        before += n - 1
    n_ids = len(kept) + 1 + before
    chunk = F.when(place.isNull(), n_ids + F.least(share(nulls), F.lit(nulls - 1))).otherwise(place + chunk).cast("int")
    drop = [text_col] if text_col != TEXT else []
    keyed = cut.withColumn(CHUNK, chunk).withColumn(ID, F.col(id_col).cast("bigint")).withColumn(TEXT, F.col(text_col))
    return keyed.drop("_sd_at", "_sd_place", *drop), n_ids + nulls


def _cut(docs: DataFrame, borders: list[float]) -> DataFrame:
    """``_sd_place``, the number of borders at or below ``_sd_at``; null without an id."""
    splits = [float("-inf"), *(borders or [0.0]), float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_sd_at", outputCol="_sd_place", handleInvalid="keep").transform(docs)
    place = F.when(F.col("_sd_at").isNotNull(), F.col("_sd_place") if borders else F.lit(0.0))
    return placed.withColumn("_sd_place", place)


def _chunk_borders(borders: list[float], hot: set[float], bytes_of: dict[int, int], target: int) -> tuple[list[float], list[tuple[int, int]]]:
    """Borders of chunks of about ``target`` bytes, and (place, parts) of ids that need more than one chunk."""
    kept: list[float] = []
    parts: list[tuple[int, int]] = []
    filled, alone = bytes_of.get(0, 0), False
    for i, border in enumerate(borders, 1):
        mine = bytes_of.get(i, 0)
        split = border in hot and mine > target
        if split or alone or (filled and filled + mine > target):
            kept.append(border)
            filled = 0
        if split:
            parts.append((len(kept), mine // target + 1))
        alone = split
        filled += mine
    return kept, parts


def _in_order(table: pa.Table) -> pa.Table:
    order = pc.sort_indices(table, sort_keys=[(ID, "ascending"), (TEXT, "ascending")])
    return table.take(order)


def _windows(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Hashes of all windows in document order, their first words in the whole chunk, and the pieces of words."""
    data, offsets = kernels.buffers(table.column(TEXT))
    hashes, places, found, before = [], [], [], 0
    for row, end, part, cuts in kernels.pieces(data, offsets):
        starts, ends, first = kernels.tokens(part, cuts, kernels.NON_SPACE)
        rolled = kernels.window_hashes(kernels.token_hashes(part, starts, ends), width)
        at = kernels.whole_windows(first, width)
        hashes.append(rolled[at])
        places.append(at + before)
        found.append((row, end, part, cuts, starts, ends, first))
        before += len(starts)
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    return join(hashes, np.uint64), join(places, np.int64), found


def _emit(width: int, n: int, size: int):
    """Distinct hashes of a chunk by ``n`` key ranges; ``size`` chunks make a group."""

    def emit(key, table):
        hashes, _, _ = _windows(_in_order(table), width)
        distinct = np.unique(hashes)
        runs = packed.bucket_edges(distinct, n)
        chunk = key[0].as_py()
        return pa.table(
            {
                "_sd_group": pa.array([chunk // size] * len(runs), pa.int32()),
                "_sd_bucket": pa.array([b for b, _, _ in runs], pa.int32()),
                "_sd_chunk": pa.array([chunk] * len(runs), pa.int32()),
                "_sd_keys": pa.array([packed.pack(distinct[i:j]) for _, i, j in runs], pa.binary()),
            }
        )

    return emit


def _unpacked(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the runs in ascending order, all keys in that order, and the number of the run of each key."""
    chunks = np.asarray(table.column("_sd_chunk"))
    order = np.argsort(chunks, kind="stable")
    blobs = table.column("_sd_keys")
    lists = [packed.unpack(blobs[int(i)].as_py()) for i in order]
    return chunks[order], np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def _not_first(keys: np.ndarray) -> np.ndarray:
    """Marks keys that stand further ahead too."""
    by_key = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[by_key[1:]] = keys[by_key[1:]] == keys[by_key[:-1]]
    return again


def _answers(bucket: int, chunks: np.ndarray, keys: np.ndarray, owner: np.ndarray, again: np.ndarray) -> pa.Table:
    hit = np.flatnonzero(again)
    names, first = np.unique(owner[hit], return_index=True)
    cuts = np.append(first, len(hit))
    return pa.table(
        {
            "_sd_bucket": pa.array([bucket] * len(names), pa.int32()),
            "_sd_chunk": pa.array(chunks[names], pa.int32()),
            "_sd_keys": pa.array([packed.pack(keys[hit[i:j]]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
        }
    )


def _later_chunks(table):
    """Keys of one bucket, per chunk, that a lower chunk has too."""
    chunks, keys, owner = _unpacked(table)
    return _answers(table.column("_sd_bucket")[0].as_py(), chunks, keys, owner, _not_first(keys))


def _merge(size: int):
    """Distinct keys of a group in one coarse range, by the ``size`` fine ranges in it."""

    def merge(key, table):
        group, coarse = (x.as_py() for x in key)
        distinct = np.unique(_unpacked(table)[1])
        low, high = (coarse << 64) // size, ((coarse + 1) << 64) // size
        inner = np.array([low + (i * (high - low)) // size for i in range(1, size)], np.uint64)
        cuts = np.concatenate([[0], np.searchsorted(distinct, inner), [len(distinct)]])
        used = np.flatnonzero(np.diff(cuts))
        return pa.table(
            {
                "_sd_bucket": pa.array(coarse * size + used, pa.int32()),
                "_sd_chunk": pa.array([group] * len(used), pa.int32()),
                "_sd_keys": pa.array([packed.pack(distinct[cuts[i] : cuts[i + 1]]) for i in used], pa.binary()),
            }
        )

    return merge


def _back(key, runs, answers):
    """Keys of a group's chunks that a lower chunk of the group, or a lower group, has too."""
    chunks, keys, owner = _unpacked(runs)
    again = _not_first(keys)
    known = [packed.unpack(x.as_py()) for x in answers.column("_sd_keys")]
    if known:
        known = np.sort(np.concatenate(known))
        again |= known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
    return _answers(key[1].as_py(), chunks, keys, owner, again)


def _remove(width: int):
    def remove(key, table, later):
        table = _in_order(table)
        hashes, places, found = _windows(table, width)
        known = [packed.unpack(x.as_py()) for x in later.column("_sd_keys")]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        again = _not_first(hashes)
        if len(known):
            spot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            again |= known[spot] == hashes
        n_words = sum(len(x[4]) for x in found)
        gone = kernels.covered(places[again], width, n_words)
        rows = list(_kept(table.column(TEXT), found, gone))
        out = {name: table.column(name) for name in table.column_names if name not in (CHUNK, ID, TEXT)}
        spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), spans, pa.string(), pa.string()]
        for i, (name, kind) in enumerate(zip(RESULT.names, kinds, strict=True)):
            out[name] = pa.array([r[i] for r in rows], kind)
        return pa.table(out)

    return remove


def _kept(column: pa.ChunkedArray, found: list, gone: np.ndarray) -> Iterator[tuple]:
    """Per row: words, removed words, removed ranges, kept text, hash of the kept words."""
    before, index = 0, 0
    for row, end, part, cuts, starts, ends, first in found:
        mine = gone[before : before + len(starts)]
        before += len(starts)
        removed = kernels.row_sums(mine.astype(np.int64), first)
        for i in range(end - row):
            raw = part[cuts[i] : cuts[i + 1]].tobytes()
            null = not column[index].is_valid if not raw else False
            index += 1
            words = int(first[i + 1] - first[i])
            spans: list[dict] = []
            if removed[i]:
                flags = mine[first[i] : first[i + 1]]
                turns = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
                a, b = starts[first[i] : first[i + 1]] - cuts[i], ends[first[i] : first[i + 1]] - cuts[i]
                kept, last = [], 0
                for x, y in zip(turns[::2], turns[1::2], strict=True):
                    stop = int(a[y]) if y < words else len(raw)
                    spans.append({"start": int(a[x]), "stop": int(b[y - 1])})
                    kept.append(raw[last : int(a[x])])
                    last = stop
                raw = b"".join([*kept, raw[last:]])
            digest = hashlib.sha256(b" ".join(raw.split())).hexdigest()
            yield words, int(removed[i]), spans, None if null else raw.decode(), digest


def drop_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts.

    Every row stays, also one whose whole text repeats earlier ones (its text
    is then empty). ``length_col`` holds the length of the new text where the
    text changed.
    """
    found = find_repeats(docs, width, id_col, text_col)
    columns = []
    for name in docs.columns:
        if name == text_col:
            columns.append(F.col("_sd_kept").alias(name))
        elif name == length_col:
            kind = docs.schema[name].dataType
            new = F.char_length("_sd_kept").cast(kind)
            columns.append(F.when(F.col("_sd_removed") > 0, new).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return found.select(*columns)
