"""Benchmark decontamination: documents that hold passages of benchmark items.

A window is ``width`` consecutive words of an item (a shorter item is one
window). Containment is exact, so a prefix of one shingle per window suffices:
the one that is rarest over all documents. A document's shingles meet those
prefixes, the position of a match fixes where the window would have to lie, the
length bound checks that it fits, and the words there are compared with the
window.

The windows travel to the tasks in blocks of ``BLOCK_BYTES``. A benchmark of
more blocks takes as many passes over the documents, each adding its hits to
the rows; nothing else grows with it.

Defined results: a null text has no words and no hits; an item without words
has no window; an item without an id marks words but is not listed; repeated
items count once; an empty benchmark hits nothing. Extra columns are untouched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels
from vinework.runtime import cut_lineage

WIDTH = 13
SHINGLE = 5
SHARE = 20  # a document is contaminated if one word in so many is hit
BLOCK_BYTES = 16 << 20

SPAN = T.StructType().add("start", "long").add("stop", "long")
RESULT = T.StructType().add("_dc_words", "long").add("_dc_spans", T.ArrayType(SPAN)).add("_dc_items", T.ArrayType(T.StringType()))
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def item_windows(benchmark: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``window`` (words joined by spaces) and ``items`` (sorted ids as strings), one row per distinct window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.buffers(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for row, end, part, cuts in kernels.pieces(data, offsets):
                part = kernels.LOWER[part]
                starts, ends, first = kernels.tokens(part, cuts, kernels.WORD_BYTES)
                windows, owners = [], []
                for i in range(end - row):
                    words = [part[a:b].tobytes() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
                    for at in range(max(len(words) - width + 1, 1) if words else 0):
                        windows.append(b" ".join(words[at : at + width]).decode())
                        owners.append(ids[row + i])
                yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(owners, pa.string())], ["window", "item"])

    slim = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(cut, "window string, item string").groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


class _Block:
    """Windows of one block, found by the hash of one shingle each."""

    def __init__(self, windows: list[str], items: list[list[str]], shingle: int):
        self.windows = [w.encode() for w in windows]
        self.items = items
        self.lengths = [w.count(b" ") + 1 for w in self.windows]
        self.shingle = shingle

    def shingles(self) -> list[tuple[int, np.ndarray]]:
        """Per window: shingle width and the hashes of its shingles in order."""
        if not self.windows:
            return []
        data = np.frombuffer(b" ".join(self.windows), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(w) + 1 for w in self.windows])])
        offsets[-1] -= 1
        starts, ends, first = kernels.tokens(data, offsets, kernels.WORD_BYTES)
        hashes = kernels.token_hashes(data, starts, ends)
        out = []
        for i, n in enumerate(self.lengths):
            width = min(self.shingle, n)
            out.append((width, kernels.window_hashes(hashes[first[i] : first[i + 1]], width)))
        return out


class _Lookup:
    """Membership and place of many 64-bit keys in a small sorted set."""

    def __init__(self, keys):
        self.keys = np.unique(np.fromiter(keys, np.uint64))
        bits = max(10, int(len(self.keys)).bit_length() + 5)
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, bool)
        self.filter[self.keys >> self.shift] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the found keys, and their places in the set."""
        at = np.flatnonzero(self.filter[keys >> self.shift])
        place = np.searchsorted(self.keys, keys[at])
        place = np.minimum(place, len(self.keys) - 1)
        same = self.keys[place] == keys[at]
        return at[same], place[same]


def _parts(column: pa.Array) -> Iterator[tuple]:
    data, offsets = kernels.buffers(column)
    for row, end, part, cuts in kernels.pieces(data, offsets):
        part = kernels.LOWER[part]
        starts, ends, first = kernels.tokens(part, cuts, kernels.WORD_BYTES)
        yield row, end, part, starts, ends, first


def _count(lookups: dict[int, _Lookup]):
    """Occurrences in the documents of every shingle of the block, per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {w: np.zeros(len(x.keys), np.int64) for w, x in lookups.items()}
        for batch in batches:
            for _, _, part, starts, ends, first in _parts(batch.column(0)):
                hashes = kernels.token_hashes(part, starts, ends)
                for width, lookup in lookups.items():
                    rolled = kernels.window_hashes(hashes, width)[kernels.whole_windows(first, width)]
                    totals[width] += np.bincount(lookup.find(rolled)[1], minlength=len(lookup.keys))
        for width, total in totals.items():
            some = np.flatnonzero(total)
            columns = [pa.array(np.full(len(some), width, np.int32)), pa.array(lookups[width].keys[some].view(np.int64)), pa.array(total[some])]
            yield pa.RecordBatch.from_arrays(columns, ["width", "shingle", "n"])

    return count


def _mark(block: _Block, prefixes: dict[int, dict[int, list[tuple[int, int]]]], text_col: str, fresh: bool):
    """Adds the words that the block's windows hit, and their items."""
    lookups = {w: _Lookup(x) for w, x in prefixes.items()}
    entries = {w: [prefixes[w][int(k)] for k in lookup.keys] for w, lookup in lookups.items()}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text_col))
            words, spans, items = [], [], []
            for row, end, part, starts, ends, first in _parts(column):
                hits = _hits(part, starts, ends, first)
                for i in range(end - row):
                    words.append(int(first[i + 1] - first[i]))
                    mine = hits.get(i, ())
                    spans.append([(s, s + block.lengths[w]) for s, w in mine])
                    items.append({x for _, w in mine for x in block.items[w]})
            if not fresh:
                for i, (old_spans, old_items) in enumerate(zip(batch.column("_dc_spans").to_pylist(), batch.column("_dc_items").to_pylist(), strict=True)):
                    spans[i] += [(s["start"], s["stop"]) for s in old_spans]
                    items[i] |= set(old_items)
            own = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in RESULT.names]
            found = [
                pa.array(words, pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in _merged(x)] for x in spans], _SPAN_TYPE),
                pa.array([sorted(x, key=str.encode) for x in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([c for _, c in own] + found, [n for n, _ in own] + RESULT.names)

    def _hits(part, starts, ends, first) -> dict[int, list[tuple[int, int]]]:
        """Per row: (first word in the row, window) of every occurrence."""
        hashes = kernels.token_hashes(part, starts, ends)
        out = defaultdict(list)
        for width, lookup in lookups.items():
            at = kernels.whole_windows(first, width)
            found, place = lookup.find(kernels.window_hashes(hashes, width)[at])
            rows = np.searchsorted(first, at[found], "right") - 1
            for token, key, row in zip(at[found].tolist(), place.tolist(), rows.tolist(), strict=True):
                for window, offset in entries[width][key]:
                    begin, stop = token - offset, token - offset + block.lengths[window]
                    if begin < first[row] or stop > first[row + 1]:
                        continue
                    there = b" ".join([part[a:b].tobytes() for a, b in zip(starts[begin:stop], ends[begin:stop], strict=True)])
                    if there == block.windows[window]:
                        out[row].append((begin - int(first[row]), window))
        return out

    return mark


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text_col: str = "text", id_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with ``_dc_words``, ``_dc_spans`` (hit ranges of words), ``_dc_items`` (ids of items) and ``_dc_hit``."""
    windows = cut_lineage(item_windows(benchmark, width, id_col, item_text), "windows")
    size = windows.agg(F.sum(F.octet_length("window") + F.octet_length(F.concat_ws(",", "items")) + 64)).first()[0] or 0
    n_blocks = -(-size // block_bytes) or 1
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n_blocks)))
    schema = T.StructType([f for f in docs.schema.fields if f.name not in RESULT.names] + RESULT.fields)
    out = docs
    for i in range(n_blocks):
        rows = dealt.filter(F.col("block") == i).orderBy("window").select("window", "items").toArrow()
        block = _Block(rows.column("window").to_pylist(), rows.column("items").to_pylist(), SHINGLE)
        prefixes = _rarest(docs.select(text_col), block)
        out = out.mapInArrow(_mark(block, prefixes, text_col, fresh=i == 0), schema)
        if n_blocks > 1:
            out = cut_lineage(out, "marked")
    hit = F.aggregate("_dc_spans", F.lit(0).cast("bigint"), lambda total, s: total + s["stop"] - s["start"])
    return out.withColumn("_dc_hit", hit)


def _rarest(texts: DataFrame, block: _Block) -> dict[int, dict[int, list[tuple[int, int]]]]:
    """Shingle width -> shingle -> (window, offset of the shingle): the rarest shingle of every window."""
    shingles = block.shingles()
    by_width = defaultdict(set)
    for width, hashes in shingles:
        by_width[width].update(hashes.tolist())
    lookups = {w: _Lookup(x) for w, x in by_width.items()}
    counts: dict[tuple[int, int], int] = {}
    if lookups:
        found = texts.mapInArrow(_count(lookups), "width int, shingle bigint, n bigint").groupBy("width", "shingle").agg(F.sum("n").alias("n"))
        counts = {(w, s % (1 << 64)): n for w, s, n in zip(*(c.to_pylist() for c in found.toArrow().columns), strict=True)}
    prefixes: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for window, (width, hashes) in enumerate(shingles):
        offset = min(range(len(hashes)), key=lambda i: (counts.get((width, int(hashes[i])), 0), i))  # noqa: B023
        prefixes[width][int(hashes[offset])].append((window, offset))
    return {w: dict(x) for w, x in prefixes.items()}


def contaminated(share: int = SHARE):
    """Whether enough of a document's words are hit."""
    return (F.col("_dc_hit") > 0) & (F.col("_dc_hit") * share >= F.col("_dc_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    found = find_contamination(docs, benchmark)
    return found.filter(~contaminated()).select(*docs.columns)
