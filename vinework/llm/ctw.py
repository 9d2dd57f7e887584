"""Language-model scores by context-tree weighting, beside a word unigram base.

A byte is eight binary decisions; the decision at a node of the byte's binary
tree is estimated in the contexts of the last 0 to ``DEPTH`` bytes by
Krichevsky-Trofimov counts, and all depths are mixed by the weights that
context-tree weighting gives them on the training texts. Where a context was
never seen, the deepest seen one ends the mix.

First, tasks count their distinct words and runs of ``DEPTH`` + 1 bytes, and
the counts are summed by hash over all training texts. Runs are then grouped by
their last two context bytes, in which all deeper nodes of the tree lie; there
are at most 65,536 such prefixes, and small ones share a group. What the two
upper levels of the tree need is a sum per node of depth 1, at most 65,280 rows.

Second, texts are grouped to chunks. A chunk sends each distinct word and run
once, packed, to where its counts or its subtree are, and gets one number back.
A prefix with more runs than a group's share is given to several groups, each
with a copy of its subtree.

Defined results: a null text is empty and consists of its end only; without
training texts every decision is one half; rows may repeat. Extra columns are
untouched.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels, packed
from vinework.runtime import cut_lineage

DEPTH = 5
END = 0xFF  # no byte of UTF-8
END_WORD = np.uint64(0)
PREFIX = 2  # bytes of context whose subtree stays in one group
CHUNK, TEXT = "_lm_chunk", "_lm_text"
WORDS, RUNS = 0, 1
FLUSH = 1 << 21  # keys that a counting task holds before it sends them
RESULT = (
    T.StructType().add("_lm_tokens", "long").add("_lm_known", "long").add("_lm_words", "double").add("_lm_score", "double").add("_lm_bytes", "long")
)
_UNMIX_B = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
_UNMIX_C = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))


def _unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of the mixer, to get runs of bytes back from their keys."""
    for shift, factor in ((31, _UNMIX_C), (27, _UNMIX_B), (30, np.uint64(1))):
        y = x
        for _ in range(64 // shift + 1):
            y = x ^ (y >> np.uint64(shift))
        x = y * factor
    return x


# What a chunk sends and gets back


def _piece_words(part, cuts) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and of every row's end, in order, and the first of every row."""
    starts, ends, first = kernels.tokens(part, cuts, kernels.NON_SPACE)
    hashes = kernels.token_hashes(part, starts, ends)
    hashes[hashes == END_WORD] = 1
    return np.insert(hashes, first[1:], END_WORD), first + np.arange(len(first))


def _piece_runs(part, cuts) -> tuple[np.ndarray, np.ndarray]:
    """Key of every byte with its context, and of every row's end, in order, and the first of every row.

    The latest context byte comes first in a key, the byte itself last; before
    the text stand zeros.
    """
    rows = len(cuts) - 1
    room = DEPTH + 1
    shift = np.repeat(np.arange(rows) * room + DEPTH, np.diff(cuts))
    line = np.zeros(len(part) + rows * room, np.uint8)
    line[np.arange(len(part)) + shift] = part
    stops = cuts[1:] + np.arange(rows) * room + DEPTH
    line[stops] = END
    inside = np.ones(len(line), bool)
    for i in range(DEPTH):
        inside[cuts[:-1] + np.arange(rows) * room + i] = False
    at = np.flatnonzero(inside)
    keys = np.zeros(len(at), np.uint64)
    for back in [*range(1, DEPTH + 1), 0]:
        keys = (keys << np.uint64(8)) | line[at - back]
    return keys, cuts + np.arange(rows + 1)


def _pieces(column) -> Iterator[tuple]:
    data, offsets = kernels.buffers(column)
    for _, _, part, cuts in kernels.pieces(data, offsets):
        part = kernels.LOWER[part]
        yield cuts, {WORDS: _piece_words(part, cuts), RUNS: _piece_runs(part, cuts)}


def _blobs(table: pa.Table, name: str) -> list[bytes]:
    return table.column(name).to_pylist()


def _table(columns: dict[str, tuple]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


def _count(n: int):
    """Counts of a task's words and runs; runs are dealt by a hash too."""

    def rows(kind: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, index = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.bincount(index, weights=np.concatenate([c for _, c in parts])).astype(np.uint64)
        runs = packed.bucket_edges(keys, n)
        columns = {
            "bucket": ([b * 2 + kind for b, _, _ in runs], pa.int32()),
            "keys": ([packed.pack(keys[i:j]) for _, i, j in runs], pa.binary()),
            "counts": ([packed.planes(counts[i:j]) for _, i, j in runs], pa.binary()),
        }
        yield from _table(columns).to_batches()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORDS: [], RUNS: []}
        for batch in batches:
            for _, kinds in _pieces(batch.column(0)):
                for kind, (keys, _) in kinds.items():
                    names, counts = np.unique(keys, return_counts=True)
                    held[kind].append((kernels.mix(names) if kind == RUNS else names, counts))
                    if sum(len(k) for k, _ in held[kind]) > FLUSH:
                        yield from rows(kind, held[kind])
                        held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield from rows(kind, parts)

    return count


def _sum(table):
    """Counts of one bucket over all tasks."""
    keys = np.concatenate([packed.unpack(b) for b in _blobs(table, "keys")])
    counts = np.concatenate([packed.from_planes(b, np.uint64) for b in _blobs(table, "counts")])
    names, index = np.unique(keys, return_inverse=True)
    total = np.bincount(index, weights=counts).astype(np.uint64)
    columns = {
        "bucket": (table.column("bucket").to_pylist()[:1], pa.int32()),
        "keys": ([packed.pack(names)], pa.binary()),
        "counts": ([packed.planes(total)], pa.binary()),
        "total": ([int(total.sum())], pa.int64()),
        "distinct": ([len(names)], pa.int64()),
    }
    return _table(columns)


def _prefix(runs: np.ndarray) -> np.ndarray:
    return (runs >> np.uint64(8 * (DEPTH + 1 - PREFIX))).astype(np.int64)


def _ascending(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Summed runs of a bucket in the order of their bytes, and their counts."""
    runs = _unmix(packed.unpack(keys))
    order = np.argsort(runs)
    return runs[order], packed.from_planes(counts, np.uint64)[order]


def _prefix_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket: how many runs have which prefix, one row for each latest byte."""
    for batch in batches:
        for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts")), strict=True):
            names, n = np.unique(_prefix(_ascending(keys, counts)[0]), return_counts=True)
            latest = names >> 8
            cuts = np.append(np.flatnonzero(np.diff(latest, prepend=-1)), len(names))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            columns = {
                "latest": (latest[cuts[:-1]], pa.int32()),
                "prefixes": ([names[i:j].tolist() for i, j in spans], pa.list_(pa.int32())),
                "n": ([n[i:j].tolist() for i, j in spans], pa.list_(pa.int64())),
            }
            yield from _table(columns).to_batches()


def _sum_sizes(table):
    names, index = np.unique(np.asarray(table.column("prefixes").combine_chunks().flatten()), return_inverse=True)
    n = np.bincount(index, weights=np.asarray(table.column("n").combine_chunks().flatten())).astype(np.int64)
    return _table({"prefix": (names, pa.int32()), "n": (n, pa.int64())})


class _Deal:
    """Groups of prefixes with about equal numbers of runs; copies of those that alone exceed a share."""

    def __init__(self, prefixes: list[int], sizes: list[int], n: int):
        self.group = (np.arange(1 << (8 * PREFIX)) % n).astype(np.int64)
        self.copies = np.ones(n + len(prefixes), np.int64)
        share, loads, more = max(1.0, sum(sizes) / n), [(0, i) for i in range(n)], n
        for size, prefix in sorted(zip(sizes, prefixes, strict=True), reverse=True):
            if size > share:
                self.group[prefix], self.copies[more] = more, math.ceil(size / share)
                more += 1
            else:
                load, i = heapq.heappop(loads)
                self.group[prefix] = i
                heapq.heappush(loads, (load + size, i))


def _dealt(deal: _Deal):
    """Summed runs of a bucket by their groups, once for each copy."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for keys, counts in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts")), strict=True):
                runs, total = _ascending(keys, counts)
                for part, at in _split(RUNS, runs, 0, deal):
                    packed_runs, packed_counts = packed.pack(runs[at]), packed.planes(total[at])
                    rows += [(RUNS, part, copy, packed_runs, packed_counts) for copy in range(int(deal.copies[part]))]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [*[pa.int32()] * 3, pa.binary(), pa.binary()]
            names = ("kind", "part", "copy", "keys", "counts")
            yield from _table({name: (c, k) for name, c, k in zip(names, columns, kinds, strict=True)}).to_batches()

    return assign


def _split(kind: int, keys: np.ndarray, n: int, deal: _Deal) -> Iterator[tuple[int, np.ndarray]]:
    """A chunk's ascending keys by where they are answered: part and positions."""
    if kind == WORDS:
        yield from ((part, np.arange(i, j)) for part, i, j in packed.bucket_edges(keys, n))
        return
    groups = deal.group[_prefix(keys)]
    order = np.argsort(groups, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(groups[order], prepend=-1)), len(order))
    yield from ((int(groups[order[i]]), order[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True))


def _ask(n: int, deal: _Deal):
    """The distinct words and runs of a chunk."""

    def ask(key, table):
        chunk = key[0].as_py()
        names = {WORDS: [], RUNS: []}
        for _, kinds in _pieces(table.column(TEXT)):
            for kind, (keys, _) in kinds.items():
                names[kind].append(np.unique(keys))
        rows = []
        for kind, lists in names.items():
            keys = np.unique(np.concatenate(lists))
            for part, at in _split(kind, keys, n, deal):
                rows.append((kind, part, chunk % int(deal.copies[part]) if kind == RUNS else 0, chunk, packed.pack(keys[at])))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [*[pa.int32()] * 4, pa.binary()]
        return _table({name: (c, k) for name, c, k in zip(("kind", "part", "copy", CHUNK, "keys"), columns, kinds, strict=True)})

    return ask


# The context tree


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function by Stirling's series, shifted by eight."""
    y = x + 8
    z = 1 / (y * y)
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z / 1260)) / y
    for i in range(8):
        out -= np.log(x + i)
    return out


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that Krichevsky and Trofimov give the decisions of a node."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


def _nodes(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the eight decisions: node keys (context and leading bits), zeros and ones. ``keys`` ascend."""
    out = []
    for bit in range(8):
        node = keys >> np.uint64(8 - bit)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        one = counts * ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.float64)
        ones = np.add.reduceat(one, first)
        out.append((node[first], np.add.reduceat(counts, first) - ones, ones))
    return out


def _shorter(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts in contexts without their oldest byte."""
    names, index = np.unique(((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255)), return_inverse=True)
    return names, np.bincount(index, weights=counts)


class _Tree:
    """Nodes of depths ``top`` to ``DEPTH`` with the weight of stopping there."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, top: int, deepest: int = DEPTH, below: list | None = None):
        self.levels: dict[int, list[tuple]] = {}
        self.top = top
        for depth in range(deepest, top - 1, -1):
            level = []
            for bit, (node, zeros, ones) in enumerate(_nodes(keys, counts)):
                own = _estimate(zeros, ones)
                if depth == DEPTH:
                    weighted, stop = own, np.ones(len(own))
                else:
                    if depth == deepest:
                        children = below[bit]
                    else:
                        child, _, _, weight, _ = self.levels[depth + 1][bit]
                        lead = np.uint64(bit)
                        parent = ((child >> (lead + np.uint64(8))) << lead) | (child & ((np.uint64(1) << lead) - np.uint64(1)))
                        children = np.bincount(np.searchsorted(node, parent), weights=weight, minlength=len(node))
                    weighted = np.logaddexp(own, children) - math.log(2)
                    stop = np.exp(own - math.log(2) - weighted)
                level.append((node, zeros, ones, weighted, stop))
            self.levels[depth] = level
            if depth > top:
                keys, counts = _shorter(keys, counts)

    def mix(self, keys: np.ndarray, bit: int, deeper: np.ndarray | None, deepest: int = DEPTH) -> np.ndarray:
        """Probability of each key's decision; ``deeper`` has it for greater depths, NaN where never seen."""
        one = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        for depth in range(deepest, self.top - 1, -1):
            node, zeros, ones, _, stop = self.levels[depth][bit]
            cut = np.uint64(8 * (DEPTH - depth))
            wanted = ((keys >> (cut + np.uint64(8))) << np.uint64(bit)) | ((keys & np.uint64(255)) >> np.uint64(8 - bit))
            place = np.minimum(np.searchsorted(node, wanted), len(node) - 1)
            hit = node[place] == wanted
            n1, n0 = ones[place] + 0.5, zeros[place] + 0.5
            here = np.where(one, n1, n0) / (n1 + n0)
            stop_here = stop[place]
            if deeper is None:
                mixed = here
            else:
                mixed = np.where(np.isnan(deeper), here, stop_here * here + (1 - stop_here) * deeper)
            deeper = np.where(hit, mixed, np.nan)
        return deeper


def _runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a group in ascending order and their counts."""
    runs = np.concatenate([packed.unpack(b) for b in _blobs(table, "keys")])
    counts = np.concatenate([packed.from_planes(b, np.uint64) for b in _blobs(table, "counts")]).astype(np.float64)
    order = np.argsort(runs)
    return runs[order], counts[order]


def _upper_sums(table):
    """Of one group: per node of depth 1, the byte counts and the summed weights of its nodes of depth 2."""
    columns = [[], [], [], []]
    for bit, (node, zeros, ones, weight, _) in enumerate(_Tree(*_runs(table), PREFIX).levels[PREFIX]):
        context = (node >> np.uint64(bit + 8)).astype(np.int64)
        lead = (node & np.uint64((1 << bit) - 1)).astype(np.int64) | (1 << bit)
        for column, value in zip(columns, (context * 256 + lead, zeros, ones, weight), strict=True):
            column.append(value)
    kinds = (pa.int64(), *[pa.float64()] * 3)
    return _table({n: (np.concatenate(c), k) for n, c, k in zip(("node", "zeros", "ones", "weight"), columns, kinds, strict=True)})


class _Upper:
    """Depths 0 and 1 as direct tables over (context byte, node)."""

    def __init__(self, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray):
        self.zeros, self.ones, below = (np.zeros((257, 256)) for _ in range(3))
        context, lead = node // 256, node % 256
        self.zeros[context, lead], self.ones[context, lead], below[context, lead] = zeros, ones, children
        self.zeros[256], self.ones[256] = self.zeros[:256].sum(axis=0), self.ones[:256].sum(axis=0)
        own = _estimate(self.zeros, self.ones)
        weighted = np.logaddexp(own, below) - math.log(2)
        seen = self.zeros + self.ones > 0
        below[256] = np.where(seen[:256], weighted[:256], 0).sum(axis=0)
        weighted[256] = np.logaddexp(own[256], below[256]) - math.log(2)
        self.stop = np.exp(own - math.log(2) - weighted)
        self.seen = seen

    def mix(self, keys: np.ndarray, bit: int, deeper: np.ndarray) -> np.ndarray:
        one = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        lead = (((keys & np.uint64(255)) >> np.uint64(8 - bit)) | np.uint64(1 << bit)).astype(np.int64)
        for context in ((keys >> np.uint64(8 * DEPTH)).astype(np.int64), np.full(len(keys), 256)):
            n1, n0 = self.ones[context, lead] + 0.5, self.zeros[context, lead] + 0.5
            here = np.where(one, n1, n0) / (n1 + n0)
            stop = self.stop[context, lead]
            mixed = np.where(np.isnan(deeper), here, stop * here + (1 - stop) * deeper)
            deeper = np.where(self.seen[context, lead], mixed, np.nan)
        return np.where(np.isnan(deeper), 0.5, deeper)


def _answer(upper: _Upper):
    """One number for every asked key: a word's count, or the log10 probability of a run's last byte."""

    def words(asked: np.ndarray, table: pa.Table) -> np.ndarray:
        out = np.zeros(len(asked), np.uint64)
        if table.num_rows:
            keys = np.concatenate([packed.unpack(b) for b in _blobs(table, "keys")])
            counts = np.concatenate([packed.from_planes(b, np.uint64) for b in _blobs(table, "counts")])
            place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            out = np.where(keys[place] == asked, counts[place], out)
        return out

    def runs(asked: np.ndarray, table: pa.Table) -> np.ndarray:
        tree = _Tree(*_runs(table), PREFIX) if table.num_rows else None
        total = np.zeros(len(asked))
        for bit in range(8):
            deeper = tree.mix(asked, bit, None) if tree else np.full(len(asked), np.nan)
            total += np.log10(upper.mix(asked, bit, deeper))
        return total.astype(np.float32)

    def answer(key, asking, table):
        kind, part = key[0].as_py(), key[1].as_py()
        lists = [packed.unpack(b) for b in _blobs(asking, "keys")]
        names = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
        values = (words if kind == WORDS else runs)(names, table)
        found = [packed.planes(values[np.searchsorted(names, x)]) for x in lists]
        columns = {
            CHUNK: (asking.column(CHUNK).to_pylist(), pa.int32()),
            "kind": ([kind] * len(lists), pa.int32()),
            "part": ([part] * len(lists), pa.int32()),
            "values": (found, pa.binary()),
        }
        return _table(columns)

    return answer


def _apply(n: int, deal: _Deal):
    """Scores of a chunk's documents."""

    def apply(key, table, answers):
        rows = zip(*(answers.column(c).to_pylist() for c in ("kind", "part", "values")), strict=True)
        blobs = {(kind, part): blob for kind, part, blob in rows}
        seen: dict[int, list] = {WORDS: [], RUNS: []}
        sizes = []
        for cuts, kinds in _pieces(table.column(TEXT)):
            sizes.append(np.diff(cuts))
            for kind, (keys, first) in kinds.items():
                names, index = np.unique(keys, return_inverse=True)
                seen[kind].append((names, index.astype(np.int32), first))
        out: dict[str, list] = {"tokens": [], "known": [], "words": [], "score": []}
        for kind, parts in seen.items():
            keys = np.unique(np.concatenate([p[0] for p in parts]))
            dtype = np.uint64 if kind == WORDS else np.float32
            values = np.zeros(len(keys), dtype)
            for part, at in _split(kind, keys, n, deal):
                values[at] = packed.from_planes(blobs[kind, part], dtype)
            for names, index, first in parts:
                mine = values[np.searchsorted(keys, names)]
                if kind == WORDS:
                    out["tokens"].append(np.diff(first))
                    out["known"].append(kernels.row_sums((mine > 0)[index].astype(np.int64), first))
                    out["words"].append(kernels.row_sums(np.log10(mine.astype(np.float64) + 0.1)[index], first))
                else:
                    out["score"].append(kernels.row_sums(mine.astype(np.float64)[index], first))
        own = {c: table.column(c) for c in table.column_names if c not in (CHUNK, TEXT)}
        found = [*(np.concatenate(x) for x in out.values()), np.concatenate(sizes)]
        return pa.table(own | {f.name: pa.array(x) for f, x in zip(RESULT.fields, found, strict=True)})

    return apply


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and ``_lm_tokens, _lm_known, _lm_base, _lm_score, _lm_bits`` and ``_lm_train_tokens``.

    ``train`` says which rows are learned from. ``_lm_score`` is the model's
    log10 probability of the lower-cased text and its end, ``_lm_bits`` its
    code length per byte; ``_lm_base`` is the score of the word unigrams.
    """
    chunks = packed.parts(docs.sparkSession)
    n = chunks // packed.PER_PARTITION  # where keys are counted and answered
    sums = docs.filter(F.coalesce(train, F.lit(True))).select(text_col).mapInArrow(_count(n), "bucket int, keys binary, counts binary")
    sums = sums.groupBy("bucket").applyInArrow(_sum, "bucket int, keys binary, counts binary, total bigint, distinct bigint")
    sums = cut_lineage(sums.withColumn("kind", F.col("bucket") % 2), "counts")
    total, distinct = sums.filter(F.col("kind") == WORDS).agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = total or 0, distinct or 0
    runs = sums.filter(F.col("kind") == RUNS).select("keys", "counts")
    sizes = runs.mapInArrow(_prefix_sizes, "latest int, prefixes array<int>, n array<bigint>")
    sizes = sizes.groupBy("latest").applyInArrow(_sum_sizes, "prefix int, n bigint").toArrow()
    deal = _Deal(*(c.to_pylist() for c in sizes.columns), n)
    model = runs.mapInArrow(_dealt(deal), "kind int, part int, copy int, keys binary, counts binary")
    upper = model.filter("copy = 0").groupBy("part").applyInArrow(_upper_sums, "node bigint, zeros double, ones double, weight double")
    upper = upper.groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weight")).orderBy("node").toArrow()
    upper = _Upper(*(np.asarray(c) for c in upper.columns))
    words = sums.filter(F.col("kind") == WORDS).select("kind", F.floor(F.col("bucket") / 2).cast("int").alias("part"), F.lit(0).alias("copy"), "keys", "counts")
    model = words.unionByName(model)

    chunk = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)).cast("int")
    keyed = docs.select(*[c for c in docs.columns if c != text_col], chunk.alias(CHUNK), F.col(text_col).alias(TEXT))
    asked = keyed.groupBy(CHUNK).applyInArrow(_ask(n, deal), f"kind int, part int, copy int, {CHUNK} int, keys binary")
    place = ["kind", "part", "copy"]
    answers = asked.groupBy(*place).cogroup(model.groupBy(*place))
    answers = answers.applyInArrow(_answer(upper), f"{CHUNK} int, kind int, part int, values binary")
    own = [f for f in keyed.schema.fields if f.name not in (CHUNK, TEXT)]
    found = keyed.groupBy(CHUNK).cogroup(answers.groupBy(CHUNK)).applyInArrow(_apply(n, deal), T.StructType([*own, *RESULT.fields]))
    scale = math.log10(total + 0.1 * (distinct + 1))
    bits = -F.col("_lm_score") * math.log2(10) / (F.col("_lm_bytes") + 1)
    return found.select(
        *[f.name for f in own], "_lm_tokens", "_lm_known", (F.col("_lm_words") - F.col("_lm_tokens") * F.lit(scale)).alias("_lm_base"),
        "_lm_score", bits.alias("_lm_bits"), F.lit(total).cast("bigint").alias("_lm_train_tokens"),
    )
