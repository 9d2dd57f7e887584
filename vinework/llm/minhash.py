"""Near duplicates by MinHash with sequential Bayesian verification.

A text is the set of its distinct word shingles. Texts with equal sets are one
class. ``HASHES`` minima of a class's set form its signature: ``ROWS`` of them
together are the key of a band, and classes that share a band are candidates.
A pair of candidates is verified step by step: after every ``STEP`` entries of
the signatures the posterior distribution of the similarity, given how many
agree, tells whether the similarity can still reach the threshold; the pair is
given up when its probability falls below ``MISS``. What remains connected is
brought together, each class once, and links are confirmed by intersecting the
full sets. Until then only signatures move; texts move once, by their digests.

A pair of exactly the threshold 0.85 shares no band with probability
(1 - 0.85^4)^32 = 5e-11.

Signatures have one byte per entry, which agree by chance in one of 256 cases;
the posterior allows for it. Sets hold 64-bit hashes of shingles; two sets of a
thousand shingles hold equal hashes of different shingles with probability
below 1e-13. Classes are told apart by 128 bits.

Defined results: a null text, and one without words, has an empty set, is
linked with nothing, and its component is its own id. Rows without an id belong
to a component but never name it; a component of such rows only has a null id.
Repeated rows are copies of each other. Extra columns are untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels, lists
from vinework.llm.components import connected
from vinework.runtime import cut_lineage

SHINGLE = 3
PERCENT = 85
HASHES = 128
ROWS = 4  # entries of a band
STEP = 32  # entries compared at once
MISS = 1e-8
LONG_LIST = 4096  # classes of a band that one task takes at once
TASK_BYTES = 1 << 24  # of texts whose sets one task confirms at once

_SEEDS = np.random.default_rng(17).integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, ascending in a row, and where rows begin (one more entry than rows)."""
    lowered = kernels.LOWER[data]
    starts, ends, first = kernels.tokens(lowered, offsets, kernels.NON_SPACE)
    hashes = kernels.token_hashes(lowered, starts, ends)
    counts = np.diff(first)
    found, owners = [], []
    for width in range(1, shingle + 1):
        # Shorter rows have one shingle of all their words.
        rows = np.flatnonzero(counts == width) if width < shingle else np.flatnonzero(counts >= shingle)
        if len(rows):
            many = counts[rows] - width + 1
            at = np.repeat(first[rows] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            found.append(kernels.window_hashes(hashes, width)[at])
            owners.append(np.repeat(rows, many))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    values, owner = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(offsets)))


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` hashes over every non-empty set, one row each."""
    rows = np.flatnonzero(np.diff(first))
    out = np.empty((len(rows), HASHES), np.uint64)
    if len(rows):
        for i, seed in enumerate(_SEEDS):
            out[:, i] = np.minimum.reduceat((values ^ (seed >> np.uint64(7))) * seed, first[rows])
    return kernels.mix(out)


def _text_key(text_col: str):
    """128 bits that tell texts apart."""
    return F.unhex(F.substring(F.sha2(text_col, 256), 1, 32))


def _marks(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """All columns but the text, and set size, digest of the set, signature bytes and band keys (null for empty sets)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.buffers(batch.column(batch.schema.names.index(text_col)))
            size, digests, bytes_, bands = [], [], [], []
            for _, _, part, cuts in kernels.pieces(data, offsets):
                values, first = shingle_sets(part, cuts, shingle)
                counts = np.diff(first)
                size.append(counts)
                minima = signatures(values, first)
                keys = np.zeros((len(minima), HASHES // ROWS), np.uint64)
                for band in range(HASHES // ROWS):
                    key = np.full(len(minima), band + 1, np.uint64)
                    for i in range(band * ROWS, (band + 1) * ROWS):
                        key = kernels.mix((key ^ minima[:, i]) * _SEEDS[0])
                    keys[:, band] = key
                short = minima.astype(np.uint8)
                nth = np.cumsum(counts > 0) - 1
                for row in range(len(counts)):
                    some = counts[row] > 0
                    own = values[first[row] : first[row + 1]].tobytes()
                    digests.append(hashlib.blake2b(own, digest_size=16).digest() if some else None)
                    bytes_.append(short[nth[row]].tobytes() if some else None)
                    bands.append(keys[nth[row]].view(np.int64) if some else None)
            sizes = np.concatenate(size) if size else np.zeros(0, np.int64)
            extra = [pa.array(sizes), pa.array(digests, pa.binary()), pa.array(bytes_, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            kept = [(c, n) for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != text_col]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in kept), *extra], [*(n for _, n in kept), *names])

    names = ["_mh_size", "_mh_set", "_mh_bytes", "_mh_bands"]
    types = [T.LongType(), T.BinaryType(), T.BinaryType(), T.ArrayType(T.LongType())]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != text_col), *map(T.StructField, names, types)])
    return docs.mapInArrow(add, schema)


def least_matches(threshold: float, miss: float = MISS, step: int = STEP, hashes: int = HASHES) -> list[int]:
    """After 1, 2, ... steps: the fewest agreeing entries with which P(similarity >= threshold | entries) >= ``miss``.

    The similarity is uniform beforehand; one-byte entries agree with
    probability s + (1 - s) / 256, so the posterior is a beta distribution of
    that probability.
    """
    grid = (np.arange(1 << 14) + 0.5) / (1 << 14)
    reach = threshold + (1 - threshold) / 256
    out = []
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            weight[grid < 1 / 256] = 0
            if weight[grid >= reach].sum() >= miss * weight.sum():
                out.append(m)
                break
    return out


def _agreeing(signature: np.ndarray, i: np.ndarray, j: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of rows no step gives up."""
    alive = np.arange(len(i))
    agree = np.zeros(len(i), np.int64)
    for at, needed in enumerate(least):
        part = slice(at * STEP, (at + 1) * STEP)
        agree[alive] += (signature[i[alive], part] == signature[j[alive], part]).sum(axis=1)
        alive = alive[agree[alive] >= needed]
    out = np.zeros(len(i), bool)
    out[alive] = True
    return out


PAIRS_AT_ONCE = 1 << 16


def _signature(table: pa.Table) -> np.ndarray:
    column = table.column("_mh_bytes")
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _candidates(percent: int):
    least = least_matches(percent / 100)

    def check(table: pa.Table):
        signature = _signature(table)

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            cuts = range(0, len(i), PAIRS_AT_ONCE)
            return np.concatenate([_agreeing(signature, i[c : c + PAIRS_AT_ONCE], j[c : c + PAIRS_AT_ONCE], least) for c in cuts])

        return test

    return check


def _confirmed(percent: int, shingle: int):
    """Signatures first, then the sizes of the sets, then the sets themselves."""
    least = least_matches(percent / 100)

    def check(table: pa.Table):
        signature = _signature(table)
        parts = [shingle_sets(d, o, shingle) for _, _, d, o in kernels.pieces(*kernels.buffers(table.column("text")))]
        values = np.concatenate([v for v, _ in parts])
        sizes = np.concatenate([np.diff(f) for _, f in parts])
        first = np.concatenate([[0], np.cumsum(sizes)])
        names, values = np.unique(values, return_inverse=True)
        mark = np.zeros(len(names), bool)

        def test(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.zeros(len(i), bool)
            # |A n B| <= min(|A|, |B|) and |A u B| >= max(|A|, |B|).
            low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
            left = np.flatnonzero(100 * low >= percent * high)
            left = left[_agreeing(signature, i[left], j[left], least)]
            if not len(left):
                return out
            order = left[np.argsort(i[left], kind="stable")]
            cuts = np.flatnonzero(np.diff(i[order], prepend=-1))
            for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
                pairs = order[at:end]
                one = i[pairs[0]]
                own = values[first[one] : first[one + 1]]
                mark[own] = True
                for k in pairs.tolist():
                    shared = int(mark[values[first[j[k]] : first[j[k] + 1]]].sum())
                    out[k] = 100 * shared >= percent * (sizes[one] + sizes[j[k]] - shared)
                mark[own] = False
            return out

        return test

    return check


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: its columns but the text, ``_mh_size`` (of its set) and ``_mh_id`` (smallest id of its component).

    Documents are linked where 100 * |A n B| >= ``percent`` * |A u B|.
    """
    # Tables and joins below grow with the documents, so nothing here is sent to all tasks.
    numbered = docs.withColumn("_mh_row", F.monotonically_increasing_id()).withColumn("_mh_text", _text_key(text_col))
    marked = cut_lineage(_marks(numbered, text_col, shingle), "marked")
    sets = marked.filter("_mh_size > 0").groupBy("_mh_set").agg(F.min("_mh_row").alias("node"), F.min(id_col).alias("least"))
    sets = cut_lineage(sets, "classes")
    # A class is known by its first row.
    slim = marked.select(F.col("_mh_row").alias("node"), "_mh_bytes", "_mh_bands", "_mh_text")
    classes = cut_lineage(slim.join(sets.select("node").hint("merge"), "node", "left_semi"), "signatures")
    found = cut_lineage(_band_links(classes, percent), "candidates")
    roots = connected(found).select("node", F.col("root").alias("list"))
    asked = cut_lineage(classes.drop("_mh_bands").join(roots.hint("merge"), "node"), "candidate-groups")
    texts = docs.select(_text_key(text_col).alias("_mh_text"), F.col(text_col).alias("text"))
    # Copies of a text meet its class once more; one of them stays.
    members = texts.join(asked.hint("merge"), "_mh_text").groupBy("list", "node").agg(F.first("text").alias("text"), F.first("_mh_bytes").alias("_mh_bytes"))
    members = cut_lineage(members.withColumn("weight", F.octet_length("text").cast("bigint")), "members")
    confirmed = lists.links(members, ["text", "_mh_bytes"], _confirmed(percent, shingle), TASK_BYTES)
    groups = connected(confirmed)
    rooted = sets.join(groups.hint("merge"), "node", "left").select("_mh_set", F.coalesce("root", "node").alias("root"), "least")
    rooted = cut_lineage(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("_mh_id"))
    labels = cut_lineage(rooted.join(named.hint("merge"), "root").select("_mh_set", "_mh_id"), "labels")
    others = [c for c in docs.columns if c != text_col]
    out = marked.select(*others, "_mh_size", "_mh_set").join(labels.hint("merge"), "_mh_set", "left")
    own = F.when(F.col("_mh_size") > 0, F.col("_mh_id")).otherwise(F.col(id_col)).alias("_mh_id")
    return out.select(*others, "_mh_size", own)


def _band_links(classes: DataFrame, percent: int) -> DataFrame:
    """Links of classes that share a band and that no step of the verification gives up."""
    postings = classes.select("node", F.explode("_mh_bands").alias("list"))
    shared = cut_lineage(postings.groupBy("list").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").select("list"), "bands")
    met = cut_lineage(postings.join(shared.hint("merge"), "list", "left_semi"), "postings")
    members = classes.select("node", "_mh_bytes").join(met.hint("merge"), "node").withColumn("weight", F.lit(1).cast("bigint"))
    return lists.links(members.select("list", "node", "weight", "_mh_bytes"), ["_mh_bytes"], _candidates(percent), LONG_LIST)
