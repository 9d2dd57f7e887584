"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs. A trigram binds the
vectors of its letters, each turned by its place, by multiplication; a language
profile bundles the vectors of all its trigrams by addition, and so does a
document. A document gets the language whose profile has the largest cosine
with it.

The inner product of a bundled document with a profile is the sum over its
trigrams of their inner products with the profile, so these are computed once
per distinct trigram and task. The document's own length is the same for every
profile and cancels where cosines are compared.

How well a text fits a language at all is its evidence: the inner product with
the best profile, in units of its standard deviation over texts with the same
trigram counts whose vectors have nothing to do with the profile. It passes 8
in every document of 20 letters or more that is in a known language.

Defined results: ``und`` with score 0 for a null text, a text without letters,
and where nothing was learned; ties go to the smaller language name. Extra
columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels

DIMENSIONS = 4096
UNKNOWN = "und"
BITS = 21  # of a code point
TABLE_LIMIT = 1 << 22  # entries of a direct table of trigrams
KNOWN_LIMIT = 1 << 18  # trigrams whose products a task remembers
LEAST_LETTERS = 20  # of a text that can be told to be in no known language
LEAST_EVIDENCE = 5.0

_letters: dict[int, np.ndarray] = {}  # block of 256 code points -> lower-case letters
_vectors: dict[int, np.ndarray] = {}


def _letter_codes(codes: np.ndarray) -> np.ndarray:
    """Lower-case letter of every code point, 0 for what is no letter."""
    blocks = np.flatnonzero(np.bincount(codes >> 8))
    table = np.zeros((len(blocks), 256), np.uint32)
    for i, block in enumerate(blocks.tolist()):
        if block not in _letters:
            chars = map(chr, range(block << 8, (block + 1) << 8))
            _letters[block] = np.array([_lower(c) if c.isalpha() else 0 for c in chars], np.uint32)
        table[i] = _letters[block]
    place = np.zeros(int(blocks[-1]) + 1 if len(blocks) else 1, np.uint32)
    place[blocks] = np.arange(len(blocks))
    return table.ravel()[(place[codes >> 8] << 8) | (codes & 255)]


def _lower(char: str) -> int:
    low = char.lower()
    return ord(low) if len(low) == 1 else ord(char)


def _row_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows, with a 0 before each row and at the end, and where rows begin."""
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    cuts = leads[offsets]
    letters = np.append(np.insert(_letter_codes(codes), cuts[:-1], 0), np.uint32(0))
    return letters, cuts + np.arange(len(cuts))


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of a piece (63-bit keys), the index of every occurrence in them, and the first occurrence of every row.

    A trigram is a letter with its neighbours, where anything else is a blank.
    """
    letters, begins = _row_letters(data, offsets)
    at = np.flatnonzero(letters)
    first = np.searchsorted(at, begins)
    present, dense = np.unique(letters[at], return_inverse=True)
    size = len(present) + 1
    ids = np.zeros(len(letters), np.int64)
    ids[at] = dense + 1
    keys = (ids[at - 1] * size + ids[at]) * size + ids[at + 1]
    if size**3 <= TABLE_LIMIT:
        seen = np.flatnonzero(np.bincount(keys, minlength=size**3))
        table = np.zeros(size**3, np.int64)
        table[seen] = np.arange(len(seen))
        index = table[keys]
    else:
        seen, index = np.unique(keys, return_inverse=True)
    names = np.concatenate([[0], present]).astype(np.int64)
    a, b, c = names[seen // (size * size)], names[seen // size % size], names[seen % size]
    return (a << (2 * BITS)) | (b << BITS) | c, index, first


def _vector(code: int) -> np.ndarray:
    if code not in _vectors:
        _vectors[code] = np.random.default_rng(code + 1).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1
    return _vectors[code]


def _bound(keys: np.ndarray) -> np.ndarray:
    """Vectors of trigrams: letters turned by their place and multiplied."""
    mask = (1 << BITS) - 1
    out = np.empty((len(keys), DIMENSIONS), np.int8)
    for i, key in enumerate(keys.tolist()):
        a, b, c = key >> (2 * BITS), key >> BITS & mask, key & mask
        out[i] = np.roll(_vector(a), 2) * np.roll(_vector(b), 1) * _vector(c)
    return out


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language: the sum of the vectors of all trigrams, one row per dimension."""
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        data, offsets = kernels.buffers(batch.column(0))
        langs = np.array(batch.column(1).to_pylist(), object)
        for row, end, part, cuts in kernels.pieces(data, offsets):
            keys, index, first = _trigrams(part, cuts)
            owner = np.repeat(np.arange(row, end), np.diff(first))
            for lang in set(langs[row:end].tolist()):
                mine = langs[owner] == lang
                found = np.bincount(index[mine], minlength=len(keys))
                counts[lang] = _added(counts.get(lang), keys[found > 0], found[found > 0])
    for lang, (keys, n) in sorted(counts.items()):
        total = np.zeros(DIMENSIONS, np.int64)
        for at in range(0, len(keys), 512):
            total += n[at : at + 512] @ _bound(keys[at : at + 512]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(total)], ["lang", "dimension", "value"]
        )


def _added(old, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if old is None:
        order = np.argsort(keys)
        return keys[order], n[order]
    names, index = np.unique(np.concatenate([old[0], keys]), return_inverse=True)
    return names, np.bincount(index, weights=np.concatenate([old[1], n])).astype(np.int64)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their profiles of length 1. All rows with a text and a language count.

    The result has ``DIMENSIONS`` numbers for each language label.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    sums = rows.mapInArrow(_bundle, "lang string, dimension int, value bigint")
    sums = sums.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).toArrow()
    langs = sorted(set(sums.column("lang").to_pylist()))
    number = {x: i for i, x in enumerate(langs)}
    profiles = np.zeros((len(langs), DIMENSIONS))
    where = np.array([number[x] for x in sums.column("lang").to_pylist()], int)
    profiles[where, np.asarray(sums.column("dimension"))] = np.asarray(sums.column("value"))
    norms = np.linalg.norm(profiles, axis=1, keepdims=True)
    return langs, profiles / np.where(norms > 0, norms, 1)


class _Products:
    """Inner products of trigrams with the profiles, remembered within a task."""

    def __init__(self, profiles: np.ndarray):
        self.profiles = profiles
        self.keys = np.zeros(0, np.int64)
        self.values = np.zeros((0, len(profiles)))

    def of(self, keys: np.ndarray) -> np.ndarray:
        missing = np.setdiff1d(keys, self.keys)
        if len(missing):
            if len(self.keys) > KNOWN_LIMIT:
                self.keys, self.values, missing = self.keys[:0], self.values[:0], np.unique(keys)
            new = [_bound(missing[i : i + 512]).astype(np.float64) @ self.profiles.T for i in range(0, len(missing), 512)]
            names, values = np.concatenate([self.keys, missing]), np.concatenate([self.values, *new])
            order = np.argsort(names)
            self.keys, self.values = names[order], values[order]
        return self.values[np.searchsorted(self.keys, keys)]


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, ``_li_lang`` and ``_li_score``: the best cosine's share of all positive cosines."""
    return _identified(docs, model, text_col, evidence=False).drop("_li_letters", "_li_evidence")


def _squares(index: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Per row: the sum of the squared counts of its trigrams."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cells = np.sort(rows * n + index)
    starts = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.diff(np.append(starts, len(cells))).astype(float)
    return np.bincount(cells[starts] // max(n, 1), weights=counts * counts, minlength=len(first) - 1)


def _identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str, evidence: bool) -> DataFrame:
    """``identify``, ``_li_letters`` (number of letters) and ``_li_evidence`` (0 if not asked for)."""
    langs, profiles = model

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = _Products(profiles)
        names = np.array([*langs, UNKNOWN], object)
        for batch in batches:
            data, offsets = kernels.buffers(batch.column(batch.schema.names.index(text_col)))
            best, score, letters, fits = [np.zeros(0, int)], [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, part, cuts in kernels.pieces(data, offsets):
                keys, index, first = _trigrams(part, cuts)
                values = products.of(keys)
                near = np.stack([kernels.row_sums(v[index], first) for v in values.T]) if langs else np.zeros((1, len(cuts) - 1))
                positive = np.maximum(near, 0)
                top, total = near.argmax(axis=0), positive.sum(axis=0)
                share = positive.max(axis=0) / np.where(total > 0, total, 1)
                some = np.diff(first)
                none = (some == 0) | (not langs)
                letters.append(some)
                best.append(np.where(none, len(langs), top))
                score.append(np.where(none, 0.0, share))
                # Signs are independent of a foreign profile, which has length 1.
                spread = np.sqrt(np.maximum(_squares(index, first, len(keys)), 1)) if evidence else 1.0
                fits.append(near.max(axis=0) / spread if evidence else np.zeros(len(some)))
            found = names[np.concatenate(best)]
            extra = [pa.array(found, pa.string()), pa.array(np.concatenate(score)), pa.array(np.concatenate(letters)), pa.array(np.concatenate(fits))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "_li_lang", "_li_score", "_li_letters", "_li_evidence"])

    schema = T.StructType([*docs.schema.fields]).add("_li_lang", "string").add("_li_score", "double").add("_li_letters", "long")
    return docs.mapInArrow(add, schema.add("_li_evidence", "double"))


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` in a known language, with null languages filled in.

    Null texts and texts without letters go, and so do texts of
    ``LEAST_LETTERS`` or more whose evidence is below ``LEAST_EVIDENCE``: no
    known language explains them. Where nothing was learned, all texts with
    letters stay and languages are left as they are. Repeated rows stay.
    """
    langs, _ = model
    found = _identified(docs, model, text_col, evidence=bool(langs)).filter("_li_letters > 0")
    if langs:
        found = found.filter((F.col("_li_letters") < LEAST_LETTERS) | (F.col("_li_evidence") >= LEAST_EVIDENCE))
        found = found.withColumn(lang_col, F.coalesce(F.col(lang_col).cast("string"), F.col("_li_lang")))
    return found.select(*docs.columns)
