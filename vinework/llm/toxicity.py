"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Texts are lower-cased, look-alike letters and digits or signs used as letters
are folded, and everything else becomes blanks between words. Lexicon entries
are whole words and beginnings of words; their weights are log odds of the
documents of either label that hold them. In a word the longest entry counts.
Exception phrases are entries of weight zero that hide what they contain: words
and pairs of words that clean documents use, learned, and phrases given by the
caller. The summed weights, also per word of the text, give the score by a
logistic curve.

An entry needs ``LEAST_ROWS`` toxic rows, whatever their number. Counts are
joined and log odds computed in Spark; only entries of weight ``LEAST_WEIGHT``
and more reach the driver. With at most ``ROWS`` labelled rows, the bound of
what is learned from, their number is bounded by the vocabulary of these.

Defined results: null and empty texts have the score of a text without matches;
with one label only, or none, the score is the share of toxic rows (0 if there
are none). Extra columns are untouched.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.runtime import cut_lineage

SHORTEST, LONGEST = 4, 8  # letters of a beginning
LEAST_ROWS = 5  # toxic ones that hold an entry
LEAST_CLEAN = 3  # clean rows that hold an exception
LEAST_WEIGHT = 2.0
BUCKETS = 1 << 20  # of entries; one byte each travels to the tasks
ROWS = 1_000_000  # labelled rows from which a lexicon is learned, at most
SAMPLE = 200_000  # rows on which the curve is fitted, at most

# Letters that look like Latin ones, and digits and signs used as letters.
LOOK_ALIKES = str.maketrans(
    "авеікмнорстухѕјԁԛԝ" + "αβεικνορτυχ" + "ıɑɡ" + "013457",
    "abeikmhopctyxsjdqw" + "abeikvoptux" + "iag" + "oieast",
)
SIGNS = str.maketrans("@$!|", "asii")
SIGN_BEFORE_LETTER = re.compile(r"[@$!|](?=[^\W_])")
PHRASES = ("trash can", "trash bin", "clown fish")


class _Folder(dict):
    """Letters stay or are folded; format characters go; everything else is a blank."""

    def __missing__(self, code: int):
        char = chr(code)
        if code in LOOK_ALIKES:
            out = LOOK_ALIKES[code]
        elif char.isalpha() or unicodedata.combining(char):
            out = code
        else:
            out = None if unicodedata.category(char) == "Cf" else " "
        self[code] = out
        return out


_FOLDER = _Folder()


def fold(text: str) -> str:
    """Folded words of a text, each between single blanks."""
    text = unicodedata.normalize("NFKC", text).lower()
    if any(s in text for s in "@$!|"):
        text = SIGN_BEFORE_LETTER.sub(lambda m: m[0].translate(SIGNS), text)
    words = text.translate(_FOLDER).split()
    return f" {' '.join(words)} " if words else " "


@dataclass(frozen=True)
class Lexicon:
    """Entries (`` word `` or `` beginning``) with weights, and the curve's coefficients."""

    entries: dict[str, float]
    curve: tuple[float, float, float]

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            found.add_word(entry, (len(entry), weight))
        found.make_automaton()
        return found


def _features(words: set[str]) -> Iterator[str]:
    """Entries that a document's words offer: the words, and their beginnings."""
    yield from (f" {w} " for w in words)
    for n in range(SHORTEST, LONGEST + 1):
        yield from {f" {w[:n]}" for w in words if len(w) >= n}


def _bucket(entry: str) -> int:
    return xxhash.xxh64_intdigest(entry) & (BUCKETS - 1)


def _count_features(present: np.ndarray | None):
    """Rows of a task that hold each entry; with ``present``, entries of these buckets only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                found = _features(set(fold(text.as_py() or "").split()))
                held.update(found if present is None else [f for f in found if present[_bucket(f)]])
                if len(held) > 1 << 19:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    return count


def _counts(held: Counter) -> pa.RecordBatch:
    arrays = [pa.array(list(held), pa.string()), pa.array([_bucket(f) for f in held], pa.int32()), pa.array(list(held.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["entry", "bucket", "n"])


_COUNTED = "entry string, bucket int, n bigint"


def _frequencies(toxic: DataFrame, clean: DataFrame) -> DataFrame:
    """``entry, toxic, clean``: how many rows of either label hold each entry that is in ``LEAST_ROWS`` toxic rows."""
    first = toxic.mapInArrow(_count_features(None), _COUNTED).groupBy("entry", "bucket").agg(F.sum("n").alias("toxic"))
    first = first.filter(F.col("toxic") >= LEAST_ROWS)
    first = cut_lineage(first, "entries")
    # Tasks leave out entries in buckets without any; the join leaves out the rest.
    present = np.zeros(BUCKETS, bool)
    present[np.asarray(first.select("bucket").distinct().toArrow().column(0))] = True
    second = clean.mapInArrow(_count_features(present), _COUNTED).groupBy("entry").agg(F.sum("n").alias("clean"))
    return first.join(second, "entry", "left").select("entry", "toxic", F.coalesce("clean", F.lit(0)).alias("clean"))


def _weight(toxic, clean, n1: int, n0: int, log=np.log):
    """Log odds of an entry."""
    return log((toxic + 0.5) / (n1 + 1)) - log((clean + 0.5) / (n0 + 1))


def _choose(toxic: dict[str, int], clean: dict[str, int], n1: int, n0: int) -> dict[str, float]:
    """Entries with large log odds; a beginning is judged by the documents that its longer entries leave."""
    by_length = sorted(toxic, key=lambda e: (-len(e.strip()), not e.endswith(" "), e))
    taken: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    chosen: dict[str, float] = {}
    for entry in by_length:
        a, b = toxic[entry] - taken[entry][0], clean.get(entry, 0) - taken[entry][1]
        weight = _weight(max(a, 0), max(b, 0), n1, n0)
        if a < LEAST_ROWS or weight < LEAST_WEIGHT:
            continue
        chosen[entry] = float(weight)
        word = entry.strip()
        for n in range(SHORTEST, min(len(word), LONGEST) + 1):
            beginning = f" {word[:n]}"
            if beginning != entry:
                taken[beginning][0] += a
                taken[beginning][1] += b
    return chosen


def _matches(automaton: ahocorasick.Automaton, text: str) -> float:
    """Summed weights of a folded text. The longest entry at a word counts; inside a matched phrase nothing else does."""
    best: dict[int, tuple[int, float]] = {}
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if start not in best or length > best[start][0]:
            best[start] = (length, weight)
    total, free = 0.0, 0
    for start in sorted(best):
        length, weight = best[start]
        if start >= free:
            total += weight
            # The last blank of a whole word begins the next one.
            free = start + length - 1
    return total


def _measure(entries: dict[str, float], text_col: str, curve: tuple[float, float, float] | None):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(entries, (0, 0, 0)).automaton() if entries else None
        for batch in batches:
            sums, sizes = [], []
            for text in batch.column(batch.schema.names.index(text_col)):
                folded = fold(text.as_py() or "")
                sums.append(_matches(automaton, folded) if automaton else 0.0)
                sizes.append(folded.count(" ") - 1)
            sums, sizes = np.array(sums), np.maximum(np.array(sizes), 0)
            if curve is None:
                yield pa.RecordBatch.from_arrays([pa.array(sums), pa.array(sizes, pa.int64()), batch.column("label")], ["weight", "words", "label"])
                continue
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text_col]
            arrays = [c for _, c in kept] + [pa.array(sums), pa.array(_curve(sums, sizes, curve))]
            yield pa.RecordBatch.from_arrays(arrays, [n for n, _ in kept] + ["_tx_weight", "_tx_score"])

    return measure


def _inputs(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(sums)), np.log1p(sums), np.log1p(100 * sums / np.maximum(sizes, 1))], axis=1)


def _curve(sums: np.ndarray, sizes: np.ndarray, curve) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_inputs(sums, sizes) @ np.array(curve), -50, 50)))


def _fit(sums: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, with a small penalty."""
    x, beta = _inputs(sums, sizes), np.zeros(3)
    penalty = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        slope = x.T @ (labels - p) - penalty @ beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", phrases: tuple[str, ...] = PHRASES) -> Lexicon:
    """A lexicon from all rows with label 0 or 1, at most ``ROWS``, and the curve from at most ``SAMPLE`` of them (by a hash of the text)."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    rows = cut_lineage(rows, "labelled")
    rows, n1, n0 = _bounded(rows, ROWS)
    if not n1 or not n0:
        share = 1.0 if n1 else 0.0
        return Lexicon({}, (50.0 if share else -50.0, 0.0, 0.0))
    toxic, clean = rows.filter("label = 1"), rows.filter("label = 0")
    counted = _frequencies(toxic, clean)
    # What longer entries leave of a beginning has no larger weight than all of it.
    large = counted.filter(_weight(F.col("toxic"), F.col("clean"), n1, n0, F.log) >= LEAST_WEIGHT)
    found = {r["entry"]: (r["toxic"], r["clean"]) for r in large.collect()}
    entries = _choose({e: a for e, (a, _) in found.items()}, {e: b for e, (_, b) in found.items()}, n1, n0)
    entries |= _exceptions(toxic, clean, entries, n1, n0)
    entries |= {fold(p): 0.0 for p in phrases if fold(p).strip()}
    found = _bounded(rows, SAMPLE)[0].mapInArrow(_measure(entries, "text", None), "weight double, words bigint, label int").toArrow()
    columns = (np.asarray(found.column(c)).astype(float) for c in ("weight", "words", "label"))
    return Lexicon(entries, _fit(*columns))


def _bounded(rows: DataFrame, most: int) -> tuple[DataFrame, int, int]:
    """At most ``most`` of the rows, those with the smallest hashes of their texts, and how many are toxic and clean."""
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    if n > most:
        # A hash below a threshold leaves little more than the sample; only that is ordered.
        whole = 1 << 30
        mark = F.pmod(F.xxhash64("text"), F.lit(whole))
        some = rows.filter(mark < int(1.2 * most / n * whole)).orderBy(mark, "text", "label").limit(most)
        return _bounded(cut_lineage(some, "sample"), most)
    return rows, sizes.get(1, 0), sizes.get(0, 0)


def _exceptions(toxic: DataFrame, clean: DataFrame, entries: dict[str, float], n1: int, n0: int) -> dict[str, float]:
    """Words that begin like an entry, and pairs of words with an entry, that stand in clean documents rather than in toxic ones."""
    beginnings = frozenset(e[1:] for e in entries if not e.endswith(" "))
    whole = frozenset(e[1:-1] for e in entries if e.endswith(" "))
    lengths = sorted({len(b) for b in beginnings})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter[str] = Counter()
            for text in batch.column("text"):
                held.update(phrases(fold(text.as_py() or "").split()))
            yield _counts(held)

    def phrases(words: list[str]) -> set[str]:
        begins = {w for w in set(words) if any(w[:n] in beginnings for n in lengths)}
        hits = begins | (whole & set(words))
        pairs = {f" {a} {b} " for a, b in zip(words, words[1:], strict=False) if a in hits or b in hits} if hits else set()
        return pairs | {f" {w} " for w in begins}

    if not entries:
        return {}
    held = clean.mapInArrow(count, _COUNTED).groupBy("entry").agg(F.sum("n").alias("clean")).filter(F.col("clean") >= LEAST_CLEAN)
    against = toxic.mapInArrow(count, _COUNTED).groupBy("entry").agg(F.sum("n").alias("toxic"))
    kept = held.join(against, "entry", "left").filter(F.coalesce("toxic", F.lit(0)) / n1 <= F.col("clean") / n0)
    return {r["entry"]: 0.0 for r in kept.select("entry").collect()}


def toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, ``_tx_weight`` (summed weights) and ``_tx_score`` (0 to 1)."""
    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col]).add("_tx_weight", "double").add("_tx_score", "double")
    return docs.mapInArrow(_measure(lexicon.entries, text_col, lexicon.curve), schema)
