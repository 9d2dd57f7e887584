"""Licence scan: TF-IDF cosine with templates, then inheritance along directories.

Units of a text are its lines, its paragraphs and the text as a whole. A unit's
sparse TF-IDF vector is compared with that of every template; the document
frequencies of the templates' words are counted over the lines of all texts,
and a word that no template has counts as the rarest. A bound on the cosine,
from the words that a unit shares with any template and the number of others,
leaves few units for the exact comparison, and none is lost.

Templates are statements, standard headers and short licences; a file as a whole
is also compared with whole licence texts, by their own words. What such a file
or a header of several lines holds, as the line "All rights reserved" of a BSD
licence, is a part of it and no licence of its own.

A file whose whole text is a licence, or that is named like one and holds one,
licenses its directory. A file without a licence of its own inherits that of
its nearest ancestor directory: distinct directories are joined with the
licensed ones by each of their ancestors, and files with their directory.

Defined results: a null or empty text has no licence of its own; a file without
a path inherits nothing; ties go to the smaller licence name; of several
licence files in a directory the one with the larger cosine counts. Extra
columns are untouched.
"""

from __future__ import annotations

import importlib.resources
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import kernels
from vinework.runtime import cut_lineage

LEAST = 0.7  # cosine of a licence
TEXT_LEAST = 0.85  # cosine of a file with a whole licence text, and of a header that decides on what it holds
FILE_NAMES = r"(?i)^(un)?licen[cs]e|^copying|^notice"

# Usual statements of licences, and the beginnings of their texts.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("proprietary", "All rights reserved."),
)

# Standard headers: names of the GNU licences, and the first paragraphs of the others.
_GNU = (
    ("AGPL-3.0", "Affero General Public License", "3"),
    ("GPL-2.0", "General Public License", "2"),
    ("GPL-3.0", "General Public License", "3"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "Lesser General Public License", "3"),
)
_LATER = "either version {} of the License, or (at your option) any later version."
_GNU_GRANTS = (
    "{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, " + _LATER,
    "{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; " + _LATER,
    "{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; version {}.",
    "{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} version {} as published by the Free Software Foundation.",
)
_GNU_WARRANTY = (
    "{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with "
    "{what}. If not, see <https://www.gnu.org/licenses/>."
)
_OTHER_HEADERS = (
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
        "at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this "
        "distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
)
TEXTS = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
SHORT_TEXTS = ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Unlicense")
_AFFERO_13 = """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users
interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding
Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary
means of facilitating copying of software.

"""


def _text(name: str) -> str:
    return (importlib.resources.files(__package__) / "texts" / f"{name}.txt").read_text(encoding="utf-8")


def headers() -> list[tuple[str, str]]:
    """Standard headers and short licences, whole and by the paragraph that grants."""
    out = list(_OTHER_HEADERS)
    for licence, name, version in _GNU:
        for what in ("This program", "This library") if name.startswith("Lesser") else ("This program",):
            grants = [g.format(version, what=what, name=name) for g in _GNU_GRANTS]
            warranty = _GNU_WARRANTY.format(what=what, name=name)
            out += [(licence, g) for g in grants] + [(licence, f"{g} {warranty}") for g in grants]
    for name in SHORT_TEXTS:
        out.append((name, _text(name)))
    # Conditions of BSD licences are shared, so only those that grant by themselves stand alone.
    out += [(name, next(p for p in _text(name).split("\n\n") if p.startswith(("Permission", "Anyone")))) for name in ("ISC", "MIT", "Unlicense")]
    return out


def whole_texts() -> list[tuple[str, str]]:
    """Whole licence texts; that of the AGPL is the GPL's with its name and its section 13."""
    out = [(name, _text(name)) for name in TEXTS]
    affero = re.sub(r"(?i)\bGNU (?=General Public License)", "GNU Affero ", _text("GPL-3.0"))
    affero = re.sub(r"(?s)  13\. Use with.*?(?=  14\. )", lambda _: _AFFERO_13, affero)
    return [*out, ("AGPL-3.0", affero)]


HIT = T.StructType().add("licence", "string").add("score", "double").add("start", "long").add("stop", "long")
_HIT_TYPE = pa.list_(pa.struct([("licence", pa.string()), ("score", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode().translate(kernels.LOWER_TABLE), np.uint8)
    starts, ends, _ = kernels.tokens(data, np.array([0, len(data)]), kernels.WORD_BYTES)
    return [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def _hash_words(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = kernels.tokens(data, np.array([0, len(data)]), ~kernels.byte_table((0x20, 0x20)))
    return kernels.token_hashes(data, starts, ends)


class _Templates:
    """Templates as sparse unit vectors; before frequencies are known, only their words."""

    def __init__(self, templates, lines: int = 0, frequency: dict[int, int] | None = None):
        counts = [(name, Counter(_words(text))) for name, text in templates]
        self.words = sorted({w for _, c in counts for w in c})
        hashes = _hash_words(self.words)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        self.filter = np.zeros(1 << 16, bool)
        self.filter[self.keys >> np.uint64(48)] = True
        place = {self.words[int(w)]: i for i, w in enumerate(order)}
        frequency = frequency or {}
        self.idf = np.array([math.log((lines + 2) / (frequency.get(i, 0) + 1)) for i in range(len(place))])
        self.rarest = math.log(lines + 2)
        self.names = [name for name, _ in counts]
        self.vectors = np.zeros((len(counts), len(place)))
        for row, (_, words) in enumerate(counts):
            for word, n in words.items():
                self.vectors[row, place[word]] = n * self.idf[place[word]]
        norms = np.linalg.norm(self.vectors, axis=1, keepdims=True)
        self.vectors /= np.where(norms > 0, norms, 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word among the templates' words, -1 for others."""
        out = np.full(len(hashes), -1)
        at = np.flatnonzero(self.filter[hashes >> np.uint64(48)])
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[place] == hashes[at]
        out[at[same]] = place[same]
        return out

    def weighted(self, templates, lines: int, frequency: dict[int, int]) -> _Templates:
        """Those of ``templates`` whose words are all among these, by the frequencies of these."""
        plain = _Templates(templates)
        return _Templates(templates, lines, {i: frequency.get(int(w), 0) for i, w in enumerate(np.searchsorted(self.keys, plain.keys))})

    def best(self, found: np.ndarray, hashes: np.ndarray) -> tuple[str, float]:
        """Licence and cosine of one unit."""
        known = np.bincount(found[found >= 0], minlength=len(self.idf)) * self.idf
        _, others = np.unique(hashes[found < 0], return_counts=True)
        norm = math.sqrt(float((known**2).sum() + ((others * self.rarest) ** 2).sum()))
        cosines = self.vectors @ known / norm if norm else np.zeros(len(self.names))
        score, name = min((-c, n) for c, n in zip(cosines.tolist(), self.names, strict=True))
        return name, -score


def _lines(part: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte range of every line; lines end at line feeds and rows."""
    ends = np.union1d(np.flatnonzero(part == 0x0A), cuts[1:])
    starts = np.union1d(np.flatnonzero(part == 0x0A) + 1, cuts[:-1])
    starts = starts[starts < len(part)] if len(part) else starts[:0]
    at = np.searchsorted(ends, starts)
    # An end at a line's first byte is that of the row before, unless the line is empty.
    at += (ends[at] == starts) & (part[starts] != 0x0A)
    return starts, ends[at]


def _frequencies(plain: _Templates):
    """Lines of a task that hold each template word, and all its lines with words (word -1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, lines = np.zeros(len(plain.words), np.int64), 0
        for batch in batches:
            data, offsets = kernels.buffers(batch.column(0))
            for _, _, part, cuts in kernels.pieces(data, offsets):
                part = kernels.LOWER[part]
                starts, ends, _ = kernels.tokens(part, cuts, kernels.WORD_BYTES)
                begin, _ = _lines(part, cuts)
                line = np.searchsorted(begin, starts, "right")
                lines += len(np.unique(line))
                found = plain.find(kernels.token_hashes(part, starts, ends))
                pairs = np.unique(line[found >= 0] * len(plain.words) + found[found >= 0])
                totals += np.bincount(pairs % len(plain.words), minlength=len(plain.words))
        words = np.append(np.arange(len(totals)), -1)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int32()), pa.array(np.append(totals, lines), pa.int64())], ["word", "n"])

    return count


def _units(raw: bytes) -> Iterator[tuple[int, int]]:
    """Paragraphs of more than one line, and the whole text if it has more than one paragraph."""
    at, blocks = 0, []
    for block in raw.split(b"\n\n"):
        if block.strip():
            blocks.append((at, at + len(block)))
        at += len(block) + 2
    yield from (b for b in blocks if b"\n" in raw[b[0] : b[1]].strip())
    if len(blocks) > 1:
        yield 0, len(raw)


def _scan(model: _Templates, texts: _Templates, text_col: str, least: float):
    def bound(known: np.ndarray, others: np.ndarray) -> np.ndarray:
        """No cosine of a unit is larger, given the idf of its known words and the number of the others."""
        return known / np.sqrt(np.maximum(known**2 + others * model.rarest**2, 1e-300))

    def hits(part: np.ndarray, cuts: np.ndarray) -> list[list[dict]]:
        low = kernels.LOWER[part]
        starts, ends, first = kernels.tokens(low, cuts, kernels.WORD_BYTES)
        hashes = kernels.token_hashes(low, starts, ends)
        found = model.find(hashes)
        known = np.concatenate([[0.0], np.cumsum(np.where(found >= 0, model.idf[found], 0))])
        others = np.concatenate([[0], np.cumsum(found < 0)])
        out: list[list[dict]] = [[] for _ in range(len(cuts) - 1)]

        def judge(row: int, start: int, stop: int) -> None:
            i, j = np.searchsorted(starts, [start, stop])
            if i < j and bound(known[j] - known[i], others[j] - others[i]) >= least:
                name, score = model.best(found[i:j], hashes[i:j])
                if score >= least:
                    out[row].append({"licence": name, "score": score, "start": start - int(cuts[row]), "stop": stop - int(cuts[row])})

        begin, end = _lines(part, cuts)
        i, j = np.searchsorted(starts, begin), np.searchsorted(starts, end)
        for line in np.flatnonzero((i < j) & (bound(known[j] - known[i], others[j] - others[i]) >= least)).tolist():
            judge(int(np.searchsorted(cuts, begin[line], "right")) - 1, int(begin[line]), int(end[line]))
        for row in range(len(cuts) - 1):
            # A unit of several lines can only pass if the whole is made of licence lines for a good part.
            if first[row + 1] > first[row]:
                raw = part[cuts[row] : cuts[row + 1]].tobytes()
                if b"\n" in raw:
                    for a, b in _units(raw):
                        judge(row, int(cuts[row]) + a, int(cuts[row]) + b)
                    out[row] = largest(out[row], raw)
        # A file that is a whole licence text has that licence only.
        found = texts.find(hashes)
        known = np.concatenate([[0.0], np.cumsum(np.where(found >= 0, texts.idf[found], 0))])[first]
        others = np.concatenate([[0], np.cumsum(found < 0)])[first]
        for row in np.flatnonzero((np.diff(first) > 0) & (bound(np.diff(known), np.diff(others)) >= TEXT_LEAST)).tolist():
            name, score = texts.best(found[first[row] : first[row + 1]], hashes[first[row] : first[row + 1]])
            if score >= TEXT_LEAST:
                out[row] = [{"licence": name, "score": score, "start": 0, "stop": int(cuts[row + 1] - cuts[row])}]
        return out

    def largest(found: list[dict], raw: bytes) -> list[dict]:
        """Hits without those inside a larger one of several lines that decides."""
        large = [h for h in found if h["score"] >= TEXT_LEAST and b"\n" in raw[h["start"] : h["stop"]].strip()]
        inner = lambda h, o: o is not h and o["start"] <= h["start"] and h["stop"] <= o["stop"] and o["stop"] - o["start"] > h["stop"] - h["start"]
        return [h for h in found if not any(inner(h, o) for o in large)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.buffers(batch.column(batch.schema.names.index(text_col)))
            found: list[list[dict]] = []
            for _, _, part, cuts in kernels.pieces(data, offsets):
                found += hits(part, cuts)
            sizes = np.diff(offsets)
            whole = [any(h["stop"] - h["start"] >= 0.8 * n for h in row) for row, n in zip(found, sizes, strict=True)]
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != text_col]
            arrays = [c for _, c in kept] + [pa.array(found, _HIT_TYPE), pa.array(whole, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [n for n, _ in kept] + ["_lc_hits", "_lc_whole"])

    return scan


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """All columns of ``files`` but the text, ``_lc_hits`` (licence, cosine, byte range), ``_lc_licence``, ``_lc_score``, ``_lc_origin`` and ``_lc_from``.

    ``_lc_origin`` is ``own``, ``inherited`` or null; ``_lc_from`` is the
    directory whose licence is inherited.
    """
    whole = whole_texts()
    templates = [*templates, *headers()]
    texts, plain = files.select(text_col), _Templates([*templates, *whole])
    counts = texts.mapInArrow(_frequencies(plain), "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    frequency = {r["word"]: r["n"] for r in counts}
    lines = frequency.pop(-1, 0)
    model, large = plain.weighted(templates, lines, frequency), plain.weighted(whole, lines, frequency)
    own_columns = [c for c in files.columns if c != text_col]
    schema = T.StructType([f for f in files.schema.fields if f.name != text_col]).add("_lc_hits", T.ArrayType(HIT)).add("_lc_whole", "boolean")
    found = cut_lineage(files.mapInArrow(_scan(model, large, text_col, least), schema), "licences")
    best = F.aggregate(
        "_lc_hits",
        F.lit(None).cast(HIT),
        lambda top, x: F.when(top.isNull() | (x["score"] > top["score"]) | ((x["score"] == top["score"]) & (x["licence"] < top["licence"])), x).otherwise(top),
    )
    path = F.col(path_col)
    found = found.withColumn("_lc_best", best).withColumn("_lc_dir", F.regexp_extract(path, r"^(.*)/[^/]*$", 1))
    named = F.element_at(F.split(path, "/"), -1).rlike(FILE_NAMES)
    licensing = found.filter(path.isNotNull() & F.col("_lc_best").isNotNull() & (F.col("_lc_whole") | named))
    first = F.min(F.struct((-F.col("_lc_best.score")).alias("order"), F.col("_lc_best.licence").alias("licence")))
    licensed = cut_lineage(licensing.groupBy(F.col("_lc_dir").alias("above")).agg(first.alias("first")), "licensed")
    directories = found.filter(path.isNotNull()).select("_lc_dir").distinct()
    parts = F.split("_lc_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    pairs = directories.select("_lc_dir", F.explode(F.array_distinct(above)).alias("above")).join(licensed, "above")
    nearest = pairs.groupBy("_lc_dir").agg(F.max(F.struct(F.length("above").alias("depth"), "above", "first")).alias("near"))
    nearest = cut_lineage(nearest.select("_lc_dir", "near.above", "near.first"), "inherited")
    out = found.join(nearest, "_lc_dir", "left")
    own = F.col("_lc_best").isNotNull()
    return out.select(
        *own_columns,
        "_lc_hits",
        F.when(own, F.col("_lc_best.licence")).otherwise(F.col("first.licence")).alias("_lc_licence"),
        F.when(own, F.col("_lc_best.score")).otherwise(-F.col("first.order")).alias("_lc_score"),
        F.when(own, "own").when(F.col("first").isNotNull(), "inherited").alias("_lc_origin"),
        F.when(~own, F.col("above")).alias("_lc_from"),
    )
