"""Main text of web pages by differencing pages with near URLs.

Every page is cut to text blocks. Within a host, each page is paired with the
page next to it in the order of URL paths, on the side with the longer common
path, and their blocks are aligned by a longest common subsequence: what two
different pages share is the site's, not the article's.

Where a page itself says what a block is, that counts first: blocks inside an
article or main element stay even if shared, as articles of a site do repeat
lines, and blocks inside menus, footers, adverts and the like go even if no
other page has them. The difference decides on all others, and on all of a page
whose only wrapper has the name of such a part.

Pages with the same blocks are one page of their host, so a page is never
compared with its own copies. What is paired, sorted and joined are hashes of
blocks; the html itself is only read.

Defined results: a null or empty page has the text ""; pages without a URL
belong to one host with an empty path; a host with one distinct page loses no
block by difference; repeated rows have the same text each. Extra columns are
untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vinework.llm import html
from vinework.runtime import cut_lineage

CELLS = 1 << 26  # bits of an alignment table; larger ones are halved first


def address(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; www. and m. are the same host as without."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").lower()
    except ValueError:
        return "", url or ""
    return host.removeprefix("www.").removeprefix("m."), parts.path


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _key(host: str, lines: list[int]) -> int:
    return xxhash.xxh64_intdigest(host.encode() + np.array(lines, np.int64).tobytes()) - (1 << 63)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path, block hashes and key of the pages with a block that only the difference can judge."""
    for batch in batches:
        rows = {"key": [], "host": [], "path": [], "lines": [], "undecided": []}
        for url, page in zip(batch.column("url"), batch.column("html"), strict=True):
            found = html.blocks(page.as_py() or "")
            host, path = address(url.as_py())
            lines = [_hash(text) for text, _ in found]
            rows["key"].append(_key(host, lines))
            rows["host"].append(host)
            rows["path"].append(path)
            rows["lines"].append(lines)
            rows["undecided"].append([i for i, (_, place) in enumerate(found) if place == html.OPEN])
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], list(rows))


def _columns(a: list[int], b: list[int]) -> Iterator[int]:
    """After each line of ``a``: bits over ``b`` that are 0 where the common subsequence grows."""
    where: dict[int, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions of ``a`` in a longest common subsequence of both."""
    inside = set(b)
    at = [i for i, line in enumerate(a) if line in inside]
    return [at[i] for i in _common([a[i] for i in at], [x for x in b if x in set(a)])]


def _common(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) <= CELLS or len(a) == 1:
        rows = list(_columns(a, b))
        out, i, j = [], len(a) - 1, len(b) - 1
        while i >= 0 and j >= 0:
            if a[i] == b[j]:
                out.append(i)
                i, j = i - 1, j - 1
            elif _length(rows[i - 1], j + 1) >= _length(rows[i], j) if i else False:
                i -= 1
            else:
                j -= 1
        return out[::-1]
    half = len(a) // 2
    first, second = a[:half], a[half:]
    *_, down = _columns(first, b)
    *_, up = _columns(second[::-1], b[::-1])
    grows = np.concatenate([[0], np.cumsum(_zeros(down, len(b)))])
    later = np.concatenate([[0], np.cumsum(_zeros(up, len(b)))])[::-1]
    cut = int(np.argmax(grows + later))
    return _common(first, b[:cut]) + [half + i for i in _common(second, b[cut:])]


def _zeros(row: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")
    return 1 - bits[:n].astype(np.int64)


def _length(row: int, n: int) -> int:
    """Length of the common subsequence with the first ``n`` lines."""
    return n - (row & ((1 << n) - 1)).bit_count()


def _common_path(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared blocks of every page with the nearer of its neighbours."""
    for batch in batches:
        keys, shared = [], []
        for row in batch.to_pylist():
            near = [x for x in (row["before"], row["after"]) if x is not None and x["host"] == row["host"]]
            if not near or not row["undecided"]:
                continue
            other = max(near, key=lambda x: _common_path(x["path"], row["path"]))  # noqa: B023
            mine = set(common_lines(row["lines"], other["lines"])) & set(row["undecided"])
            if mine:
                keys.append(row["key"])
                shared.append(sorted(mine))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shared, pa.list_(pa.int32()))], ["_mt_key", "_mt_shared"])


def shared_blocks(pages: DataFrame) -> DataFrame:
    """``_mt_key, _mt_shared``: the undecided blocks that a page shares with its neighbour, for distinct pages that have some.

    ``pages`` has ``url`` and ``html``. Pages are put in the order of host and
    path over all tasks; neighbours across the borders of tasks are joined.
    """
    schema = "key bigint, host string, path string, lines array<bigint>, undecided array<int>"
    found = pages.mapInArrow(_signatures, schema).groupBy("key", "host").agg(
        F.min("path").alias("path"), F.min("lines").alias("lines"), F.min("undecided").alias("undecided")
    )
    order = ["host", "path", "key"]
    ranged = cut_lineage(found.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranged")
    page = F.struct("host", "path", "lines")
    ends = ranged.groupBy("range").agg(F.min_by(page, F.struct(*order)).alias("first"), F.max_by(page, F.struct(*order)).alias("last"))
    ranges = Window.orderBy("range")
    ends = ends.select("range", F.lag("last").over(ranges).alias("ahead"), F.lead("first").over(ranges).alias("behind"))
    inside = Window.partitionBy("range").orderBy(*order)
    near = ranged.withColumn("before", F.lag(page).over(inside)).withColumn("after", F.lead(page).over(inside)).join(ends, "range")
    near = near.withColumn("before", F.coalesce("before", "ahead")).withColumn("after", F.coalesce("after", "behind"))
    return near.select("key", "host", "path", "lines", "undecided", "before", "after").mapInArrow(_differences, "_mt_key bigint, _mt_shared array<int>")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, ``_mt_text`` (the blocks of the main text joined by line ends) and ``_mt_gone`` (blocks that the difference took)."""
    shared = cut_lineage(shared_blocks(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))), "shared")
    own = [f for f in pages.schema.fields if f.name != html_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            keys, texts, places = [], [], []
            for url, page in zip(batch.column(names.index(url_col)), batch.column(names.index(html_col)), strict=True):
                found = html.blocks(page.as_py() or "")
                keys.append(_key(address(url.as_py())[0], [_hash(text) for text, _ in found]))
                kept = [(i, text) for i, (text, place) in enumerate(found) if place != html.ASIDE]
                texts.append([text for _, text in kept])
                places.append([i for i, _ in kept])
            arrays = [batch.column(names.index(f.name)) for f in own]
            arrays += [pa.array(keys, pa.int64()), pa.array(texts, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in own] + ["_mt_key", "_mt_blocks", "_mt_places"])

    schema = T.StructType([*own]).add("_mt_key", "long").add("_mt_blocks", T.ArrayType(T.StringType())).add("_mt_places", T.ArrayType(T.IntegerType()))
    marked = pages.mapInArrow(cut, schema).join(shared, "_mt_key", "left")
    gone = F.coalesce("_mt_shared", F.array().cast("array<int>"))
    kept = F.filter(F.arrays_zip("_mt_blocks", "_mt_places"), lambda x: ~F.array_contains(gone, x["_mt_places"]))
    text = F.array_join(F.transform(kept, lambda x: x["_mt_blocks"]), "\n")
    return marked.select(*[f.name for f in own], text.alias("_mt_text"), F.size(gone).alias("_mt_gone"))
