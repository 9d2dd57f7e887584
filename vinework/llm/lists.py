"""Links between members of lists, for any symmetric check of two members, without pairs leaving a task.

A list is a set of rows that share a key, such as a hash bucket. Only the
connected members matter, so a pair is not checked when its members are known
to be connected: in a list of copies the first member is checked with all
others and nothing else is. What leaves a task are links from each member to
the first one it is connected with.

Long lists are cut into parts by the weight of their members, and the first
member of a list is a guest in each part. Where parts stay unconnected, only
members that are not connected with the first one go on: they are checked with
all members, part against part, each two parts in a task of their own. So a
hot list of near copies is read once, and a list without links costs what it
must: all its pairs, spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinework.llm.components import connected
from vinework.runtime import cut_lineage

# Given the payload of a run of whole lists: a function that checks rows i[k] with j[k] for all k.
Check = Callable[[pa.Table], Callable[[np.ndarray, np.ndarray], np.ndarray]]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]: the smallest index of each component."""
    label = label.copy()
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


def _star(table: pa.Table, check: Check) -> pa.RecordBatch:
    """Links of a run of whole cells, sorted by cell and, in a cell of two parts, with those that ask first."""
    starts = _starts(table)
    n = table.num_rows
    sizes = np.diff(np.append(starts, n))
    group = np.repeat(np.arange(len(starts)), sizes)
    asks = np.asarray(table.column("asks"))
    askers = np.add.reduceat(asks, starts, dtype=np.int64)
    crossing = askers < sizes  # else all rows ask, and each is checked with those after it
    test = check(table)
    label, at, turn, joined = np.arange(n), np.arange(n), 0, 1
    firsts, seconds = [], []
    while True:
        pivot = starts + turn
        open_ = np.where(crossing, turn < askers, turn + 1 < sizes)
        lowest = np.where(crossing, starts + askers, pivot + 1)
        at = at[(at >= lowest[group[at]]) & open_[group[at]]]
        if not len(at):
            break
        other = pivot[group[at]]
        apart = label[at] != label[other]
        i, j = other[apart], at[apart]
        if len(i):
            linked = test(i, j)
            firsts.append(i[linked])
            seconds.append(j[linked])
        turn += 1
        if turn == joined:  # after 1, 2, 4, ... turns
            joined *= 2
            if firsts:
                label = join_labels(label, np.concatenate(firsts), np.concatenate(seconds))
                firsts, seconds = [], []
            whole = np.minimum.reduceat(label, starts) == np.maximum.reduceat(label, starts)
            at = at[~whole[group[at]]]
    if firsts:
        label = join_labels(label, np.concatenate(firsts), np.concatenate(seconds))
    member = np.flatnonzero(label != np.arange(n))
    node = np.asarray(table.column("node"))
    return pa.RecordBatch.from_arrays([pa.array(node[member]), pa.array(node[label[member]])], ["a", "b"])


def _starts(table: pa.Table) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for name in ("list", "cell"):
        values = np.asarray(table.column(name))
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def _reduced(cells: DataFrame, check: Check) -> DataFrame:
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = _starts(pa.Table.from_batches([batch]))
            last = held and (held[-1].column(0)[-1], held[-1].column(1)[-1])
            same = last and last == (batch.column(0)[0], batch.column(1)[0])
            if same and len(starts) == 1:
                held.append(batch)
                continue
            # The last list may go on in the next batch.
            whole = [*held, batch.slice(0, int(starts[-1]))]
            held = [batch.slice(int(starts[-1]))]
            if sum(b.num_rows for b in whole):
                yield _star(pa.Table.from_batches(whole).combine_chunks(), check)
        if held:
            yield _star(pa.Table.from_batches(held).combine_chunks(), check)

    placed = cells.repartition("list", "cell").sortWithinPartitions("list", "cell", F.desc("asks"), "node")
    return placed.mapInArrow(reduce, "a bigint, b bigint")


def links(members: DataFrame, payload: list[str], check: Check, limit: int) -> DataFrame:
    """``a, b``: links whose components are those of all pairs that share a list and pass the check.

    ``members`` are a written table or a cheap plan over one, with bigint
    columns ``list``, ``node`` and ``weight``; a part of a list weighs about
    ``limit``. ``check`` gets all rows of some lists at once.
    """
    sizes = members.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("all"), F.min("node").alias("first")).filter("n >= 2")
    parts = F.ceil(F.col("all") / limit).cast("int")
    sizes = cut_lineage(sizes.select("list", "first", parts.alias("parts")), "lists")
    met = members.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("bigint"))
    guest = F.when(F.col("node") == F.col("first"), F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1))
    cell = F.explode(F.coalesce(guest, F.array("part"))).alias("cell")
    found = _reduced(met.select("list", cell, F.lit(1).cast("tinyint").alias("asks"), "node", *payload), check)
    if not sizes.filter("parts > 1").head(1):
        return found
    found = cut_lineage(found, "within")
    roots = connected(found)
    long = met.filter("parts > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    long = cut_lineage(long.select("list", "node", "first", "parts", "part", "root", *payload), "long")
    first = long.filter("node = first").select("list", F.col("root").alias("first_root"))
    loose = cut_lineage(long.join(first, "list").filter("root != first_root"), "loose")
    rounds = loose.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    share = long.groupBy("list").agg(F.count(F.lit(1)).alias("members"))
    # Loose members are dealt to as many parts as keep a cell as heavy as before.
    asking = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("parts") / F.col("members"))).cast("bigint").alias("asking")
    counts = long.filter("node = first").select("list", "parts").join(rounds, "list").join(share, "list").select("list", asking)
    counts = cut_lineage(counts, "asking")
    hashed = F.xxhash64("node", F.lit(1))
    ask = loose.join(counts, "list").withColumn("mine", F.pmod(hashed, F.col("asking")))
    ask = ask.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)))
    answer = long.join(counts, "list").withColumn("mine", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asking") - 1)))
    cell = (F.col("mine") * F.col("parts") + F.col("part")).alias("cell")
    cells = ask.select("list", cell, F.lit(1).cast("tinyint").alias("asks"), "node", *payload).unionByName(
        answer.select("list", cell, F.lit(0).cast("tinyint").alias("asks"), "node", *payload)
    )
    return found.unionByName(_reduced(cells, check))
