"""Posting rows of a text index made from whole columns, inside Arrow batches on the executors.

A posting row is a *run*: one term's documents in some blocks of one task, with
bounds per block. A run ends with the block that fills it up to ``RUN``
documents, so rare terms have a row per task and not one per block. What a
task holds is bounded by the words that the index deals to it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Ship these helpers with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = 256  # documents of a term, after which a block begins another run
ROWS = 8_192  # posting rows that leave a task at once
FLUSH = 1 << 20  # entries that a compaction deals out at once
BATCH_SHIFT, KIND_SHIFT = 44, 34  # of a block's number: its batch, its class of length, its part of the class

Batches = Iterator[pa.RecordBatch]


def posting_schema(id_type: str) -> str:
    return (
        "term string, block bigint, n int, max_tf int, min_length int, blocks array<bigint>, starts array<int>, sizes array<int>, "
        f"max_tfs array<int>, min_lengths array<int>, ids array<{id_type}>, tfs array<int>, lengths array<int>"
    )


def lot_schema(id_type: str) -> str:
    return (
        f"task int, batches array<int>, ids array<{id_type}>, blocks array<bigint>, lengths array<int>, "
        "terms array<string>, counts array<int>, docs array<int>, tfs array<int>"
    )


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _sizes(lists: pa.Array) -> np.ndarray:
    return _numbers(pc.list_value_length(lists)).astype(np.int64)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _coded(parts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and the number of each value among them; null is a value."""
    found = pa.concat_arrays(parts).dictionary_encode(null_encoding="encode")
    return found.dictionary, _numbers(found.indices).astype(np.int64)


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return new


def _lists(values, starts: np.ndarray) -> pa.ListArray:
    """Lists that begin at ``starts`` and end where the next begins."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array(np.r_[starts, len(values)].astype(np.int32)), values)


def _by_place(block: np.ndarray, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Order of documents by block and id, and each one's place in it."""
    order = _numbers(pc.sort_indices(pa.table({"block": block, "id": ids}), sort_keys=[("block", "ascending"), ("id", "ascending")]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return order.astype(np.int64), place


def _rows(vocabulary: pa.Array, block: np.ndarray, ids: pa.Array, length: np.ndarray, key: np.ndarray, tf: np.ndarray) -> Batches:
    """Posting rows. Documents are in the order of block and id, entries in that of ``key``: term, then document."""
    if not len(key):
        return
    term, doc = np.divmod(key, len(block))
    its_block, its_length = block[doc], length[doc].astype(np.int32)
    pairs = np.flatnonzero(_changes(term, its_block))
    first = _changes(term[pairs])
    begun = pairs[np.maximum.accumulate(np.where(first, np.arange(len(pairs)), 0))]
    new = first | _changes((pairs - begun) // RUN)
    runs = np.flatnonzero(new)
    starts = pairs[runs]
    max_tf, min_length = np.maximum.reduceat(tf, pairs), np.minimum.reduceat(its_length, pairs)
    out = {
        "term": vocabulary.take(pa.array(term[starts])),
        "block": its_block[starts],
        "n": np.diff(np.r_[starts, len(key)]).astype(np.int32),
        "max_tf": np.maximum.reduceat(max_tf, runs),
        "min_length": np.minimum.reduceat(min_length, runs),
        "blocks": _lists(its_block[pairs], runs),
        "starts": _lists((pairs - starts[np.cumsum(new) - 1]).astype(np.int32), runs),
        "sizes": _lists(np.diff(np.r_[pairs, len(key)]).astype(np.int32), runs),
        "max_tfs": _lists(max_tf, runs),
        "min_lengths": _lists(min_length, runs),
        "ids": _lists(ids.take(pa.array(doc)), starts),
        "tfs": _lists(tf, starts),
        "lengths": _lists(its_length, starts),
    }
    table = pa.RecordBatch.from_pydict({name: column if isinstance(column, pa.Array) else pa.array(column) for name, column in out.items()})
    for start in range(0, table.num_rows, ROWS):
        yield table.slice(start, ROWS)


def of_texts(batches: Batches) -> Batches:
    """Posting rows of a task's documents ``id, block, length, terms``."""
    vocabulary, ids, block, length, codes, sizes, n = [], [], [], [], [], [], 0
    for batch in batches:
        found = batch.column("terms").flatten().dictionary_encode()
        vocabulary.append(found.dictionary)
        codes.append(_numbers(found.indices).astype(np.int64) + n)
        n += len(found.dictionary)
        ids.append(batch.column("id"))
        block.append(_numbers(batch.column("block")))
        length.append(_numbers(batch.column("length")))
        sizes.append(_sizes(batch.column("terms")))
    if not n:
        return
    vocabulary, known = _coded(vocabulary)
    ids, block, length = pa.concat_arrays(ids), _joined(block), _joined(length)
    order, place = _by_place(block, ids)
    key = known[_joined(codes)] * len(ids) + np.repeat(place, _joined(sizes))
    key.sort()
    first = np.flatnonzero(_changes(key))
    tf = np.diff(np.r_[first, len(key)]).astype(np.int32)
    yield from _rows(vocabulary, block[order], ids.take(pa.array(order)), length[order], key[first], tf)


def dealing(classes: list[tuple[int, int, int]], seq: int, tasks: list[int]) -> Callable[[Batches], Batches]:
    """Deals the entries of posting rows, with ``hashes`` of the ids, to the tasks that hold their new blocks.

    ``classes`` are number, parts and least length of the classes of length,
    ``tasks`` has the value that stands for each task. A row without a term
    marks its documents as gone.
    """
    kinds, parts, least = (np.array(x, np.int64) for x in zip(*classes, strict=True))
    tasks = np.array(tasks, np.int32)

    def deal(batches: Batches) -> Batches:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += int(_sizes(batch.column("ids")).sum())
            if n >= FLUSH:
                yield dealt(held)
                held, n = [], 0
        if n:
            yield dealt(held)

    def dealt(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
        flat = {name: column[name].flatten() for name in ("ids", "tfs", "lengths", "hashes")}
        sizes = _sizes(column["ids"])
        terms, term = _coded([column["term"]])
        names, name = _coded([flat["ids"]])
        batch = np.repeat(_numbers(column["block"]) >> BATCH_SHIFT, sizes)
        # Documents, in the order of their tasks.
        _, some, doc = np.unique(batch * len(names) + name, return_index=True, return_inverse=True)
        length = _numbers(flat["lengths"])[some].astype(np.int64)
        kind = np.maximum(np.searchsorted(least, length, "right") - 1, 0)
        block = (seq << BATCH_SHIFT) + (kinds[kind] << KIND_SHIFT) + np.mod(_numbers(flat["hashes"])[some], parts[kind])
        task = ((block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % len(tasks)
        order = np.argsort(task, kind="stable")
        task, some = task[order], some[order]
        first = np.flatnonzero(_changes(task))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc = place[doc]
        # Entries, by task and term.
        key = task[doc] * len(terms) + np.repeat(term, sizes)
        by = np.argsort(key, kind="stable")
        key, doc = key[by], doc[by]
        pairs = np.flatnonzero(_changes(key))
        owner, word = np.divmod(key[pairs], len(terms))
        lots = np.flatnonzero(_changes(owner))
        starts = pairs[lots]
        base = np.repeat(first, np.diff(np.r_[starts, len(key)]))
        return pa.RecordBatch.from_pydict({
            "task": pa.array(tasks[owner[lots]]),
            "batches": _lists(batch[some].astype(np.int32), first),
            "ids": _lists(flat["ids"].take(pa.array(some)), first),
            "blocks": _lists(block[order], first),
            "lengths": _lists(length[order].astype(np.int32), first),
            "terms": _lists(terms.take(pa.array(word)), lots),
            "counts": _lists(np.diff(np.r_[pairs, len(key)]).astype(np.int32), lots),
            "docs": _lists((doc - base).astype(np.int32), starts),
            "tfs": _lists(_numbers(flat["tfs"])[by].astype(np.int32), starts),
        })

    return deal


def of_lots(batches: Batches) -> Batches:
    """Posting rows of what was dealt to a task; documents that are marked as gone in their batch are left out."""
    vocabulary, term, doc, tf, n_terms, n_docs = [], [], [], [], 0, 0
    ids, batch_of, block, length = [], [], [], []
    for batch in batches:
        found = batch.column("terms").flatten().dictionary_encode(null_encoding="encode")
        vocabulary.append(found.dictionary)
        term.append(np.repeat(_numbers(found.indices).astype(np.int64) + n_terms, _numbers(batch.column("counts").flatten())))
        n_terms += len(found.dictionary)
        held = _sizes(batch.column("ids"))
        begun = n_docs + np.cumsum(held) - held
        doc.append(_numbers(batch.column("docs").flatten()) + np.repeat(begun, _sizes(batch.column("docs"))))
        n_docs += int(held.sum())
        tf.append(_numbers(batch.column("tfs").flatten()))
        ids.append(batch.column("ids").flatten())
        batch_of.append(_numbers(batch.column("batches").flatten()))
        block.append(_numbers(batch.column("blocks").flatten()))
        length.append(_numbers(batch.column("lengths").flatten()))
    if not n_docs:
        return
    vocabulary, known = _coded(vocabulary)
    names, name = _coded(ids)
    _, some, same = np.unique(_joined(batch_of).astype(np.int64) * len(names) + name, return_index=True, return_inverse=True)
    term, doc, tf = known[_joined(term)], same[_joined(doc)], _joined(tf).astype(np.int32)
    mark = _numbers(vocabulary.is_null())[term]
    gone = np.zeros(len(some), bool)
    gone[doc[mark]] = True
    live = ~gone[doc]
    term, doc, tf = term[live], doc[live], tf[live]
    ids, block, length = pa.concat_arrays(ids).take(pa.array(some)), _joined(block)[some], _joined(length)[some]
    order, place = _by_place(block, ids)
    key = term * len(some) + place[doc]
    by = np.argsort(key)
    yield from _rows(vocabulary, block[order], ids.take(pa.array(order)), length[order], key[by], tf[by])
