"""Sorted 64-bit keys in compact rows, exchanged between chunks and key ranges.

A *chunk* is a bounded group of documents, a *bucket* a range of the key
space. One row carries all keys that a chunk has in a bucket: the differences
of the sorted keys, byte plane by byte plane, so that the zero bytes compress
away in the shuffle. A key costs about six bytes instead of twenty or more as
a row of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession

PER_PARTITION = 2


def parts(spark: SparkSession) -> int:
    """Number of chunks and of buckets: some for each shuffle partition.

    Their size follows from ``spark.sql.shuffle.partitions``, the setting that
    says how finely this cluster's data is dealt.
    """
    return PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as byte planes of their differences."""
    steps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def planes(values: np.ndarray) -> bytes:
    """Values of one numeric type as byte planes."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def from_planes(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def bucket_edges(keys: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of ascending ``keys`` in ``n`` equal ranges of the key space."""
    if not len(keys):
        return []
    borders = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    cuts = np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])
    return [(int(b), int(cuts[b]), int(cuts[b + 1])) for b in np.flatnonzero(np.diff(cuts))]
