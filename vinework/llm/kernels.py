"""Array kernels on the bytes of text columns, shared by the operators.

Texts arrive as Arrow string columns. A batch is worked off in pieces of about
``PIECE_BYTES`` so that temporary arrays stay small; one text is never cut, so
a piece can be as large as the largest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_MIX_A = np.uint64(0x9E3779B97F4A7C15)
_MIX_B = np.uint64(0xBF58476D1CE4E5B9)
_MIX_C = np.uint64(0x94D049BB133111EB)
_LOW_BYTES = (np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the byte values in inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Words that end at ASCII white space, and words of letters and digits.
NON_SPACE = ~byte_table((0x09, 0x0D), (0x20, 0x20))
WORD_BYTES = byte_table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER_TABLE = LOWER.tobytes()


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows with at most ``limit`` bytes, or one larger row: first row, end row, bytes, offsets."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def tokens(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every run of ``inside`` bytes, and the first token of every row (one more entry than rows).

    Runs end at row boundaries.
    """
    mask = inside[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = mask[edges]
    stops[edges - 1] = mask[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_B
    x = (x ^ (x >> np.uint64(27))) * _MIX_C
    return x ^ (x >> np.uint64(31))


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every token's bytes, read eight at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) + _MIX_A)
    left, where, at = length, None, starts
    while len(at):
        word = words[at]
        short = left < 8
        word[short] &= _LOW_BYTES[left[short]]
        if where is None:
            out = mix((out ^ word) * _MIX_A)
            where = np.flatnonzero(left > 8)
        else:
            out[where] = mix((out[where] ^ word) * _MIX_A)
            more = left > 8
            where = where[more]
        keep = left > 8
        at, left = at[keep] + 8, left[keep] - 8
    return out


_ROLL = np.uint64(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_UNROLL = np.uint64(pow(int(_ROLL), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive tokens, modulo 2**64.

    Entry i covers tokens i to i + width - 1, over row boundaries too; callers
    drop those.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(_ROLL, n), out=sums[1:])
    rolled = (sums[width:] - sums[:-width]) * _powers(_UNROLL, n - width + 1)
    return mix(rolled)


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """First tokens of the windows that lie inside one row, ascending."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    skipped = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(len(skipped)) + skipped


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a window that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``first``."""
    total = np.concatenate([np.zeros(1, np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]
