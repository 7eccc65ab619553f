"""Vectorised work on the bytes of many texts at once, for use inside tasks.

Texts come as Arrow string columns and are read in place. A null text counts as empty. Work goes
in chunks of about two megabytes whatever the batch, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 21


def _fold_case() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _mask(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


LOWER = _fold_case()
# Bytes of words split at white space, and of words of letters and digits (any byte over 7F).
SPACED = ~_mask((0x20, 0x20), (0x09, 0x0D))
ALNUM = ~_mask((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constant(n: int) -> np.uint64:
    return np.uint64((n * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) % (1 << 64))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column."""
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most `limit` bytes together; a longer row stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    """Starts and ends of the words of each row, and the number of words before each row."""
    inside = kind[data]
    n = len(data)
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False
    edges = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    after[edges] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_counts(column: pa.Array, kind: np.ndarray) -> np.ndarray:
    data, offsets = utf8(column)
    out = np.zeros(len(column), np.int64)
    for low, high in chunks(offsets):
        at = offsets[low : high + 1] - offsets[low]
        first = word_spans(data[offsets[low] : offsets[high]], at, kind)[2]
        out[low:high] = np.diff(first)
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at given spans, in blocks so that one long row stays cheap."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + CHUNK, "right")))
        first, last = int(starts[low]), int(ends[high - 1])
        if last - first > CHUNK:
            out[low] = _long_hash(data[first:last])
            low = high
            continue
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_TABLE[data[first:last]] * powers(last - first), out=sums[1:])
        a, b = starts[low:high] - first, ends[low:high] - first
        value = (sums[b] - sums[a]) * powers(last - first + 1, inverse=True)[a]
        out[low:high] = mix(value + (b - a).astype(np.uint64) * constant(1))
        low = high
    return out


def _long_hash(data: np.ndarray) -> np.uint64:
    total = np.zeros(1, np.uint64)
    for at in range(0, len(data), CHUNK):
        piece = data[at : at + CHUNK]
        part = np.array([(_TABLE[piece] * powers(len(piece))).sum(dtype=np.uint64)])
        total = mix(total * constant(2) + part + np.uint64(len(piece)))
    return total[0]


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each `width` consecutive values; rows are not told apart here."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] + constant(10 + width)
    for k in range(1, width):
        total = mix(total) * constant(3) + words[k : k + n]
    return mix(total)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of [start, start + length), one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begin, lengths)


def longs(values) -> pa.Array:
    """A 64-bit column; unsigned values keep their bits."""
    values = np.asarray(values)
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def long_lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """A list column of `n` rows from values and the rows they belong to, in row order."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), longs(values))
