"""Texts of an Arrow batch as one byte array, for numpy work without a loop over rows.

Hashes are polynomials modulo 2**64 with one random word per byte value, taken from prefix
sums, so that the hash of any span costs one subtraction and one product.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 2**64, dtype=np.uint64)) | 1
_UNBASE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}

BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        table = _powers[base] = np.multiply.accumulate(steps)
    return table[:n]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `most` bytes of text at most; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, offsets = texts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and the next stage needs room."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of the maximal runs of other bytes than `blank`, that is [\\x20\\x09-\\x0D]."""
    solid = ~blank[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Hashes of any spans of a byte array."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * _power_table(_BASE, len(data)), out=self.sums[1:])
        self.back = _power_table(_UNBASE, len(data) + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hashes of the spans of `width` bytes at every place."""
        n = max(len(self.sums) - width, 0)
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n])


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `values`, of the given lengths (0 allowed)."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=sums[1:])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
