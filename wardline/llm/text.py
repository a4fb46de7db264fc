"""Whole-text arithmetic on Arrow batches: bytes, words and rolling hashes.

Every function here works on the bytes of a slice of documents at once.  Hashes
are 64-bit polynomials of randomised byte or word values, taken modulo 2**64 and
mixed, so that any stretch of a text is hashed by two look-ups in a prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes and rows of text worked on at once; a longer document is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 1 << 15

#: ASCII white space: the complement of the contracts' ``[^\x20\x09-\x0D]``.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, everything else as it is.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


#: Byte values of a second hash, for what only its hashes speak for.
SECOND_VALUES = mix(BYTE_VALUES ^ np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)


class _Powers:
    """Powers of a multiplier modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.values = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, SLICE_BYTES + 1), self.base, dtype=np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_FORWARD, _BACKWARD = _Powers(_BASE), _Powers(_INVERSE)


class PrefixHash:
    """Hash of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * _FORWARD.upto(len(values)), out=self.sums[1:])
        self.inverse = _BACKWARD.upto(len(values) + 1)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of text at most, or one row."""
    for batch in (whole.slice(a, SLICE_ROWS) for whole in batches for a in range(0, whole.num_rows, SLICE_ROWS)):
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cut = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        starts = np.flatnonzero(np.diff(cut, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a slice of documents."""

    def __init__(self, column: pa.Array, fold: bool = False):
        self.data, self.offsets = text_bytes(column)
        if fold:
            self.data = FOLD[self.data]
        n = len(self.data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        inside = ~WHITE[self.data]
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.counts = np.diff(np.searchsorted(self.starts, self.offsets))
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        lengths = self.ends - self.starts
        return mix(PrefixHash(values[self.data]).of(self.starts, lengths) + lengths.astype(np.uint64))

    def runs(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts (word numbers) and hashes of all runs of ``length`` words of one document."""
        if len(hashes) < length:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        starts = np.flatnonzero(self.doc[: len(hashes) - length + 1] == self.doc[length - 1 :])
        return starts, mix(PrefixHash(hashes).of(starts, length) ^ np.uint64(length))
