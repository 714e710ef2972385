"""Whole texts of an Arrow batch as one array, and hashes of all its spans at once.

Shared by the operators that slide windows over texts. Everything here runs inside a task on one
bounded slice of a batch; Spark does the partitioning.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # text handled at once by numpy; one longer document is one slice
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice has at most ``limit`` bytes of text, or one row.

    Workers are used again by later stages, so free memory is given back before and after a task.
    """
    give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def give_back() -> None:
    """Return memory that Arrow and the C library keep although nothing uses it any more."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offset of each text (one more than texts)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            values = np.full(size, base)
            values[0] = 1
            _powers[i] = np.cumprod(values, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums from which :func:`span_hash` takes the hash of any span of ``values``."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][:-1], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end); equal spans have equal hashes wherever they lie."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix_hash(_BYTES[data])


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        x = pick(x[:-reach], x[reach:])
        reach *= 2
    return pick(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def winnow(grams: np.ndarray, width: int, inside: np.ndarray) -> np.ndarray:
    """Which grams are the smallest of some window of ``width`` grams; ties all count.

    ``inside[s]`` tells whether the window that starts at gram ``s`` lies in one document. The
    choice depends on the content of the window alone, so equal windows choose alike.
    """
    least = np.where(inside, _sliding(grams, width, np.minimum), np.uint64(0))
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    return (_sliding(padded, width, np.maximum) == grams) & (grams > 0)


def words(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and document of each maximal run of bytes that are not ``separator[byte]``."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    open_ = ~separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    before = np.concatenate(([False], open_[:-1])) & ~first[:-1]
    after = np.concatenate((open_[1:], [False])) & ~first[1:]
    start = np.flatnonzero(open_ & ~before)
    end = np.flatnonzero(open_ & ~after) + 1
    return start, end, np.searchsorted(bounds, start, "right") - 1


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
