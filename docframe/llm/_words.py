"""Vectorised word scanning over Arrow text columns: no Python object per word.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a polynomial over per-byte random
values modulo 2**64 (prefix sums give every word of a buffer at once), finished by a bit mixer.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STEP = 1 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return freed memory to the system: a worker stays after its task, beside the next stage's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim(0)


def lean(run):
    """run (batches to batches), after whose last batch the worker holds what it needs only."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


_MULT = 0x9E3779B97F4A7C15
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_VALUE_LOWER = _VALUE[LOWER]
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < n:
        n = max(n, _STEP + 4096)
        inverse = pow(_MULT, -1, 1 << 64)
        for name, base in (("p", _MULT), ("i", inverse)):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _powers[name] = np.cumprod(out, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, nulls empty, and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = column.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word's index of each row (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hashes of sorted byte spans of data; memory stays near _STEP bytes' worth, or the longest span's."""
    out = np.empty(len(starts), np.uint64)
    values = _VALUE_LOWER if lower else _VALUE
    i, n = 0, len(starts)
    while i < n:
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(starts, base + _STEP)))
        top = int(ends[j - 1] - base) if j else 0
        power, inverse = _power(top + 1)
        sums = np.zeros(top + 1, np.uint64)
        np.cumsum(values[data[base : base + top]] * power[:top], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
        i = j
    return mix(out)


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each row's first word plus the end)."""
    data, offsets = text_buffer(column)
    starts, ends, rows = word_bounds(data, offsets)
    return hash_spans(data, starts, ends, lower), rows


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece holds about `most` text bytes, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        total = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))])
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
