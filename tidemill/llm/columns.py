"""Numpy views of Arrow text columns, shared by the operators that run inside tasks.

A text column becomes one array of UTF-8 bytes with row offsets; a null counts as an empty text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once: temporary arrays are a small multiple of it.
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def release() -> None:
    """Give memory that a task no longer uses back: its worker goes on with other tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no part holds over ``limit`` bytes of text, unless it is one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, done = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])
    release()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the rows in one array, and the offsets at which rows begin and end."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte stays."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of byte strings that lie one after another in ``data``."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all rows, and the offsets of each row's words."""
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets), dtype=np.int64)
    space = SPACE[data]
    before, after = np.ones(len(data), dtype=bool), np.ones(len(data), dtype=bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    inside = ~space
    first, last = np.flatnonzero(inside & before), np.flatnonzero(inside & after)
    bounds = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(last - first + 1, out=bounds[1:])
    return binary_array(data[inside], bounds), np.searchsorted(first, offsets)


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, equal numbers for equal values, and the distinct values."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values; 0 for a row without any."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of each element."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
