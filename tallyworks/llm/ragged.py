"""Arrays of arrays as flat numpy arrays, and cutting batches of text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 4 << 20


def give_back() -> None:
    """Returns to the system what the allocators of a worker hold from earlier stages; workers are reused."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function over batches whose worker gives its memory back when a task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def offsets(lengths: np.ndarray) -> np.ndarray:
    found = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=found[1:])
    return found


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def take(flat: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that the index names, flat, and their lengths."""
    lengths = bounds[1:][index] - bounds[:-1][index]
    return flat[places(bounds[:-1][index], lengths)], lengths


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow array of the byte runs between bounds."""
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(flat))],
    )


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts (or lists) of one have about the given number of bytes (or items), or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(name)
        bounds = list_bounds(column) if pa.types.is_list(column.type) else text_bytes(column)[1]
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + limit, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def list_bounds(column: pa.Array) -> np.ndarray:
    """Bounds of the rows of a list column in its flattened values; a null row is empty."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return offsets(lengths.astype(np.int64))
