"""Shared vectorised kernels over the value buffers of Arrow string arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

QUOTE, APOSTROPHE, BACKSLASH, COMMA = 34, 39, 92, 44


class Texts:
    """The bytes of an Arrow string array as one numpy buffer.

    ``data``: uint8; ``start`` and ``end``: each row's span (nulls are empty); ``row``: each byte's row.
    """

    def __init__(self, array: pa.Array | pa.ChunkedArray):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        array = array.cast(pa.large_string())
        if array.null_count:
            array = array.fill_null("")
        offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1 + array.offset)[array.offset :]
        base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        values = array.buffers()[2]
        self.data = np.frombuffer(values, np.uint8, size, base) if size else np.zeros(0, np.uint8)
        self.start, self.end = offsets[:-1] - base, offsets[1:] - base
        self.n = len(array)
        self.row = np.repeat(np.arange(self.n), self.end - self.start)

    def since_start(self, mask: np.ndarray) -> np.ndarray:
        """How often ``mask`` held from the row's first byte up to and including each byte."""
        total = np.cumsum(mask, dtype=np.int64)
        before = np.concatenate(([0], total))[self.start]
        return total - before[self.row]

    def per_row(self, mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.end] - total[self.start]

    def at(self, positions: np.ndarray, default: int = 0) -> np.ndarray:
        """The byte at each position; ``default`` beyond the buffer."""
        if not len(self.data):
            return np.full(len(positions), default, np.uint8)
        inside = (positions >= 0) & (positions < len(self.data))
        return np.where(inside, self.data[np.clip(positions, 0, len(self.data) - 1)], default).astype(np.uint8)


def strings_from(data: np.ndarray, keep: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """A string array of the kept bytes of each span; the spans ascend and don't overlap."""
    counts = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
    size = len(data) + 1
    edges = np.bincount(start, minlength=size) - np.bincount(end, minlength=size)
    within = keep & (np.cumsum(edges)[:-1] > 0)
    lengths = counts[end] - counts[start]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[within].tobytes())).cast(pa.string())


def spans(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    """A string array of the bytes from each ``first`` up to before each ``end``; the spans may overlap and come in any order."""
    lengths = end - first
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    at = np.repeat(first - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[at].tobytes())).cast(pa.string())


def next_where(mask: np.ndarray) -> np.ndarray:
    """For each position the first position at or after it where ``mask`` holds, else the length; one entry more."""
    n = len(mask)
    at = np.where(mask, np.arange(n), n)
    return np.concatenate((np.minimum.accumulate(at[::-1])[::-1], [n])) if n else np.zeros(1, np.int64)


def last_where(mask: np.ndarray) -> np.ndarray:
    """For each position the last position before it where ``mask`` holds, else -1; one entry more."""
    return np.concatenate(([-1], np.maximum.accumulate(np.where(mask, np.arange(len(mask)), -1)))) if len(mask) else np.full(1, -1, np.int64)


def pieces(batch: pa.RecordBatch, columns: list[int], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold at most so many bytes together (more only for a single longer row), since the
    index arrays take many bytes for each byte of text."""
    if not batch.num_rows:
        return
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(at, stop - at)
        at = stop
