"""Text columns cut into words inside a task, on whole Arrow columns instead of row by row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once inside a task; a longer text is handled alone.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs whose `column` holds at most `limit` bytes, or that have one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text begins and the last one ends."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)
    )


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+` in order, and where each text's words begin and the last end.

    A null text has no words.
    """
    data, starts = raw(texts)
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(starts), np.int64)
    if lower:
        data = lowered(data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = starts[:-1][starts[:-1] < starts[1:]]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    passed = np.cumsum(inside, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    offsets = np.append(passed[at] - 1, passed[-1])
    return strings(data[inside], offsets), np.searchsorted(at, starts)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place in the list of distinct words, and that list."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def rows_of(starts: np.ndarray) -> np.ndarray:
    """For each element of ragged rows, the number of its row."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def gather(values: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged rows of (values, starts) named in `rows`, one after the other, and where they begin."""
    lengths = (starts[1:] - starts[:-1])[rows]
    begins = np.concatenate([[0], np.cumsum(lengths)])
    places = np.arange(begins[-1]) + np.repeat(starts[:-1][rows] - begins[:-1], lengths)
    return values[places], begins


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every bit of the result depends on every bit of x."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
