"""Words, word hashes and blobs of Arrow text columns, as numpy arrays inside Spark tasks.

A text is bytes here: letters A-Z are folded to a-z, every other byte stands for itself, so any UTF-8 text is
read whole without decoding. Word hashes have 64 bits and depend on the word alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once, and texts; a longer text is handled alone.
CHUNK_BYTES, CHUNK_TEXTS = 1 << 20, 4096
#: Bytes whose sums are made at once.
_BLOCK = 1 << 17
#: Functions with a cache that keep something large in a worker, a tokenizer for one.
KEEPERS: list[Callable] = []
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
_VALUE = FOLD.astype(np.uint64) + np.uint64(1)
#: Words are runs of anything but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Words are runs of ASCII letters, digits and all bytes beyond ASCII.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True


class Words(NamedTuple):
    """Words of several texts in order: byte range, number of the text, hash."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    docs: int

    def bounds(self) -> np.ndarray:
        """Index of the first word of every text, and the number of words."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and the offsets of its texts."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < len(sizes):
            done = int(total[first - 1]) if first else 0
            last = min(first + CHUNK_TEXTS, max(first + 1, int(np.searchsorted(total, done + most, side="right"))))
            yield batch.slice(first, last - first)
            first = last


def release(keeps: Callable | None = None) -> None:
    """Gives back what allocators of this process hold, and what all ``KEEPERS`` but ``keeps`` do."""
    for keeper in KEEPERS:
        if keeper is not keeps:
            keeper.cache_clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def releasing(run: Callable, keeps: Callable | None = None) -> Callable:
    """``run``, an iterator over batches or a function of a table, that gives its memory back when it has ended.

    Spark keeps Python workers for later tasks, also of other stages; what their allocators hold back adds up otherwise. So does what a stage
    before kept for its own tasks: it goes first, but for the one of the ``KEEPERS`` that ``run`` works with.
    """

    @wraps(run)
    def batches(argument):
        release(keeps)
        try:
            yield from run(argument)
        finally:
            release(keeps)

    @wraps(run)
    def table(argument):
        try:
            return run(argument)
        finally:
            release(keeps)

    return table if "Table" in str(run.__annotations__.get("return")) else batches


_powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        size = max(size, CHUNK_BYTES)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 2 * CHUNK_BYTES:
            return made  # not kept after a long text
        _powers = made
    return _powers


def mix(value: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; a bijection."""
    value = value ^ (value >> np.uint64(32))
    value = value * _STEP
    value ^= value >> np.uint64(32)
    value *= _STEP
    return value ^ (value >> np.uint64(29))


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE) -> Words:
    """All words of the texts; ``kind`` says which bytes words are made of."""
    size, docs = len(data), len(offsets) - 1
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), docs)
    inside = kind[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:size]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:size]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _tables(size + 1)
    total = np.zeros(size + 1, np.uint64)
    for a in range(0, size, _BLOCK):
        b = min(a + _BLOCK, size)
        part = _VALUE[data[a:b]]
        part *= up[a:b]
        part[:1] += total[a : a + 1]
        np.cumsum(part, out=total[a + 1 : b + 1])
    hashed = mix((total[end] - total[start]) * down[start])
    return Words(start, end, np.searchsorted(offsets, start, side="right") - 1, hashed, docs)


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes (runs across texts included)."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    rows = len(words) - length + 1
    value = np.full(rows, length, np.uint64)
    for k in range(length):
        value = (value ^ words[k : k + rows]) * _STEP
        value ^= value >> np.uint64(31)
    return mix(value)


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def joined(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """All blobs of a binary column, one after the other."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), kind)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of every run of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return first, np.diff(np.append(first, len(values)))
