"""Arrow batches of texts as byte arrays: words, hashes of words, and shingles, without a loop over words.

Everything here works on one slice of rows at a time, so the memory in use depends on ``SLICE_BYTES``
and on the longest single text, never on the number of rows.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and where each row starts; NULL is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def give_back() -> None:
    """Return memory that this Python worker no longer uses: it lives on after its task, beside the workers of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows of about ``limit`` bytes of text (at least one row each)."""
    for batch in batches:
        data, offsets = texts(batch.column(name))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end
    batch = data = offsets = None
    give_back()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random word for each byte; capital A-Z share those of a-z, which lower-cases without a copy.
BYTE_WORDS = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
BYTE_WORDS[65:91] = BYTE_WORDS[97:123]

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < count:
        size = max(count, SLICE_BYTES + 1)
        _powers[:] = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def word_bounds(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word: maximal runs of bytes that are no breaks, within a row."""
    inside = ~breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's lower-cased bytes: a polynomial whose terms depend on the place within the word only."""
    forward, back = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_WORDS[data] * forward[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``width`` words inside a row."""
    count = max(0, len(words) - width + 1)
    inside = rows[:count] == rows[width - 1 : width - 1 + count]
    total = np.full(count, width, np.uint64)
    for place in range(width):
        total = mix(total) + words[place : place + count] * np.uint64(2 * place + 3)
    return mix(total[inside]), rows[:count][inside]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending within a row, and where each row starts.

    A row with fewer than ``width`` words has its whole word sequence as the one shingle; a row
    without words has none.
    """
    starts, ends, rows = word_bounds(data, offsets)
    hashes, owners = window_hashes(words := word_hashes(data, starts, ends), rows, width)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    if ((counts > 0) & (counts < width)).any():
        parts = [(hashes, owners)]
        for few in range(1, width):
            keep = counts == few
            if keep.any():
                picked = np.repeat(keep, counts)
                parts.append(window_hashes(words[picked], rows[picked], few))
        hashes, owners = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
    edges = np.searchsorted(owners, np.arange(len(offsets)))
    for a, b in zip(edges[:-1], edges[1:]):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[keep], np.searchsorted(owners[keep], np.arange(len(offsets)))
