"""Sorted runs of suffixes, front-coded blocks of them, and a loser tree that merges runs by their common prefixes.

A suffix here begins at an anchor and ends where the last window with this anchor ends, so it has
at most ``WINDOW`` bytes. With it go the bytes before the anchor back to the start of the first window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from patronage.llm.text import BYTE_WORDS, mix, powers

GRAM = 20


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Row, place, first and last window start, and hash of each anchor.

    The anchor of a window of ``window`` bytes is the place in it whose ``GRAM`` bytes have the
    smallest hash, the leftmost of equals. It depends on the window's bytes alone, so equal windows
    have the same anchor; and windows with the same anchor follow each other.
    """
    reach = window - GRAM + 1
    sizes = np.diff(offsets)
    if len(data) < window or not (sizes >= window).any():
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    forward, back = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    # not BYTE_WORDS itself: it makes no difference between capital and small letters
    np.cumsum((BYTE_WORDS[data] + data.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) * forward[: len(data)], out=sums[1:])
    hashes = mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) - GRAM + 1])
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        rest = reach - width
        least = np.minimum(least[:-rest], least[rest:])
    starts = np.arange(len(least))
    rows = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    inside = starts + window <= offsets[1:][rows]
    starts, rows = starts[inside], rows[inside]
    place = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (rows[1:] != rows[:-1]))))
    last = np.append(first[1:], len(place)) - 1
    return rows[first], place[first], starts[first], starts[last], hashes[place[first]]


def bytes_at(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """A matrix of bytes: row k is data from starts[k] on, sizes[k] of them, then zeros."""
    if not len(starts):
        return np.zeros((0, width), np.uint8)
    place = starts[:, None] + np.arange(width)
    out = data[np.minimum(place, len(data) - 1)]
    out[np.arange(width) >= sizes[:, None]] = 0
    return out


class Records:
    """Suffixes with what belongs to them, as arrays."""

    def __init__(self, right, right_size, left, left_size, doc, row, place):
        self.fields = (right, right_size, left, left_size, doc, row, place)
        self.right, self.right_size, self.left, self.left_size, self.doc, self.row, self.place = self.fields

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, index) -> Records:
        return Records(*(f[index] for f in self.fields))

    @staticmethod
    def joined(parts: list[Records]) -> Records:
        return Records(*(np.concatenate(f) for f in zip(*(p.fields for p in parts))))


def extract(data: np.ndarray, place, first, last, doc, row, start_of_row, window: int) -> Records:
    """Records of anchors; places are counted from the start of their text. Bytes before an anchor are stored nearest first."""
    right_size, left_size = (last + window - place).astype(np.uint8), (place - first).astype(np.uint8)
    right = bytes_at(data, place, right_size.astype(np.int64), window)
    width = window - GRAM
    back = place[:, None] - 1 - np.arange(width)
    left = data[np.maximum(back, 0)]
    left[np.arange(width) >= left_size[:, None]] = 0
    return Records(right, right_size, left, left_size, doc, row, place - start_of_row)


def sorted_run(records: Records) -> tuple[Records, np.ndarray]:
    """The records in order of their suffixes, and which have the same bytes on both sides as the one before."""
    n = len(records)
    key = np.concatenate((records.right, records.right_size[:, None], records.left, records.left_size[:, None], np.ones((n, 1), np.uint8)), axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1]}").ravel(), kind="stable")
    key = key[order]
    same = np.zeros(n, bool)
    same[1:] = (key[1:] == key[:-1]).all(axis=1)
    return records.take(order), same


def common_prefixes(records: Records) -> np.ndarray:
    """Bytes that each suffix has in common with the one before."""
    n, width = records.right.shape
    out = np.zeros(n, np.uint8)
    if n > 1:
        differ = records.right[1:] != records.right[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[1:] = np.minimum(first, np.minimum(records.right_size[1:], records.right_size[:-1]))
    return out


def front_code(records: Records) -> bytes:
    """A block of a sorted run: of each suffix only what differs from the one before."""
    lcp = common_prefixes(records)
    docs, at = np.unique(np.stack((records.doc, records.row), axis=1), axis=0, return_inverse=True)
    columns = np.arange(records.right.shape[1])
    tails = records.right[(columns >= lcp[:, None]) & (columns < records.right_size[:, None])]
    columns = np.arange(records.left.shape[1])
    lefts = records.left[columns < records.left_size[:, None]]
    head = np.array([len(records), len(docs), records.right.shape[1], records.left.shape[1]], "<i8")
    return b"".join(x.tobytes() for x in (head, docs.astype("<i8"), at.ravel().astype("<u4"), records.place.astype("<i8"), lcp, records.right_size, records.left_size, tails, lefts))


class Run:
    """A block that is read from its start on: the suffix at the head for the loser tree, the rest in slices."""

    def __init__(self, block: bytes):
        self.count, docs, _, self.left_width = (int(x) for x in np.frombuffer(block, "<i8", 4))
        at = 32

        def read(kind, n):
            nonlocal at
            found = np.frombuffer(block, kind, n, at)
            at += found.nbytes
            return found

        self.table = read("<i8", 2 * docs).reshape(-1, 2)
        self.index, self.place = read("<u4", self.count), read("<i8", self.count)
        self.lcp, self.right_size, self.left_size = (read(np.uint8, self.count) for _ in range(3))
        self.tails = memoryview(block)[at : at + int((self.right_size.astype(np.int64) - self.lcp).sum())]
        at += len(self.tails)
        self.lefts = read(np.uint8, int(self.left_size.sum(dtype=np.int64)))
        self.at, self.begin, self.taken, self.left_begin = 0, 0, 0, 0

    def head(self, before: bytes) -> tuple[bytes, int]:
        """The next suffix and what it has in common with ``before``, the one before it; common is -1 at the end."""
        if self.at == self.count:
            return b"", -1
        common = int(self.lcp[self.at])
        size = int(self.right_size[self.at]) - common
        suffix = before[:common] + bytes(self.tails[self.begin : self.begin + size])
        self.begin += size
        self.at += 1
        return suffix, common

    def take(self, count: int) -> tuple[np.ndarray, ...]:
        """What belongs to the next ``count`` suffixes: sizes, bytes before, doc, row, place."""
        part = slice(self.taken, self.taken + count)
        self.taken += count
        sizes = self.left_size[part].astype(np.int64)
        left = np.zeros((count, self.left_width), np.uint8)
        end = self.left_begin + int(sizes.sum())
        left[np.arange(self.left_width) < sizes[:, None]] = self.lefts[self.left_begin : end]
        self.left_begin = end
        owner = self.table[self.index[part]]
        return self.right_size[part], left, self.left_size[part], owner[:, 0], owner[:, 1], self.place[part]


def merge(sources: list[Callable[[bytes], tuple[bytes, int]]]) -> Iterator[tuple[int, int]]:
    """Run and common prefix with the one before, of each suffix of all runs in order.

    A source gives its next suffix and what that has in common with the one before, which it is handed.
    A loser tree over the heads of the runs. With each head goes the number of bytes that it has in
    common with the suffix given out last. Of two heads, the one with more in common comes first;
    only if both have the same number in common are bytes compared, from there on.
    """
    size = 1
    while size < len(sources):
        size *= 2
    heads, common = [b""] * size, [-1] * size
    for leaf, source in enumerate(sources):
        heads[leaf], common[leaf] = source(b"")

    def less(a: int, b: int) -> tuple[bool, int]:
        """Whether head a comes first, and what both have in common; both share common[a] bytes."""
        x, y, k = heads[a], heads[b], common[a]
        if x == y:
            return a < b, len(x)
        short = min(len(x), len(y))
        if x[k:short] == y[k:short]:
            return len(x) < len(y), short
        differ = int.from_bytes(x[k:short], "big") ^ int.from_bytes(y[k:short], "big")
        k = short - (differ.bit_length() + 7) // 8
        return x[k] < y[k], k

    loser = [0] * size
    winner = [0] * (2 * size)
    for leaf in range(size):
        winner[size + leaf] = leaf
    for node in range(size - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        if common[a] < common[b] or (common[a] == common[b] >= 0 and not (pair := less(a, b))[0]):
            a, b = b, a
        if common[a] == common[b] >= 0:
            common[b] = pair[1]
        winner[node], loser[node] = a, b
    top = winner[1]
    # the heads that lost on the way up hold what they share with the head that beat them
    while common[top] >= 0:
        yield top, common[top]
        heads[top], common[top] = sources[top](heads[top])
        node = (top + size) >> 1
        now = top
        while node:
            other = loser[node]
            mine, its = common[now], common[other]
            if mine < its:
                loser[node], now = now, other
            elif mine == its and mine >= 0:
                first, shared = less(now, other)
                if first:
                    common[other] = shared
                else:
                    common[now] = shared
                    loser[node], now = now, other
            node >>= 1
        top = now


def merged(blocks: list[bytes], part: int = 100_000) -> Iterator[tuple[np.ndarray, ...]]:
    """Common prefix, doc, row, place, window offsets and bytes before each suffix, of all blocks in order of the suffixes.

    In parts of about ``part`` suffixes, cut where neighbours have fewer than ``GRAM`` bytes in common.
    """
    runs = [Run(b) for b in blocks]
    which, common = [], []

    def gather() -> tuple[np.ndarray, ...]:
        order = np.array(which, np.int64)
        fields = None
        for k in np.unique(order):
            mask = order == k
            chosen = runs[k].take(int(mask.sum()))
            if fields is None:
                fields = [np.zeros((len(order), *c.shape[1:]), c.dtype) for c in chosen]
            for field, values in zip(fields, chosen):
                field[mask] = values
        return (np.array(common, np.int64), *fields)

    for run, lcp in merge([r.head for r in runs]):
        if len(which) >= part and lcp < GRAM:
            yield gather()
            which, common = [], []
        which.append(run)
        common.append(lcp)
    if which:
        yield gather()
