"""Texts cut at places where every byte-level tokenizer of the usual pattern cuts, so that each distinct piece is tokenized once.

The pattern lets a word take one space before it. So a space with a visible character behind it
always begins a new match, and a text may be cut there without changing its tokens. Texts with a
space before other white space, or at their end, stay whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space that is followed by anything that any library may count as white space, or by the end.
_UNSAFE = r" ($|[\s\x0b\x1c-\x1f\x{85}\x{180e}\x{200b}\x{2060}\x{feff}\p{Z}])"


class Memory:
    """Results by piece, bounded: when the young half is full, it becomes the old half, and the old one goes.

    A half has at most ``size`` entries and those of one slice more.
    """

    def __init__(self, size: int = 600_000, longest: int = 64):
        self.young: dict = {}
        self.old: dict = {}
        self.size, self.longest = size, longest

    def fill(self, keys: list, compute: Callable[[list], list]) -> list:
        """The value of each of ``keys``, which are distinct; ``compute`` gives those that are not here."""
        found = list(map(self.young.get, keys))
        absent = [k for k, value in enumerate(found) if value is None]
        if absent:
            names = [keys[k] for k in absent]
            values = list(map(self.old.get, names))
            missing = [k for k, value in enumerate(values) if value is None]
            for k, value in zip(missing, compute([names[k] for k in missing]) if missing else ()):
                values[k] = value
            for k, value in zip(absent, values):
                found[k] = value
            self.young.update(zip(names, values))
            for name in [name for name in names if len(name) > self.longest]:
                del self.young[name]
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
        return found


def gather(values: list[bytes], codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``codes`` one after the other as an array of items of ``width`` bytes, and the items of each code."""
    kind = {1: np.uint8, 4: np.uint32}[width]
    taken = pa.array(values, pa.large_binary()).take(pa.array(codes))
    if not len(taken) or taken.buffers()[2] is None:
        return np.zeros(0, kind), np.zeros(len(taken), np.int64)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] // width
    return np.frombuffer(taken.buffers()[2], kind, int(ends[-1]))[ends[0] :], np.diff(ends)


def encode_slice(column: pa.Array, memory: Memory, compute: Callable[[list[str]], list[bytes]], added: Sequence[str] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice in order, and where each text starts; NULL is empty.

    ``compute`` turns distinct strings into their ids as little-endian 32-bit words. Texts that hold a
    string of ``added`` stay whole.
    """
    column = column.fill_null("")
    whole = pc.match_substring_regex(column, _UNSAFE).to_numpy(zero_copy_only=False)
    for literal in added:
        whole = whole | pc.match_substring(column, literal).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(pc.if_else(pa.array(whole), "", column), " ")
    parts = lists.flatten().dictionary_encode()
    codes = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.asarray(lists.offsets, np.int64)
    edges = edges - edges[0]
    spaced = pc.binary_join_element_wise("", parts.dictionary, " ")
    keys = spaced.to_numpy(zero_copy_only=False).tolist()
    first, place = np.unique(codes[edges[:-1]], return_inverse=True)
    codes[edges[:-1]] = len(keys) + place
    keys += parts.dictionary.take(pa.array(first)).to_pylist()
    texts = np.flatnonzero(whole)
    codes[edges[:-1][texts]] = len(keys) + np.arange(len(texts))
    keys += [column[int(k)].as_py() for k in texts]
    ids, counts = gather(memory.fill(keys, compute), codes, 4)
    ends = np.concatenate(([0], np.cumsum(counts)))
    return ids, ends[edges]


def id_lists(ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Ids and their edges as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32)))


def small(batches: Iterator[pa.RecordBatch], name: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in the named column, at least one row each."""
    for batch in batches:
        column = batch.column(name)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        row = 0
        while row < batch.num_rows:
            base = ends[row - 1] if row else 0
            end = min(batch.num_rows, max(row + 1, int(np.searchsorted(ends, base + limit, "right"))))
            yield batch.slice(row, end - row)
            row = end
