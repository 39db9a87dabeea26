"""Repeating stretches of words, found with a run-length grammar made by recompression.

Block and pair compression alternate: neighbours that are equal become one symbol (word, count), then the
symbols fall by a hash into left and right ones and each left-right pair becomes one symbol. Whether two
neighbours are joined depends on these two symbols alone, so equal stretches are compressed alike, but for
their edges. The longest common extension of two places climbs the levels as long as the symbols agree
and comes down where they first differ: a few array look-ups a level, for all questions at once.

A run with period q and four periods or more covers, of the grid 0, 3q, 6q, ..., a place i with i + q inside
the run too. All places of all grids where the words at i and i + q agree are extended to both sides;
what is long enough is a run, exactly. Places in a run that is known are not asked again for multiples
of its period: the answer would be that run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.text import mix, slices

LEAST = 6
TIMES = 4
#: Symbols that the longest document may have on the top level.
TOP = 4

RUN = "struct<start: long, length: long, period: long>"


class Level:
    """Symbols of one level. ``up`` is each symbol's parent, ``first`` each parent's first child (and the end)."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.blocks = False
        self.up = self.first = np.zeros(0, np.int64)


class Grammar:
    """Levels over a sequence of symbols; ``marks`` stand before, between and behind documents, each is unique and never joined."""

    def __init__(self, symbols: np.ndarray, marks: np.ndarray):
        self.levels = [Level(symbols.astype(np.int64))]
        ids = int(symbols.max()) + 1
        is_mark = np.zeros(ids, bool)
        is_mark[symbols[marks]] = True
        step = 0
        while np.diff(np.flatnonzero(self._marks(is_mark))).max(initial=0) > TOP + 1:
            ids = self._join_equal(ids)
            ids = self._join_pairs(ids, is_mark, step)
            step += 1

    def _marks(self, is_mark: np.ndarray) -> np.ndarray:
        symbols = self.levels[-1].symbols
        return (symbols < len(is_mark)) & is_mark[np.minimum(symbols, len(is_mark) - 1)]

    def _push(self, starts: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        level = self.levels[-1]
        level.blocks = blocks
        level.up = np.cumsum(starts) - 1
        level.first = np.append(np.flatnonzero(starts), len(starts))
        self.levels.append(Level(symbols))

    def _join_equal(self, ids: int) -> int:
        symbols = self.levels[-1].symbols
        starts = np.append(True, symbols[1:] != symbols[:-1])
        first = np.flatnonzero(starts)
        counts = np.diff(np.append(first, len(symbols)))
        many = np.flatnonzero(counts > 1)
        if not len(many):
            return ids
        joined = symbols[first]
        names, place = np.unique(joined[many] * (len(symbols) + 1) + counts[many], return_inverse=True)
        joined[many] = ids + place
        self._push(starts, joined, True)
        return ids + len(names)

    def _join_pairs(self, ids: int, is_mark: np.ndarray, step: int) -> int:
        symbols = self.levels[-1].symbols
        right = mix(symbols.astype(np.uint64) + np.uint64((step + 1) << 40)) & np.uint64(1) != 0
        free = ~self._marks(is_mark)
        ahead = free[:-1] & free[1:]
        forward, backward = ahead & ~right[:-1] & right[1:], ahead & right[:-1] & ~right[1:]
        pairs = np.flatnonzero(forward if forward.sum() >= backward.sum() else backward)
        starts = np.ones(len(symbols), bool)
        starts[pairs + 1] = False
        names, place = np.unique(symbols[pairs] * ids + symbols[pairs + 1], return_inverse=True)
        joined = symbols.copy()
        joined[pairs] = ids + place
        self._push(starts, joined[starts], False)
        return ids + len(names)

    def common(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from each place of ``x`` and ``y`` on (x <> y), to the right, or ``back`` to the left."""
        way = -1 if back else 1
        out = np.zeros(len(x), np.int64)
        who = np.arange(len(x))
        begun = x
        parted: list = []
        for depth, level in enumerate(self.levels):
            same = level.symbols[x] == level.symbols[y]
            parted.append([(who[~same], x[~same], y[~same])])
            who, x, y = who[same], x[same], y[same]
            if depth == len(self.levels) - 1:
                while len(who):
                    x, y = x + way, y + way
                    same = level.symbols[x] == level.symbols[y]
                    parted[-1].append((who[~same], x[~same], y[~same]))
                    who, x, y = who[same], x[same], y[same]
                break
            left_x, left_y = self._left(level, x, back), self._left(level, y, back)
            inner = (left_x[1] | left_y[1]) != 0
            step = np.where(inner, np.minimum(left_x[0], left_y[0]), 0) * way
            x, y = x + step, y + step
            apart = inner & (left_x[0] != left_y[0]) & level.blocks
            parted[-1].append((who[apart], x[apart], y[apart]))
            who, x, y = who[~apart], level.up[x[~apart]], level.up[y[~apart]]
        who = x = y = np.zeros(0, np.int64)
        for depth in range(len(parted) - 1, -1, -1):
            who, x, y = (np.concatenate(group) for group in zip((who, x, y), *parted[depth]))
            if depth:
                below = self.levels[depth - 1]
                sizes = np.minimum(below.first[x + 1] - below.first[x], below.first[y + 1] - below.first[y]) if below.blocks else 1
                x, y = (below.first[x + 1] - 1, below.first[y + 1] - 1) if back else (below.first[x], below.first[y])
                step = np.where(below.symbols[x] == below.symbols[y], sizes, 0) * way
                x, y = x + step, y + step
        out[who] = (x - begun[who]) * way
        return out

    @staticmethod
    def _left(level: Level, x: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """Children from ``x`` to the end of its parent in the direction of reading, and whether some lie before it.

        In a pair, the child at hand is the only one left if one lies before it, and the step is one.
        """
        parent = level.up[x]
        before, behind = x - level.first[parent], level.first[parent + 1] - x
        inside = behind - 1 if back else before
        if not level.blocks:
            return np.ones(len(x), np.int64), inside
        return (before + 1 if back else behind), inside


def _grid(base: np.ndarray, sizes: np.ndarray, period: int) -> np.ndarray:
    """The places 0, 3 * period, ... of each document (at ``base``, longest first) that have another place a period on."""
    counts = (sizes - period + 3 * period - 1) // (3 * period)
    ends = np.cumsum(counts)
    inner = np.arange(int(ends[-1])) - np.repeat(ends - counts, counts)
    return np.repeat(base, counts) + inner * (3 * period)


def _covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places inside the given stretches, and the stretch of each."""
    counts = ends - starts
    owner = np.repeat(np.arange(len(starts)), counts)
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner], owner


def runs_of(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of each run, by document, start and period.

    ``words`` are the numbered words of all documents, ``edges`` where each document begins, and the end.
    """
    none = np.zeros(0, np.int64)
    sizes = np.diff(edges)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= LEAST]
    if not len(order):
        return none, none, none, none
    # one mark before each document and one at the end
    places = np.arange(len(words)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    symbols = np.zeros(len(words) + len(sizes) + 1, np.int64)
    symbols[places] = words
    marks = np.append(edges[:-1] + np.arange(len(sizes)), len(symbols) - 1)
    symbols[marks] = int(words.max()) + 1 + np.arange(len(marks))
    base, long = marks[order] + 1, sizes[order]
    grammar: Grammar | None = None
    found: list[np.ndarray] = []
    known: list[tuple[np.ndarray, np.ndarray]] = []
    period = 1
    while long[0] >= max(LEAST, TIMES * period):
        at, by = [], []
        upper = 2 * period
        while period < upper and long[0] >= max(LEAST, TIMES * period):
            enough = int(np.searchsorted(-long, -max(LEAST, TIMES * period), "right"))
            x = _grid(base[:enough], long[:enough], period)
            x = x[symbols[x] == symbols[x + period]]
            at.append(x)
            by.append(np.full(len(x), period))
            period += 1
        x, q = np.concatenate(at), np.concatenate(by)
        for own, end in known:
            inside = own[x] > 0
            inside[inside] = (q[inside] % own[x[inside]] == 0) & (x[inside] + q[inside] < end[x[inside]])
            x, q = x[~inside], q[~inside]
        if not len(x):
            continue
        grammar = grammar or Grammar(symbols, marks)
        start = x - grammar.common(x - 1, x + q - 1, back=True)
        end = x + q + grammar.common(x, x + q)
        kept = end - start >= np.maximum(LEAST, TIMES * q)
        if kept.any():
            rows = np.unique(np.stack((start[kept], end[kept], q[kept]), 1), axis=0)
            found.append(rows)
            inside, owner = _covered(rows[:, 0], rows[:, 1])
            own, stop = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
            own[inside], stop[inside] = rows[owner, 2], rows[owner, 1]
            known.append((own, stop))
    if not found:
        return none, none, none, none
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))  # a stretch's smallest period comes first
    rows = rows[first]
    docs = np.searchsorted(marks, rows[:, 0], "right") - 1
    order = np.lexsort((rows[:, 2], rows[:, 0]))
    rows, docs = rows[order], docs[order]
    return docs, rows[:, 0] - marks[docs] - 1, rows[:, 1] - rows[:, 0], rows[:, 2]


def _of_slice(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text."""
    words = [text.split() for text in texts]
    edges = np.concatenate(([0], np.cumsum(list(map(len, words))))).astype(np.int64)
    flat = pa.array([word for some in words for word in some], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    docs, starts, lengths, periods = runs_of(codes, edges) if len(codes) else (np.zeros(0, np.int64),) * 4
    places, owner = _covered(edges[docs] + starts + periods, edges[docs] + starts + lengths)
    keep = np.ones(len(codes), bool)
    keep[places] = False
    touched = np.zeros(len(texts), bool)
    touched[docs] = True
    collapsed = []
    for own, cut, a, b in zip(words, touched, edges[:-1], edges[1:]):
        collapsed.append(b" ".join([word for word, stays in zip(own, keep[a:b]) if stays] if cut else own))
    items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)], ["start", "length", "period"])
    bounds = np.searchsorted(docs, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), items), pa.array(collapsed, pa.binary()).cast(pa.string())


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs``, all runs of the text's words by start and period, and ``collapsed``.

    A run is a stretch of words (numbered from 0, cut at white space of ASCII) with smallest period q and
    max(6, 4 q) words or more that no neighbour extends. ``collapsed`` are the words that lie in no run, or
    only in the first period of those they lie in, joined by one space. NULL and empty texts have no run and an
    empty ``collapsed``. All rows stay, repeated rows and rows without an id too; columns named runs or
    collapsed are replaced. Texts are worked on in slices of about 2 MB; a longer one is its own slice.
    """
    docs = docs.drop("runs", "collapsed")
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema), f"runs array<{RUN}>", "collapsed string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            raw = data.tobytes()
            columns = _of_slice([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "runs", "collapsed"])

    return docs.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. NULL without a run."""
    better = lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def as_lines(runs: Column) -> Column:
    """Each run as ``start,length,period`` and a line feed."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.concat_ws("", F.transform(runs, line))


def with_planted(docs: DataFrame) -> DataFrame:
    """``docs`` with a period planted in the texts of which crc32 of the id is a multiple of ten.

    With g = floor(crc32 / 10), n words, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), each word i >= a
    becomes the word a + (i - a) % p. Such a text is its words, joined by one space. A row without an id stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda word: word != "")
    split = docs.withColumn("_words", F.when(h % 10 == 0, words)).withColumn("_g", F.floor(h / 10)).withColumn("_n", F.size("_words").cast("long"))
    a = F.col("_g") % F.col("_n")
    p = F.lit(1) + F.floor((F.col("_n") - a) / (F.lit(3) + F.col("_g") % 8))
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    planted = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), lambda i: F.get("_words", at(i).cast("int")))
    ready = split.withColumn("_a", F.when(F.col("_n") > 0, a)).withColumn("_p", F.when(F.col("_n") > 0, p))
    text = F.when(F.col("_n") > 0, F.array_join(F.when(F.col("_n") > 0, planted), " ")).otherwise(F.col("text"))
    return ready.withColumn("text", text).drop("_words", "_g", "_n", "_a", "_p")
