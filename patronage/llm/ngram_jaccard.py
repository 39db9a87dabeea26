"""Jaccard join of shingle sets with token-combination prefixes.

Tokens are shingles. All tokens have one global order: rare ones first, then frequent ones, each by
hash. Of the ``n`` tokens of a set, at most ``e = n - ceil(0.8 n)`` can be missing from a set it
links with. So of two linked sets, the one whose prefix ends first finds all but ``e`` tokens of its
prefix in the prefix of the other.

* Rare tokens are indexed one by one. A prefix of ``e + s`` of them shares at least ``s``.
* If a set has too few rare tokens, its prefix is extended by frequent ones. Frequent tokens fall
  into classes, and pairs of tokens of one class are indexed. ``p`` tokens of a class lose their last
  common pair only if ``p - 1`` of them are missing, so the prefix grows until ``rare + sum(p - 1)``
  is above ``e``. How many classes there are depends on a band of set sizes, so that pairs stay few;
  linked sets are in the same or in adjoining bands, and each set is indexed for its own and the next.

Frequent is what falls into a heavy cell of a table of counts whose size is fixed. Which tokens are
frequent decides only how much work there is, never which links are found.

Equal sets are one node. Sets that share an index entry are first linked to one of them only
(the entry's pivot). Entries that lie within one component are done; in the others, nodes are compared
with pivots of other components, drawn anew each round for each of ``PIVOTS`` classes of entries, as long as that finds links. Each round compares at
most ``PIVOTS`` pairs for each node. Only what then remains between components is paired, and what a
task meets in several entries is added up before it is given out. Of these pairs, sizes and bit sketches rule out most before they are given out: a
sketch flips one bit for each token, so two sketches differ in no more bits than the sets differ in
tokens. Every pair that is left is compared by the whole sets. These are worked out again for the nodes of
the pairs at hand, from one document each; the sets of all nodes are never written or exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.shared import components, forget, in_bitmap, stored
from patronage.llm.text import mix, shingle_sets, slices, texts

CELL_BITS = 22
SLOT_BITS = 16
LEAST_FREQUENT = 64
SKETCH = 8
PAIRS = 200_000
#: Pairs a task holds to add up, and over how many groups the entries with one lowest component are dealt.
HELD = 1_000_000
SALT = 4
ROUNDS = 6
PIVOTS = 3
MIXED = (1 << 31) - 1
_LONG = np.iinfo(np.int64).max


def _allowed(n, percent: int):
    """How many of n tokens may be missing from a linked set."""
    return n - -(-n * percent // 100)


def _edges_of(offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b > a:
            yield row, a, b


def fingerprints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number for each set; 0 for the empty set."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    total = sums[offsets[1:]] - sums[offsets[:-1]]
    sizes = np.diff(offsets).astype(np.uint64)
    return np.where(sizes > 0, mix(total + sizes * np.uint64(0x9E3779B97F4A7C15)), np.uint64(0)).view(np.int64)


_BITS = [f"bits{k}" for k in range(SKETCH)]


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each set ``64 * SKETCH`` bits, of which each token flips one; one row of 64-bit words per set."""
    bits = 64 * SKETCH
    place = (mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    odd = np.zeros((len(offsets) - 1, bits), np.uint8)
    for row, a, b in _edges_of(offsets):
        odd[row] = np.bincount(place[a:b], minlength=bits) & 1
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def _nodes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in slices(batches):
        hashes, at = shingle_sets(data, offsets, width)
        sketch = sketches(hashes, at)
        columns = [batch.column("doc_id"), pa.array(fingerprints(hashes, at)), pa.array(np.diff(at)), *(pa.array(sketch[:, k]) for k in range(SKETCH))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "n", *_BITS])


def _new_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Tokens, and (fingerprint, start, end) of each set that this task has not had before."""
    seen: set[int] = set()
    for _, data, offsets in slices(batches):
        hashes, at = shingle_sets(data, offsets, width)
        names, fresh = fingerprints(hashes, at).tolist(), []
        for row, a, b in _edges_of(at):
            if names[row] not in seen:
                seen.add(names[row])
                fresh.append((names[row], a, b))
        yield hashes, fresh


def _cell_hash(hashes: np.ndarray) -> np.ndarray:
    """Prefixes hold low hashes, so the cell comes from a second scrambling."""
    return mix(hashes ^ np.uint64(0xD6E8FEB86659FD93))


def _prefix_size(n: int, percent: int) -> int:
    return min(n, _allowed(n, percent) + 1 + n // 20)


def _cells(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for hashes, fresh in _new_sets(batches, width):
        kept = [hashes[a : a + _prefix_size(b - a, percent)] for _, a, b in fresh]
        if kept:
            cells = (_cell_hash(np.concatenate(kept)) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            counts += np.bincount(cells, minlength=len(counts))
    if counts.any():
        slots = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, 1 << SLOT_BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slots), dtype=np.int32)), pa.array([s.tobytes() for s in slots], pa.binary())], ["slot", "counts"])


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, counts in zip(batch.column("slot").to_pylist(), batch.column("counts").to_pylist()):
            width = np.uint16 if len(counts) == 2 << SLOT_BITS else np.uint32
            sums[slot] = sums.get(slot, 0) + np.frombuffer(counts, width).astype(np.int64)
    for slot, counts in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([np.minimum(counts, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], ["slot", "counts"])


def frequent_cells(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """Packed bits of the cells that hold far more tokens than the mean cell. Table and bits have a fixed size."""
    parts = docs.mapInArrow(lambda it: _cells(it, width, percent), "slot int, counts binary")
    sums = parts.repartition("slot").mapInArrow(_add_cells, "slot int, counts binary").collect()
    counts = np.zeros((1 << (CELL_BITS - SLOT_BITS), 1 << SLOT_BITS), np.int64)
    for row in sums:
        counts[row["slot"]] = np.frombuffer(row["counts"], np.uint32)
    heavy = counts.ravel() > max(LEAST_FREQUENT, 4 * counts.mean())
    return np.packbits(heavy, bitorder="little").view(np.uint64)


def bands(largest: int, percent: int) -> np.ndarray:
    """First set size of each band, such that two linked sets are in the same or in adjoining bands."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, np.int64)


def _combinations(frequent: np.ndarray, rare: int, missing: int, band: int, first_size: int) -> np.ndarray:
    """Index entries for pairs of frequent tokens of one class, for one band."""
    classes = max(1, first_size // 10)
    kind = ((mix(frequent) >> np.uint64(20)) % np.uint64(classes)).astype(np.int64)
    _, again = np.unique(kind, return_index=True)
    gain = np.ones(len(frequent), np.int64)
    gain[again] = 0  # the first token of a class has no partner yet
    enough = np.flatnonzero(np.cumsum(gain) + rare > missing)
    size = int(enough[0]) + 1 if len(enough) else len(frequent)
    order = np.argsort(kind[:size], kind="stable")
    tokens, kind = frequent[:size][order], kind[:size][order]
    found, step = [], 1
    while step < size:
        same = kind[step:] == kind[:-step]
        if not same.any():
            break
        found.append(mix(mix(tokens[:-step][same]) + mix(tokens[step:][same] + np.uint64(band + 1)) * np.uint64(3)))
        step += 1
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _entries(batches: Iterator[pa.RecordBatch], width: int, percent: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    edges = bands(1, percent)
    for hashes, fresh in _new_sets(batches, width):
        entries, names, infos = [], [], []
        is_heavy = in_bitmap(heavy, _cell_hash(hashes))
        for name, a, b in fresh:
            tokens, flags, n = hashes[a:b], is_heavy[a:b], b - a
            missing = _allowed(n, percent)
            rare = tokens[~flags][: _prefix_size(n, percent)] if flags.any() else tokens[: _prefix_size(n, percent)]
            need = len(rare) - missing
            found = [rare]
            if need < 1:
                need = MIXED
                if n >= edges[-1]:
                    edges = bands(n, percent)
                band = int(np.searchsorted(edges, n, "right")) - 1
                for index in (band, band + 1):
                    found.append(_combinations(tokens[flags], len(rare), missing, index, int(edges[max(0, index - 1)])))
            size = sum(map(len, found))
            entries += found
            names.append(np.full(size, name, np.int64))
            infos.append(np.full(size, n << 32 | need, np.int64))
        if entries:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(entries).view(np.int64)), pa.array(np.concatenate(names)), pa.array(np.concatenate(infos))], ["entry", "fp", "info"])


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of a sorted stream, such that no entry is cut in two. What is carried over is one entry at most."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [batch.column(c).to_numpy() for c in names]
        if held is not None:
            now = [np.concatenate((h, c)) for h, c in zip(held, now)]
        if not len(now[0]):
            continue
        other = np.flatnonzero(now[0] != now[0][-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        held = [c[cut:] for c in now]
        if cut:
            yield [c[:cut] for c in now]
    if held is not None and len(held[0]):
        yield held


def _shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by entry and node: those of two or more nodes, each with the first node as pivot."""
    for entry, fp, info in _grouped(batches, ["entry", "fp", "info"]):
        new = np.ones(len(entry), bool)
        new[1:] = (entry[1:] != entry[:-1]) | (fp[1:] != fp[:-1])
        entry, fp, info = entry[new], fp[new], info[new]
        first = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
        sizes = np.diff(np.append(first, len(entry)))
        pivot = np.repeat(first, sizes)
        kept = np.repeat(sizes > 1, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (entry, fp, info, fp[pivot], info[pivot])], ["entry", "fp", "info", "pivot", "pivot_info"])


def _counted(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """The distinct pairs (a, b, a_info, b_info) of the parts, and the sum of their n."""
    a, b, a_info, b_info, n = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return a[first], b[first], a_info[order][first], b_info[order][first], np.add.reduceat(n[order], first)


def _cross_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of one entry that are in different components, and whose sizes and sketches do not rule out a link.

    n is in how many entries a pair was met. Pairs are held up to ``HELD`` rows, so one that follows in
    entry after entry is given out once.
    """
    held: list[tuple] = []
    for part in _pairs_of_entries(batches, percent):
        held.append(part)
        if sum(len(h[0]) for h in held) > HELD:
            held = [_counted(held)]
            if 2 * len(held[0][0]) > HELD:
                yield _pair_batch(held.pop())
    if held:
        yield _pair_batch(_counted(held))


def _pair_batch(columns: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "a_info", "b_info", "n"])


def _pairs_of_entries(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[tuple]:
    for entry, fp, info, label, *bits in _grouped(batches, ["entry", "fp", "info", "label", *_BITS]):
        order = np.lexsort((label, entry))
        entry, fp, info, label = (c[order] for c in (entry, fp, info, label))
        size, sketch = info >> 32, np.stack(bits, axis=1)[order].view(np.uint64)
        # partners of a row: from the end of its component's run to the end of its entry
        places = np.arange(len(entry))
        last = np.flatnonzero(np.append(entry[1:] != entry[:-1], True))
        end = last[np.searchsorted(last, places)] + 1
        last = np.flatnonzero(np.append((entry[1:] != entry[:-1]) | (label[1:] != label[:-1]), True))
        start = last[np.searchsorted(last, places)] + 1
        counts = end - start
        ends = np.cumsum(counts)
        row = 0
        while row < len(entry):
            base = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            some = counts[row:stop]
            a = np.repeat(places[row:stop], some)
            b = np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some) + start[a]
            row = stop
            low, high = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            kept = np.flatnonzero(100 * low >= percent * high)
            both = low[kept] + high[kept]
            most = both - 2 * -(-both * percent // (100 + percent))  # tokens that linked sets may differ in
            kept = kept[np.bitwise_count(sketch[a[kept]] ^ sketch[b[kept]]).sum(axis=1) <= most]
            if len(kept):
                a, b = a[kept], b[kept]
                a, b = np.where(fp[a] < fp[b], a, b), np.where(fp[a] < fp[b], b, a)
                yield fp[a], fp[b], info[a], info[b], np.ones(len(a), np.int64)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for hashes, fresh in _new_sets(batches, width):
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in fresh], pa.int64()), pa.array([hashes[a:b].tobytes() for _, a, b in fresh], pa.binary())], ["fp", "tokens"])


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (left, starts), (right, others) = texts(batch.column("left")), texts(batch.column("right"))
        keep = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            both = np.concatenate((left[starts[k] : starts[k + 1]].view(np.uint64), right[others[k] : others[k + 1]].view(np.uint64)))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep[k] = 100 * common >= percent * (len(both) - common)
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("x").filter(mask), batch.column("y").filter(mask)], ["a", "b"])


def _needed(left: str, right: str):
    """How many entries two linked nodes share at least; one if both have frequent tokens in their prefix."""
    need = F.least(F.col(left).bitwiseAND(MIXED), F.col(right).bitwiseAND(MIXED))
    return F.when(need == MIXED, 1).otherwise(need)


def link(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text).

    Two documents link if their sets of shingles of ``width`` words have a Jaccard similarity of
    ``percent`` / 100 or more; component_id is the smallest doc_id that links lead to. Words are runs
    of bytes other than ASCII white space, A-Z lower-cased; a text of fewer words than ``width`` has
    its whole word sequence as its one shingle. A NULL text or one without words has no shingles and
    links with nothing. Rows with a NULL doc_id keep it as their component_id and link nothing.
    Repeated rows are returned as often as they occur. Shingles are compared by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = docs.where("doc_id IS NOT NULL").select("text")
    nodes = docs.mapInArrow(lambda it: _nodes(it, width), "doc_id long, fp long, n long, " + ", ".join(f"{c} long" for c in _BITS))
    nodes = stored(spark, nodes, "nodes")
    heavy = spark.sparkContext.broadcast(frequent_cells(named, width, percent))
    entries = named.mapInArrow(lambda it: _entries(it, width, percent, heavy.value), "entry long, fp long, info long")
    common = stored(
        spark,
        entries.repartition("entry").sortWithinPartitions("entry", "fp").mapInArrow(_shared_entries, "entry long, fp long, info long, pivot long, pivot_info long"),
        "entries",
    )

    first = stored(spark, nodes.where("fp <> 0").groupBy("fp").agg(F.min("doc_id").alias("doc")), "first")

    def sets_of(ends: DataFrame) -> DataFrame:
        """fp and tokens of the nodes in ``ends`` (fp), each from the text of its smallest doc_id."""
        ids = stored(spark, first.join(ends, "fp", "left_semi").select(F.col("doc").alias("doc_id")), "ids")
        sets = docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(lambda it: _sets(it, width), "fp long, tokens binary")
        out = stored(spark, sets.dropDuplicates(["fp"]).join(ends, "fp", "left_semi"), "sets")
        forget(spark, ids)
        return out

    def verified(pairs: DataFrame) -> DataFrame:
        """Ends (a, b) of the edges that the pairs (a, b, x, y) stand for whose nodes a and b link: their x and y."""
        sets = sets_of(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct())
        joined = pairs.join(sets.select(F.col("fp").alias("a"), F.col("tokens").alias("left")), "a").join(sets.select(F.col("fp").alias("b"), F.col("tokens").alias("right")), "b")
        links = stored(spark, joined.select("x", "y", "left", "right").mapInArrow(lambda it: _linked(it, percent), "a long, b long"), "links")
        forget(spark, sets)
        return links

    def best_pivots(shared: DataFrame, most: int, tried: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b) of each node and the ``most`` pivots that it shares the most entries with, of those that may link; x and y are their labels."""
        labels = [F.max(c).alias(c) for c in ("label", "pivot_label")]
        star = shared.groupBy("fp", "pivot").agg(F.count("*").alias("n"), F.max("info").alias("info"), F.max("pivot_info").alias("pivot_info"), *labels)
        sizes = [F.shiftright(c, 32) for c in ("info", "pivot_info")]
        star = star.where((F.col("n") * 2 * most >= _needed("info", "pivot_info")) & (100 * F.least(*sizes) >= percent * F.greatest(*sizes)))
        star = star.withColumns({"a": F.least("fp", "pivot"), "b": F.greatest("fp", "pivot"), "x": F.least("label", "pivot_label"), "y": F.greatest("label", "pivot_label")})
        if tried is not None:
            star = star.join(tried, ["a", "b"], "left_anti")
        place = F.row_number().over(Window.partitionBy("fp").orderBy(F.desc("n"), F.desc("pivot")))
        return star.withColumn("place", place).where(F.col("place") <= most).select("a", "b", "x", "y").distinct()

    def between(entries: DataFrame, merged: DataFrame, turn: int) -> DataFrame:
        """Rows of the entries (entry, fp, info, label) that hold nodes of several components, with their component as label.

        ``merged`` (node, component) says what labels become. Each entry has a pivot, drawn anew each ``turn``.
        """
        labelled = entries.join(merged, entries.label == merged.node, "left").select("entry", "fp", "info", F.coalesce("component", "label").alias("label"))
        drawn = F.min_by(F.struct("fp", "info", "label"), F.struct(F.xxhash64("fp", F.lit(turn), F.pmod("entry", F.lit(PIVOTS))), "fp"))
        entry = Window.partitionBy("entry")
        several = labelled.withColumns({"low": F.min("label").over(entry), "high": F.max("label").over(entry), "drawn": drawn.over(entry)}).where("low < high")
        pivot = [F.col(f"drawn.{c}").alias(d) for c, d in (("fp", "pivot"), ("info", "pivot_info"), ("label", "pivot_label"))]
        return stored(spark, several.select("entry", "fp", "info", "label", "low", *pivot), "open")

    # first, each node with the first node of its entries; a node is its own component so far
    pairs = stored(spark, best_pivots(common.where("fp <> pivot").withColumns({"label": F.col("fp"), "pivot_label": F.col("pivot")}), 1), "pairs")
    merged = components(spark, verified(pairs))
    links = merged.select(F.col("node").alias("a"), F.col("component").alias("b"))
    rest = between(common.select("entry", "fp", "info", F.col("fp").alias("label")), merged, 0)
    forget(spark, common)
    # then, with pivots of other components; a failed pair is not tried again. Links found are edges between components, and only these are worked on
    tried = pairs.select("a", "b")
    for turn in range(ROUNDS):
        pairs = stored(spark, best_pivots(rest.where("label <> pivot_label"), PIVOTS, tried), "pairs")
        found = verified(pairs)
        tried = tried.union(pairs.select("a", "b"))
        if found.isEmpty():
            break
        links = links.union(found)
        before, rest = rest, between(rest.select("entry", "fp", "info", "label"), components(spark, found), turn + 1)
        forget(spark, before)
    # last, all that index entries still hold of different components; entries of the same documents mostly have one lowest component, so they meet
    sketch = nodes.where("fp <> 0").groupBy("fp").agg(*(F.max(c).alias(c) for c in _BITS))
    rest = rest.select("entry", "fp", "info", "label", "low").withColumn("salt", F.pmod(F.xxhash64("entry"), F.lit(SALT)))
    rest = rest.join(sketch, "fp").repartition("low", "salt").sortWithinPartitions("low", "salt", "entry", "fp")
    pairs = rest.mapInArrow(lambda it: _cross_pairs(it, percent), "a long, b long, a_info long, b_info long, n long")
    pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("a_info").alias("a_info"), F.max("b_info").alias("b_info"))
    pairs = pairs.where(F.col("n") >= _needed("a_info", "b_info")).select("a", "b").join(tried, ["a", "b"], "left_anti")
    more = verified(stored(spark, pairs.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y")), "pairs"))
    # components of nodes, named by the smallest doc_id of a node's documents
    edges = links.union(more)
    edges = edges.join(first.select(F.col("fp").alias("a"), F.col("doc").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("doc").alias("y")), "b")
    found = components(spark, edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    by_set = first.join(found, first.doc == found.node, "left").select("fp", F.coalesce("component", "doc").alias("component"))
    return nodes.join(by_set, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNull() | (F.col("fp") == 0), F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
    )


def keep_first(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id. Rows without a doc_id stay."""
    gone = link(spark, docs, width, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(stored(spark, gone, "gone"), "doc_id", "left_anti").select(docs.columns)
