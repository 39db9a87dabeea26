"""Removal of byte strings that a document with a smaller id also holds, by a distributed merge sort of suffixes.

1. Every window of ``window`` bytes has an anchor that its bytes alone decide (``suffix_runs.anchors``), so only
   suffixes at anchors need to be sorted. One exchange of short hashes finds the anchors whose bytes
   occur in two documents or more; all others cannot be part of a match and go no further.
2. Each task sorts its remaining suffixes. Of those with the same bytes on both sides only the smallest
   document's go on; the others are removed on the spot. So a passage that a third of all documents
   share sends a few suffixes from each task. Sorted runs are cut at common splitters, front-coded and exchanged.
3. Each range merges its runs with a loser tree. Neighbours in the order, with the bytes they have in common,
   tell which windows are equal; windows of a document that is not the smallest are removed.
4. Removed spans are joined with the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.pieces import small
from patronage.llm.shared import bitmap, in_bitmap, stored
from patronage.llm.suffix_runs import GRAM, Records, anchors, extract, front_code, merged, sorted_run
from patronage.llm.text import BYTE_WORDS, mix, powers, slices, texts

WINDOW = 50
RUN = 300_000
SAMPLE = 2_000


def _packed_hashes(batches: Iterator[pa.RecordBatch], window: int, ranges: int, kind) -> Iterator[pa.RecordBatch]:
    """Of each range of hashes one row: the hashes that occur in this task and the parts of their documents.

    The lowest bit of a part says that two documents of that part have the hash.
    """
    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        hashes, parts, docs = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((docs, parts, hashes))
        hashes, parts, docs = hashes[order], parts[order], docs[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (parts[1:] != parts[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hashes)) - 1
        tagged = (parts[first] * 2 + (docs[first] != docs[last])).astype(kind)
        low = hashes[first].astype(np.uint32)
        target = ((hashes[first] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(target, np.arange(ranges + 1))
        used = np.flatnonzero(np.diff(cuts))
        blocks = [low[a:b].tobytes() + tagged[a:b].tobytes() for a, b in zip(cuts[used], cuts[used + 1])]
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(blocks, pa.binary())], ["target", "block"])

    count = 0
    for batch, data, offsets in slices(batches):
        rows, _, _, _, hashes = anchors(data, offsets, window)
        held.append((hashes, batch.column("part").to_numpy()[rows].astype(np.int64), batch.column("doc_id").to_numpy()[rows]))
        count += len(rows)
        if count >= 3 * RUN:
            yield flush()
            count = 0
    if count:
        yield flush()


def _runs_of(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Batches of a sorted stream by the value of a column."""
    now, held = None, []
    for batch in batches:
        values = batch.column(name).to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist() if len(values) else []
        for a, b in zip(cuts, [*cuts[1:], len(values)]):
            if held and values[a] != now:
                yield now, held
                held = []
            now = int(values[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield now, held


def _repeated(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
    """For each part of the documents, the hashes of a range that occur in two documents or more."""
    width = 4 + np.dtype(kind).itemsize
    for target, held in _runs_of(batches, "target"):
        low, tagged = [], []
        for batch in held:
            for block in batch.column("block").to_pylist():
                n = len(block) // width
                low.append(np.frombuffer(block, np.uint32, n))
                tagged.append(np.frombuffer(block, kind, n, 4 * n))
        hashes, tags = np.concatenate(low), np.concatenate(tagged)
        order = np.argsort(hashes, kind="stable")
        hashes, tags = hashes[order], tags[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        sizes = np.diff(np.append(first, len(hashes)))
        keep = np.repeat((sizes > 1) | (np.maximum.reduceat((tags & 1).astype(np.uint8), first) > 0), sizes)
        hashes, parts = hashes[keep], (tags[keep] >> 1).astype(np.int64)
        order = np.argsort(parts, kind="stable")
        hashes, parts = hashes[order], parts[order]
        cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else np.zeros(0, np.int64)
        blocks = [np.unique(hashes[a:b]).tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(parts)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts[cuts].astype(np.int32)), pa.array([target] * len(cuts), pa.int32()), pa.array(blocks, pa.binary())], ["part", "target", "block"]
        )


def _sample(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for _, data, offsets in slices(batches):
        rows, place, _, _, _ = anchors(data, offsets, window)
        found = [data[p : p + GRAM].tobytes() for p in place[:: max(1, len(place) // (40 * len(offsets)) + 1)]]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["gram"])


def splitters(docs: DataFrame, window: int, ranges: int) -> list[bytes]:
    """Bounds of ``ranges`` ranges of suffixes from about ``SAMPLE`` documents. They balance the work and decide nothing else."""
    count = docs.count()
    if count == 0 or ranges < 2:
        return []
    some = docs.select("text").sample(False, min(1.0, SAMPLE / count), 1)
    grams = sorted(bytes(g) for g in some.mapInArrow(lambda it: _sample(it, window), "gram binary").toArrow()["gram"].to_pylist())
    return sorted({grams[len(grams) * k // ranges] for k in range(1, ranges)}) if grams else []


def _sorted_runs(batches: Iterator[pa.RecordBatch], window: int, ranges: int, bounds: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs of suffixes that may have a match, and the spans that are removed on the spot."""
    held: list[Records] = []
    edges = np.array(bounds, f"S{GRAM}")

    def flush() -> pa.RecordBatch:
        records, same = sorted_run(Records.joined(held))
        held.clear()
        group = np.cumsum(~same) - 1
        least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, records.doc)
        gone = records.doc > least[group]
        grams = np.ascontiguousarray(records.right[:, :GRAM]).view(f"S{GRAM}").ravel()
        target = np.searchsorted(edges, grams, "right")
        out = {"target": [], "runs": [], "spans": []}
        cuts = np.searchsorted(target, np.arange(len(edges) + 2))
        for k in np.flatnonzero(np.diff(cuts)):
            part = records.take(slice(cuts[k], cuts[k + 1]))
            removed = gone[cuts[k] : cuts[k + 1]]
            out["target"].append(int(k))
            out["runs"].append(front_code(part.take(~removed)))
            done = part.take(removed)
            out["spans"].append(np.stack((done.row, done.place - done.left_size, done.place + done.right_size)).astype("<i8").tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["target"], pa.int32()), pa.array(out["runs"], pa.binary()), pa.array(out["spans"], pa.binary())], list(out))

    count = 0
    for _, parts in _stream(batches):
        known = np.zeros(0, np.uint64)
        answers = []
        for batch in parts:
            if batch.column("block").null_count == 0:
                answers += [(np.uint64(t) << np.uint64(32)) | np.frombuffer(b, np.uint32).astype(np.uint64) for t, b in zip(batch.column("target").to_pylist(), batch.column("block").to_pylist())]
                continue
            if answers:
                known, answers = np.sort(np.concatenate(answers)), []
            if not len(known):
                continue
            for rows, data, offsets in slices(iter([batch])):
                owner, place, first, last, hashes = anchors(data, offsets, window)
                key = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))
                found = np.searchsorted(known, key)
                hit = np.flatnonzero(known[np.minimum(found, len(known) - 1)] == key)
                if len(hit):
                    owner, place, first, last = owner[hit], place[hit], first[hit], last[hit]
                    doc, row = (rows.column(c).to_numpy()[owner] for c in ("doc_id", "row_id"))
                    held.append(extract(data, place, first, last, doc, row, offsets[owner], window))
                    count += len(hit)
                    if count >= RUN:
                        yield flush()
                        count = 0
    if count:
        yield flush()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Like _runs_of, but hands out each piece as it comes: answers first, then documents."""

    def pieces():
        for batch in batches:
            part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            if len(part):
                cuts = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])))).tolist()
                for a, b in zip(cuts, [*cuts[1:], len(part)]):
                    yield int(part[a]), batch.slice(a, b - a)

    source = pieces()
    ahead = next(source, None)

    def one(part):
        nonlocal ahead
        while ahead is not None and ahead[0] == part:
            yield ahead[1]
            ahead = next(source, None)

    while ahead is not None:
        part = ahead[0]
        yield part, one(part)


def _removed(common, right_size, left, left_size, doc, row, place, window: int) -> tuple[np.ndarray, ...]:
    """Row, start and end of what each suffix's windows remove. ``common``: bytes shared with the suffix before."""
    count, most = len(doc), window - GRAM
    least, highest = np.full(count, window), np.full(count, -1)
    forward, _ = powers(most + 1)
    sums = np.zeros((count, most + 1), np.uint64)
    np.cumsum((BYTE_WORDS[left] + left.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) * forward[:most], axis=1, out=sums[:, 1:])
    low, high = window - right_size.astype(np.int64), left_size.astype(np.int64)
    for offset in range(most + 1):  # windows that begin so many bytes before their anchor
        group = np.cumsum(common < window - offset)
        index = np.flatnonzero((low <= offset) & (offset <= high))
        if len(index) < 2:
            continue
        key = mix(sums[index, offset] + mix(group[index].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        index, key = index[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        smallest = np.repeat(np.minimum.reduceat(doc[index], first), np.diff(np.append(first, len(key))))
        gone = index[doc[index] > smallest]
        least[gone] = np.minimum(least[gone], offset)
        highest[gone] = np.maximum(highest[gone], offset)
    found = np.flatnonzero(highest >= 0)
    return row[found], place[found] - highest[found], place[found] - least[found] + window


def _spans(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each range and give out what is removed, joined where it overlaps."""
    for _, held in _runs_of(batches, "target"):
        runs = [b for batch in held for b in batch.column("runs").to_pylist()]
        done = [np.frombuffer(b, "<i8").reshape(3, -1) for batch in held for b in batch.column("spans").to_pylist()]
        held.clear()
        yield from _joined(*np.concatenate(done, axis=1))
        del done
        for part in merged(runs):
            common, right_size, left, left_size, doc, row, place = part
            yield from _joined(*_removed(common, right_size, left, left_size, doc, row, place, window))


def _joined(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(row):
        return
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    # ends grow with starts inside a row once the running maximum is taken
    base = np.cumsum(np.concatenate(([0], row[1:] != row[:-1]))) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(base + end)
    new = np.concatenate(([True], (base + start)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    yield pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(start[first]), pa.array(reach[last] - base[last])], ["row_id", "start", "end"])


def spans(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """row_id, spans: for each row with something to remove, the byte ranges, not yet joined with each other.

    ``docs`` has doc_id, row_id and text.
    """
    ranges = parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = np.uint16 if 2 * parts < 2**16 else np.uint32
    docs = docs.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    bounds = splitters(docs, window, ranges)
    hashes = docs.select("part", "doc_id", "text").mapInArrow(lambda it: _packed_hashes(it, window, ranges, kind), "target int, block binary")
    answers = hashes.repartition("target").sortWithinPartitions("target").mapInArrow(lambda it: _repeated(it, kind), "part int, target int, block binary")
    asked = answers.select("part", F.lit(0).alias("kind"), "target", "block", *(F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("row_id", "long"), ("text", "string"))))
    given = docs.select("part", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("target"), F.lit(None).cast("binary").alias("block"), "doc_id", "row_id", "text")
    # a fixed order, so that a task that runs again makes the same runs
    together = asked.union(given).repartition("part").sortWithinPartitions("part", "kind", "target", "doc_id", "row_id")
    runs = together.mapInArrow(lambda it: _sorted_runs(it, window, ranges, bounds), "target int, runs binary, spans binary")
    found = runs.repartition("target").sortWithinPartitions("target").mapInArrow(lambda it: _spans(it, window), "row_id long, start long, end long")
    return found.groupBy("row_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _cut(batches: Iterator[pa.RecordBatch], names: list[str], characters: bool) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, "text"):
        data, offsets = texts(batch.column("text"))
        lists = batch.column("spans")
        edges = np.asarray(lists.offsets, np.int64)
        pairs = lists.values
        starts, ends = np.asarray(pairs.field("start"), np.int64), np.asarray(pairs.field("end"), np.int64)
        kept, removed, count = [], [], []
        for k in range(batch.num_rows):
            own = data[offsets[k] : offsets[k + 1]]
            a, b = starts[edges[k] : edges[k + 1]], ends[edges[k] : edges[k + 1]]
            marks = np.zeros(len(own) + 1, np.int64)
            np.add.at(marks, a, 1)
            np.add.at(marks, b, -1)
            gone = np.cumsum(marks[:-1]) > 0
            left = own[~gone].tobytes()
            kept.append(left.decode("utf-8", "ignore").encode() if characters else left)
            removed.append(int(gone.sum()))
            count.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())], [*names, "kept", "n_removed", "n_spans"]
        )


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, characters: bool = False) -> DataFrame:
    """``docs`` with kept (the bytes that stay), n_removed (bytes) and n_spans (maximal removed runs).

    A byte is removed if a string of ``window`` bytes that covers it also starts in a document with a
    smaller doc_id. A NULL text is empty; texts shorter than the window lose nothing. Rows with the
    same doc_id do not remove each other's bytes, and rows with a NULL doc_id neither remove nor
    lose any. Columns named kept, n_removed or n_spans are replaced. Rows are kept one for one. With
    ``characters``, what is left of a character that is cut in two is not in kept, which is valid UTF-8 then.
    """
    docs = docs.drop("kept", "n_removed", "n_spans", "row_id", "spans")
    names = docs.columns
    keyed = docs.withColumn("row_id", F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.xxhash64("doc_id", "text")))
    ids = keyed.where("row_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "row_id", "text")
    found = stored(spark, spans(spark, ids, window), "spans")
    wanted = spark.sparkContext.broadcast(bitmap(found.select("row_id"), 24))

    @F.pandas_udf("boolean")
    def touched(row_id: pd.Series) -> pd.Series:
        known = row_id.notna().to_numpy()
        return pd.Series(known & in_bitmap(wanted.value, row_id.fillna(0).to_numpy().astype(np.int64)))

    # texts without a removed span do not travel; the bitmap may let others pass, the join decides
    marked = keyed.withColumn("touched", touched("row_id"))
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    none = [whole.alias("kept"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans")]
    still = marked.where(~F.col("touched")).select(*names, *none)
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema), "kept binary, n_removed long, n_spans long"])
    joined = marked.where("touched").join(found, "row_id", "left").select(*names, F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))
    return still.union(joined.mapInArrow(lambda it: _cut(it, names, characters), schema))
