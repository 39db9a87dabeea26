"""Benchmark decontamination: which documents contain which test items, by MinHash containment search.

Items are partitioned by size: class ``j`` holds those with 2**j to 2**(j+1) - 1 distinct shingles. The
signature of an item is the bottom-k MinHash sketch of its shingles, where ``k`` belongs to the class: one
more than the number of shingles that the largest item of the class may miss. A document that contains
an item to the asked degree misses too few shingles to miss its whole signature, however long the
document is. So documents are probed with all their shingles against the signatures, which leaves out
no match, and candidates are verified by counting the item's distinct shingles in the document.

What is broadcast are two bitmaps of fixed size over the hashes of signatures and of all item
shingles. They let a few others pass; joins with the tables of shingles decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.shared import bitmap, in_bitmap, stored
from patronage.llm.text import shingle_sets, slices, window_hashes, word_bounds, word_hashes

BITS = 24


def signature_size(size: int, percent: int = 80) -> int:
    """How many of an item's smallest hashes are its signature: the most that any item of its size class needs."""
    largest = (1 << size.bit_length()) - 1
    return min(size, largest - -(-largest * percent // 100) + 1)


def _item_shingles(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in slices(batches):
        hashes, at = shingle_sets(data, offsets, width)
        _, _, rows = word_bounds(data, offsets)
        words = np.minimum(np.bincount(rows, minlength=batch.num_rows), width)
        sizes = np.diff(at)
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        place = np.arange(len(hashes)) - at[owner]
        needed = np.array([signature_size(int(n), percent) for n in sizes], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("item_id").take(pa.array(owner)),
                pa.array(hashes.view(np.int64)),
                pa.array(sizes[owner]),
                pa.array(words[owner].astype(np.int32)),
                pa.array(place < needed[owner] if len(owner) else np.zeros(0, bool)),
            ],
            ["item_id", "hash", "n_shingles", "words", "in_signature"],
        )


def _hits(batches: Iterator[pa.RecordBatch], widths: list[int], signatures: np.ndarray, everything: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each document that has a hash of a signature: its distinct hashes that some item has."""
    for batch, data, offsets in slices(batches):
        starts, ends, rows = word_bounds(data, offsets)
        words = word_hashes(data, starts, ends)
        parts = [window_hashes(words, rows, width) for width in widths]
        hashes, owner = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        kept = in_bitmap(everything, hashes)
        hashes, owner = hashes[kept], owner[kept]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        candidate = np.zeros(batch.num_rows, bool)
        candidate[owner[in_bitmap(signatures, hashes)]] = True
        kept = candidate[owner]
        place = pa.array(owner[kept])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(place), batch.column("row_id").take(place), pa.array(hashes[kept].view(np.int64))], ["doc_id", "row_id", "hash"])


def find(spark: SparkSession, docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment: each document with each item that it contains.

    A document contains an item if it has ``percent`` / 100 or more of the item's distinct shingles of
    ``width`` words (A-Z lower-cased, split at ASCII white space). An item of fewer words is contained
    if they stand in the document one after the other. Items and documents that are NULL or have
    no words match nothing. One row per pair of doc_id and item_id: of rows with the same
    doc_id, the one with the most shared shingles counts. Rows with a NULL id are left out.
    """
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_id"), "text")
    items = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").dropDuplicates()
    shingles = items.mapInArrow(lambda it: _item_shingles(it, width, percent), "item_id long, hash long, n_shingles long, words int, in_signature boolean")
    shingles = stored(spark, shingles, "items")
    widths = sorted({width, *(r["words"] for r in shingles.select("words").distinct().collect())})
    signatures = spark.sparkContext.broadcast(bitmap(shingles.where("in_signature").select("hash"), BITS))
    everything = spark.sparkContext.broadcast(bitmap(shingles.select("hash"), BITS))
    hits = docs.mapInArrow(lambda it: _hits(it, widths, signatures.value, everything.value), "doc_id long, row_id long, hash long").distinct()
    counted = hits.join(shingles, "hash").groupBy("doc_id", "row_id", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"), F.max("in_signature").alias("candidate"))
    whole = counted.where(F.col("candidate") & (100 * F.col("n_shared") >= percent * F.col("n_shingles")))
    best = whole.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shared", "n_shingles")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_shingles", "best.n_shared", (F.col("best.n_shared") / F.col("best.n_shingles")).alias("containment"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that contain an item; rows with a NULL doc_id stay."""
    gone = stored(spark, find(spark, docs, items, width, percent).select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
