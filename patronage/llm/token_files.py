"""Token ids of a corpus as files: documents in ascending order, ids packed in Simple-8b blocks.

Documents are range partitioned by id and tokenized after the shuffle. A block holds whole documents,
about ``BLOCK_IDS`` ids or one longer document. Files are Parquet: each row is a block with its place
(shard and number in it), the ids and lengths of its documents, and the packed bytes. Spark's commit
protocol publishes them, so a lost executor leaves no half-written file. A block also says how many ids
stand before it in its shard; only the totals of shards are added up when the files are read.
"""

from __future__ import annotations

import threading
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm import simple8b
from patronage.llm.pieces import Memory, encode_slice, small
from patronage.session import shared_dir

BLOCK_IDS = 1 << 16
_FILES = "shard int, block int, before long, doc_ids array<long>, lengths array<long>, ids binary"

_tokenizers: dict = {}
_lock = threading.Lock()


class _Encoder:
    """The tokenizers library over many strings at once: joined, encoded in one call, and cut again by the bytes of the ids."""

    def __init__(self, content: str, special: bool):
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_str(content)
        self.tool.encode_special_tokens = not special
        self.added = [token.content for token in self.tool.get_added_tokens_decoder().values()] if special else []
        self.spaced = any(" " in x for x in self.added)  # could come about where strings are joined
        self.memory = Memory()
        units = _byte_units()
        self.sizes = np.zeros(self.tool.get_vocab_size(), np.int64)
        for token, number in self.tool.get_vocab().items():
            self.sizes[number] = len(token) if all(c in units for c in token) else -1

    def __call__(self, strings: list[str]) -> list[bytes]:
        # a space before a visible character begins a new match whatever stands before it
        together = "\n".join(strings)
        added = [x for x in self.added if x in together]
        joined = [] if self.spaced else [at for at, text in enumerate(strings) if text[:1] == " " and text[1:2].strip() and not (added and any(x in text for x in added))]
        out: list = [b""] * len(strings)
        taken = set(joined) if len(joined) < len(strings) else ()
        alone = [at for at in range(len(strings)) if at not in taken] if len(joined) < len(strings) else []
        for begin in range(0, len(alone), 1000):
            part = alone[begin : begin + 1000]
            for at, found in zip(part, self.tool.encode_batch_fast([strings[k] for k in part], add_special_tokens=False)):
                out[at] = np.array(found.ids, "<u4").tobytes()
        for begin in range(0, len(joined), 1000):
            part = joined[begin : begin + 1000]
            texts = [strings[k] for k in part]
            ids = np.array(self.tool.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum(self.sizes[ids])
            want = np.cumsum(list(map(len, map(str.encode, texts))))
            cuts = np.searchsorted(ends, want) + 1
            if len(ends) and ((self.sizes[ids] < 0).any() or (ends[np.minimum(cuts, len(ends)) - 1] != want).any()):
                raise ValueError("the tokenizer merged over a cut: its pattern is not the one expected")
            raw, before = ids.astype("<u4").tobytes(), 0
            for at, cut in zip(part, (4 * cuts).tolist()):
                out[at] = raw[before:cut]
                before = cut
        return out


def _byte_units() -> set[str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1, and others moved to 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b) for b in plain} | {chr(256 + k) for k in range(256 - len(plain))}


def _encoder(shared) -> _Encoder:
    key = shared.value["name"], shared.value["special"]
    with _lock:
        if key not in _tokenizers:
            _tokenizers[key] = _Encoder(shared.value["content"], shared.value["special"])
    return _tokenizers[key]


def _blocks(batches: Iterator[pa.RecordBatch], shared, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard, number, before = TaskContext.get().partitionId(), 0, 0
    docs: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        row = {
            "shard": pa.array([shard], pa.int32()),
            "block": pa.array([number], pa.int32()),
            "before": pa.array([before], pa.int64()),
            "doc_ids": pa.array([np.concatenate(docs).tolist()], pa.list_(pa.int64())),
            "lengths": pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
            "ids": pa.array([simple8b.pack(np.concatenate(ids))], pa.binary()),
        }
        docs.clear(), lengths.clear(), ids.clear()
        return pa.RecordBatch.from_arrays(list(row.values()), list(row))

    tool = _encoder(shared)
    for batch in small(batches, "text", 8 << 20):
        found, edges = encode_slice(batch.column("text"), tool.memory, tool, tool.added)
        ended = np.insert(found, edges[1:], end_id)
        edges = edges + np.arange(len(edges))
        names = np.array(batch.column("doc_id").to_pylist(), object)
        row = 0
        while row < len(names):
            stop = int(np.searchsorted(edges, edges[row] + BLOCK_IDS - held, "left"))
            stop = min(len(names), max(row + 1, stop))
            docs.append(names[row:stop])
            lengths.append(np.diff(edges[row : stop + 1]))
            ids.append(ended[edges[row] : edges[stop]])
            held += int(edges[stop] - edges[row])
            if held >= BLOCK_IDS:
                yield flush()
                number, before, held = number + 1, before + held, 0
            row = stop
    if docs:
        yield flush()


def write(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, folder: str, special: bool = False) -> None:
    """Write the token ids of all texts of ``docs`` (doc_id, text), each with ``end_id`` behind it, to ``folder``.

    Documents are in ascending order of doc_id, NULL first; rows with the same doc_id in the order of
    their texts. A NULL or empty text has the end id only. Special tokens in a text are ordinary
    text, or with ``special`` those tokens, as the library has it unless told otherwise; such a text is encoded whole.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast({"name": tokenizer, "content": file.read(), "special": special})
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda it: _blocks(it, shared, end_id), _FILES).write.option("compression", "zstd").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids = simple8b.unpack(batch.column("ids")[k].as_py()).astype("<u4")
            names = batch.column("doc_ids")[k].values
            lengths = np.asarray(batch.column("lengths")[k].values, np.int64)
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    names,
                    pa.array(batch.column("before")[k].as_py() + ends - lengths),
                    pa.array(lengths),
                    pa.array(np.array([zlib.crc32(ids[a:b]) for a, b in zip(ends - lengths, ends)], np.int64)),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone.

    ``start`` adds the shards before, by a window over one row per shard. There are as many shards as
    shuffle partitions, so that table is broadcast.
    """
    files = spark.read.schema(_FILES).parquet(folder)
    shards = files.select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    placed = files.join(F.broadcast(earlier), "shard").select("doc_ids", "lengths", "ids", (F.col("before") + F.col("earlier")).alias("before"))
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, special: bool = False) -> DataFrame:
    """Write the files to a new folder in the shared folder and return the digests read from them."""
    folder = f"{shared_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write(spark, docs, tokenizer, end_id, folder, special)
    return read_digests(spark, folder)
