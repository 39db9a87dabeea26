"""Byte-level BPE in DuckDB: recursive queries over rows of (word, position, token), inside Spark's tasks.

Each task cuts its texts by the pattern into words. Distinct words that are no token themselves start
as one row per byte. Every round of the recursion joins neighbours with the merge table, takes each
word's leftmost pair of least rank, and contracts it; a word leaves when no pair can be merged. Long
words take all places of the least rank at once where that gives the same result (see ``_LONG``).
Decoding joins ids with the vocabulary and aggregates their bytes in order.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import tempfile
import threading
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from patronage.llm.pieces import Memory, encode_slice, gather, id_lists, small
from patronage.llm.text import give_back

LONG_WORD = 48
WORDS = 20_000
REMEMBER = 600_000
#: What DuckDB may hold in a Python worker; beyond it, it spills to the worker's own temporary folder.
MEMORY = "512MB"
_MASK = (1 << 32) - 1

#: State: word, position, token, next token, key of the pair (rank << 32 | position), least key of the word.
_SHORT = f"""
WITH RECURSIVE state(w, p, t, n, k, best) AS (
  SELECT w, p, t, n, k, min(k) OVER (PARTITION BY w)
  FROM (SELECT s.w, s.p, s.t, s.n, (g.id::BIGINT << 32) | s.p AS k FROM start s LEFT JOIN merges g ON g.l = s.t AND g.r = s.n)
  UNION ALL
  SELECT w, p, t, n, k, min(k) OVER (PARTITION BY w)
  FROM (
    SELECT c.w, c.p, c.t, c.n, (g.id::BIGINT << 32) | c.p AS k
    FROM (
      SELECT s.w, s.p - (s.p > (s.best & {_MASK}))::INT AS p,
             CASE WHEN s.k = s.best THEN (s.best >> 32)::INT ELSE s.t END AS t,
             CASE WHEN s.k = s.best THEN d.n WHEN s.p + 1 = (s.best & {_MASK}) THEN (s.best >> 32)::INT ELSE s.n END AS n
      FROM state s LEFT JOIN state d ON d.w = s.w AND s.k = s.best AND d.p = s.p + 1
      WHERE s.best IS NOT NULL AND s.p <> (s.best & {_MASK}) + 1
    ) c LEFT JOIN merges g ON g.l = c.t AND g.r = c.n
  )
)
SELECT w, list(t ORDER BY p) AS ids FROM state WHERE best IS NULL GROUP BY w ORDER BY w
"""

#: The same for long words. Unless some pair with the merged token has a lower rank than that token
#: (``unsafe``), merging one place cannot bring up a lower rank, so the leftmost place, then the next
#: one that does not overlap it, and so on, are merged in one round: every other place of each run of
#: adjoining places. Otherwise the leftmost place alone.
_LONG = """
WITH RECURSIVE state(w, p, t, m, best) AS (
  SELECT w, p, t, m, min(m) OVER (PARTITION BY w)
  FROM (SELECT s.w, s.p, s.t, g.id AS m FROM start s LEFT JOIN merges g ON g.l = s.t AND g.r = s.n)
  UNION ALL
  SELECT w, p, t, m, min(m) OVER (PARTITION BY w)
  FROM (
    SELECT c.w, c.p, c.t, g.id AS m
    FROM (
      SELECT w, t, row_number() OVER o AS p, lead(t) OVER o AS n
      FROM (
        SELECT w, p, CASE WHEN pick THEN best ELSE t END AS t, coalesce(lag(pick) OVER (PARTITION BY w ORDER BY p), false) AS gone
        FROM (
          SELECT w, p, t, best, hit AND CASE WHEN best IN (SELECT id FROM unsafe) THEN p = leftmost
                 ELSE (p - coalesce(max(CASE WHEN NOT hit THEN p END) OVER (PARTITION BY w ORDER BY p), before)) % 2 = 1 END AS pick
          FROM (
            SELECT w, p, t, best, coalesce(m = best, false) AS hit,
                   min(CASE WHEN m = best THEN p END) OVER (PARTITION BY w) AS leftmost, min(p) OVER (PARTITION BY w) - 1 AS before
            FROM state WHERE best IS NOT NULL
          )
        )
      )
      WHERE NOT gone
      WINDOW o AS (PARTITION BY w ORDER BY p)
    ) c LEFT JOIN merges g ON g.l = c.t AND g.r = c.n
  )
)
SELECT w, list(t ORDER BY p) AS ids FROM state WHERE best IS NULL GROUP BY w ORDER BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Coder:
    """A DuckDB connection with the merge table and the vocabulary of one tokenizer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces, self.runs = Memory(REMEMBER), Memory(REMEMBER)
        rows = [(ranks[w[:k]], ranks[w[k:]], i) for w, i in ranks.items() for k in range(1, len(w)) if w[:k] in ranks and w[k:] in ranks]
        left, right, merged = (np.array(x, np.int32) for x in zip(*rows)) if rows else (np.zeros(0, np.int32),) * 3
        unsafe = np.unique(np.concatenate((left[left > merged], right[right > merged])))
        self.space_first = np.zeros(max(ranks.values()) + 1, bool)
        self.space_first[[i for w, i in ranks.items() if w[:1] == b" "]] = True
        self.connection = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.gettempdir()})
        for name, columns in {
            "merges": {"l": left, "r": right, "id": merged},
            "unsafe": {"id": unsafe},
            "vocabulary": {"id": np.array(list(ranks.values()), np.int32), "token": [w.decode("latin-1") for w in ranks]},
        }.items():
            self.connection.register("given", pa.table(columns))
            self.connection.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.connection.unregister("given")

    def _start(self, words: list[bytes]) -> pa.Table:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tokens = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        following = np.append(tokens[1:], np.int32(-1))
        following[np.cumsum(sizes) - 1] = -1
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "p": place.astype(np.int32), "t": tokens, "n": following})

    def _run(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of each word by one of the two queries, ``WORDS`` at a time: all rounds of a query are held until it ends."""
        out: list[bytes] = []
        for begin in range(0, len(words), WORDS):
            out += self._run_some(words[begin : begin + WORDS], query)
        return out

    def _run_some(self, words: list[bytes], query: str) -> list[bytes]:
        self.connection.register("start", self._start(words))
        lists = self.connection.sql(query).to_arrow_table()["ids"].combine_chunks()
        self.connection.unregister("start")
        values = np.asarray(lists.flatten(), np.uint32)
        edges = np.asarray(lists.offsets, np.int64)
        edges = edges - edges[0]
        return [values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (one match of the pattern), as bytes."""
        out: list = [None] * len(words)
        groups: dict[str, list[int]] = {_SHORT: [], _LONG: []}
        for at, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[at] = rank.to_bytes(4, "little")
            else:
                groups[_LONG if len(word) > LONG_WORD else _SHORT].append(at)
        for query, places in groups.items():
            for at, ids in zip(places, self._run([words[k] for k in places], query)):
                out[at] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes."""
        found = [self.pattern.findall(text) for text in texts]
        distinct = list(dict.fromkeys(word for words in found for word in words))
        ids = dict(zip(distinct, self.merge([word.encode() for word in distinct])))
        return [ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words)) for words in found]

    def decode_runs(self, runs: list[bytes]) -> list[bytes]:
        """Bytes of each run of ids, ``WORDS`` at a time."""
        return [x for begin in range(0, len(runs), WORDS) for x in self._decode_some(runs[begin : begin + WORDS])]

    def _decode_some(self, runs: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        ids = np.frombuffer(b"".join(runs), np.uint32).astype(np.int32)
        self.connection.register("given", pa.table({"d": np.repeat(np.arange(len(runs), dtype=np.int32), sizes), "p": np.arange(len(ids)), "id": ids}))
        joined = self.connection.sql("SELECT d, string_agg(token, '' ORDER BY p) AS x FROM given JOIN vocabulary USING (id) GROUP BY d ORDER BY d").to_arrow_table()
        self.connection.unregister("given")
        if len(joined) != len(runs):
            raise ValueError("an id is not in the vocabulary")
        return [x.encode("latin-1") for x in joined["x"].to_pylist()]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of rows of ids, and where each row starts. Rows are cut before ids that begin with a space, and each distinct run is decoded once."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(edges), np.int64)
        cut = np.zeros(len(ids) + 1, bool)
        cut[edges] = True
        known = ids < len(self.space_first)
        cut[:-1] |= self.space_first[np.where(known, ids, 0)] & known
        cut[0] = cut[-1] = True
        bounds = np.flatnonzero(cut)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64) * 4), pa.py_buffer(np.ascontiguousarray(ids, np.uint32))])
        coded = raw.dictionary_encode()
        data, counts = gather(self.runs.fill(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.decode_runs), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), 1)
        ends = np.concatenate(([0], np.cumsum(counts)))
        return data, ends[np.searchsorted(bounds, edges)]


_coders: dict = {}
_lock = threading.Lock()


def coder(shared, pattern: str) -> Coder:
    """The coder of this Python worker for a broadcast vocabulary; made once."""
    key = (shared.value["name"], pattern)
    with _lock:
        if key not in _coders:
            _coders[key] = Coder(shared.value["ranks"], pattern)
    return _coders[key]


def release() -> None:
    """Close all coders of this Python worker, so that a worker that waits for other tasks holds nothing."""
    with _lock:
        for tool in _coders.values():
            tool.connection.close()
        _coders.clear()
    gc.collect()
    give_back()


def _schema(docs: DataFrame, more: str, without: tuple[str, ...] = ()) -> str:
    own = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in without]
    return ", ".join([*own, more])


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text (array<int>).

    A NULL or empty text has no ids. Special tokens are ordinary text. A column named ids is
    replaced; all rows are kept, repeated rows too.
    """
    shared = spark.sparkContext.broadcast({"name": path, "ranks": read_ranks(path)})
    docs = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(shared, pattern)
        for batch in small(batches, "text", 4 << 20):
            ids, edges = encode_slice(batch.column("text"), tool.pieces, tool.encode)
            yield pa.RecordBatch.from_arrays([*batch.columns, id_lists(ids, edges)], [*batch.schema.names, "ids"])

    return docs.mapInArrow(run, _schema(docs, "ids array<int>"))


def decode(spark: SparkSession, rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows`` with ``decoded``, the bytes that their ``ids`` stand for; NULL ids give no bytes. An unknown id fails the job."""
    shared = spark.sparkContext.broadcast({"name": path, "ranks": read_ranks(path)})
    rows = rows.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(shared, pattern)
        for batch in small_lists(batches, "ids"):
            column = batch.column("ids")
            column = pc.if_else(pc.is_null(column), pa.scalar([], column.type), column) if column.null_count else column
            edges = np.asarray(column.offsets, np.int64)
            data, ends = tool.decode(np.asarray(column.flatten(), np.int64).astype(np.uint32), edges - edges[0])
            bytes_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
            yield pa.RecordBatch.from_arrays([*batch.columns, bytes_.cast(pa.binary())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, _schema(rows, "decoded binary"))


def digests(spark: SparkSession, docs: DataFrame, path: str, pattern: str, with_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, encoded and decoded again in one pass.

    The ids count as little-endian unsigned 32-bit integers. With ``with_ids`` the ids are kept as
    ``ids``. NULL and empty texts have no tokens, and the digests of no bytes. ``remember`` is how many
    words each Python worker keeps between batches; it decides memory and time only. With fewer than
    ``REMEMBER`` a worker also gives back all its memory at the end of each task.
    """
    shared = spark.sparkContext.broadcast({"name": path, "ranks": read_ranks(path)})
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = coder(shared, pattern)
        tool.pieces.size = tool.runs.size = remember
        try:
            for batch in small(batches, "text", 2 << 20 if remember < REMEMBER else 4 << 20):
                ids, edges = encode_slice(batch.column("text"), tool.pieces, tool.encode)
                data, ends = tool.decode(ids, edges)
                out = {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(np.diff(edges)),
                    "ids_sha256": pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(edges[:-1], edges[1:])], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
                }
                if with_ids:
                    out["ids"] = id_lists(ids, edges)
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
        finally:
            if remember < REMEMBER:
                release()

    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.mapInArrow(run, _schema(docs, more, ("text",)))


def small_lists(batches: Iterator[pa.RecordBatch], name: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` list items in the named column, at least one row each."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < batch.num_rows:
            base = ends[row - 1] if row else 0
            end = min(batch.num_rows, max(row + 1, int(np.searchsorted(ends, base + limit, "right"))))
            yield batch.slice(row, end - row)
            row = end
