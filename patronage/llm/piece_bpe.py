"""SentencePiece encoding and decoding for vocabularies of merge (BPE) type, by a score-ordered agenda of adjacent symbol pairs.

A text is normalised (a mark before it and for each space) and falls into single characters. All
neighbours whose union is a piece enter an agenda, best score first, then leftmost. The best pair is
taken out and, if both its symbols are still there, joined; the new symbol brings up to two new pairs.
What is left when the agenda is empty are the pieces; a character that is no piece becomes byte pieces.

A pair of characters that stands in no piece can never be inside a symbol, so a text may be cut there
without any change: here before runs of marks and at the edges of runs of punctuation, where the
vocabulary allows it. Each distinct part is then worked on once per Python worker, within a bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType

from patronage.llm.pieces import Memory, id_lists, small

MARK = "▁"
#: Parts that a half of a worker's memory holds.
REMEMBER = 600_000
SLICE_BYTES = 2 << 20
FEW = 40
NEVER = float("inf")
#: Fixed values of the model file: field numbers and the codes of merge type and of piece types.
_PIECES, _TRAINER, _NORMALIZER, _DENORMALIZER = 1, 2, 3, 5
_MODEL_TYPE, _BYTE_FALLBACK = 3, 35
_CHARSMAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 2, 3, 4, 5
_MERGES = 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message of the model file."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = raw[at : at + size], at + size
        yield tag >> 3, value


class Vocabulary:
    """Pieces, scores and the settings that decide a text's pieces.

    Taken from the model file. A file with a character map, unused or user-defined pieces, white space
    that is removed, or without byte pieces is refused with a ValueError: its rules are not built here.
    """

    def __init__(self, model: bytes):
        fields = list(_fields(model))
        trainer = dict(_fields(b"".join(v for k, v in fields if k == _TRAINER)))
        normal = dict(_fields(b"".join(v for k, v in fields if k == _NORMALIZER)))
        inverse = dict(_fields(b"".join(v for k, v in fields if k == _DENORMALIZER)))
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        kinds = [dict(_fields(v)).get(3, _NORMAL) for k, v in fields if k == _PIECES]
        if trainer.get(_MODEL_TYPE, 1) != _MERGES or not trainer.get(_BYTE_FALLBACK, 0):
            raise ValueError("not a vocabulary of merge type with byte pieces")
        if normal.get(_CHARSMAP) or inverse.get(_CHARSMAP) or normal.get(_EXTRA_SPACES, 1) or not normal.get(_ESCAPE, 1):
            raise ValueError("the vocabulary changes characters or white space")
        if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("the vocabulary has unused or user-defined pieces")
        self.library = library
        self.prefix = MARK if normal.get(_DUMMY_PREFIX, 1) else ""
        self.begin, self.end = library.bos_id(), library.eos_id()
        names = [library.id_to_piece(i) for i in range(len(kinds))]
        #: piece -> (negative score, id, id as bytes): the agenda's order and the token
        self.found = {w: (-library.get_score(i), i, i.to_bytes(4, "little")) for i, (w, kind) in enumerate(zip(names, kinds)) if kind == _NORMAL}
        self.none = (NEVER, -1, b"")
        self.bytes = [0] * 256
        surfaces = []
        for i, (name, kind) in enumerate(zip(names, kinds)):
            if kind == _BYTE:
                value = int(name[1:-1], 16)
                self.bytes[value] = i
                surfaces.append(bytes([value]))
            else:
                surfaces.append({_CONTROL: "", _UNKNOWN: " ⁇ "}.get(kind, name.replace(MARK, " ")).encode())
        self.kinds, self.marked = np.array(kinds), np.array([w.startswith(MARK) for w in names])
        self.sizes = np.fromiter(map(len, surfaces), np.int64, len(surfaces))
        self.starts, self.flat = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(surfaces), np.uint8)
        self.cut = re.compile(self._safe_cuts())

    def _safe_cuts(self) -> str:
        """A pattern whose matches cover a text, and between which no piece reaches.

        Marks begin a match, unless some piece has one further inside. ``apart`` are characters that are no
        letters and stand in no piece beside any other character but a mark or each other.
        """
        if any(MARK in w.lstrip(MARK) for w in self.found):
            return "(?s:.+)"
        beside = {pair for w in self.found for pair in zip(w, w[1:]) if MARK not in pair}
        apart = {c for c in {*map(chr, range(128)), *"".join(self.found)} if not c.isalpha() and c < "\uffff"} - {MARK}
        while mixed := {c for a, b in beside if (a in apart) != (b in apart) for c in (a, b) if c in apart}:
            apart -= mixed
        chars = "".join(map(re.escape, sorted(apart)))
        return f"{MARK}*(?:[{chars}]+|[^{MARK}{chars}]+)|{MARK}+"

    def pieces(self, text: str) -> bytes:
        """Ids of a normalised text as little-endian 32-bit words, by the agenda."""
        found = self.found
        symbols = self._few(list(text)) if len(text) <= FEW else self._many(list(text))
        out = bytearray()
        for symbol in symbols:
            if (token := found.get(symbol)) is not None:
                out += token[2]
            else:
                for byte in symbol.encode():
                    out += self.bytes[byte].to_bytes(4, "little")
        return bytes(out)

    def _few(self, symbols: list[str]) -> list[str]:
        """The symbols left of a short text. The agenda is a list with one place for each pair of neighbours."""
        get, none = self.found.get, self.none
        agenda = [get(a + b, none)[0] for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := min(agenda)) < NEVER:
            left = agenda.index(best)
            joined = symbols[left] = symbols[left] + symbols.pop(left + 1)
            del agenda[left]
            if left < len(agenda):
                agenda[left] = get(joined + symbols[left + 1], none)[0]
            if left:
                agenda[left - 1] = get(symbols[left - 1] + joined, none)[0]
        return symbols

    def _many(self, symbols: list) -> list[str]:
        """The same for a text of any length. The agenda is a heap; pairs whose symbols are gone are passed over."""
        found = self.found
        count = len(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        agenda = []
        for left in range(count - 1):
            if (pair := found.get(symbols[left] + symbols[left + 1])) is not None:
                agenda.append((pair[0], left, left + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            a, b = symbols[left], symbols[right]
            if a is None or b is None or len(a) + len(b) != size:
                continue  # one of the two has been joined with another symbol meanwhile
            joined = symbols[left] = a + b
            symbols[right] = None
            following = after[left] = after[right]
            if following < count:
                before[following] = left
                if (pair := found.get(joined + symbols[following])) is not None:
                    heappush(agenda, (pair[0], left, following, size + len(symbols[following])))
            earlier = before[left]
            if earlier >= 0 and (pair := found.get(symbols[earlier] + joined)) is not None:
                heappush(agenda, (pair[0], earlier, left, size + len(symbols[earlier])))
        return [symbol for symbol in symbols if symbol is not None]

    def encode(self, texts: list[str], memory: Memory) -> list[bytes]:
        """Ids of each text, without begin and end. An empty text has none."""
        cuts = [self.cut.findall(self.prefix + text.replace(" ", MARK)) if text else [] for text in texts]
        distinct = list(dict.fromkeys(x for pieces in cuts for x in pieces))
        ids = dict(zip(distinct, memory.fill(distinct, lambda keys: list(map(self.pieces, keys)))))
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in cuts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a row of ids in UTF-8, as the library gives it.

        Control pieces are silent, one mark at the beginning goes, and a byte that belongs to no character
        of its run of byte pieces becomes U+FFFD. An id outside the vocabulary raises a ValueError.
        """
        if len(ids) == 0:
            return b""
        if ids.min() < 0 or ids.max() >= len(self.kinds):
            raise ValueError("an id is not in the vocabulary")
        counts = self.sizes[ids]
        ends = np.cumsum(counts)
        data = self.flat[np.repeat(self.starts[ids] - ends + counts, counts) + np.arange(int(ends[-1]))]
        kinds = self.kinds[ids]
        heard = np.flatnonzero(kinds != _CONTROL)
        skip = int(len(heard) > 0 and bool(self.prefix) and bool(self.marked[ids[heard[0]]]) and kinds[heard[0]] == _NORMAL)
        raw = data[skip:].tobytes()
        if not (kinds == _BYTE).any():
            return raw
        if not (kinds[1:-1] == _CONTROL).any() and _is_text(raw):
            return raw
        return self._with_replacements(data, ends, kinds == _BYTE, skip)

    @staticmethod
    def _with_replacements(data: np.ndarray, ends: np.ndarray, is_byte: np.ndarray, skip: int) -> bytes:
        out, at = [], skip
        edges = np.flatnonzero(np.diff(np.concatenate(([False], is_byte, [False])).astype(np.int8)))
        for first, last in zip(edges[::2], edges[1::2]):  # runs of byte pieces
            begin, end = int(ends[first]) - 1, int(ends[last - 1])
            out.append(data[at:begin].tobytes())
            run = data[begin:end].tobytes()
            while run:
                size = next((k for k in range(1, min(4, len(run)) + 1) if _is_text(run[:k])), 0)
                out.append(run[:size] or b"\xef\xbf\xbd")
                run = run[size or 1 :]
            at = end
        out.append(data[at:].tobytes())
        return b"".join(out)


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_tools: dict[bytes, tuple[Vocabulary, Memory]] = {}


def tool(model: bytes) -> tuple[Vocabulary, Memory]:
    """The vocabulary of a model and the parts worked on so far, of this Python worker: made once, and kept from task to task for the last model."""
    key = hashlib.sha256(model).digest()
    if key not in _tools:
        _tools.clear()
        _tools[key] = Vocabulary(model), Memory(REMEMBER)
    return _tools[key]


def _schema(docs: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType(list(docs.schema.fields)).add(name, kind)


def _rows_of_ids(vocabulary: Vocabulary, batch: pa.RecordBatch, memory: Memory, ends: bool, check: bool) -> list[bytes]:
    texts = batch.column("text").fill_null("").to_pylist()
    found = vocabulary.encode(texts, memory)
    if ends:
        begin, end = vocabulary.begin.to_bytes(4, "little"), vocabulary.end.to_bytes(4, "little")
        found = [begin + ids + end for ids in found]
    if check:
        for ids, given in zip(found, vocabulary.library.encode(texts, add_bos=ends, add_eos=ends, num_threads=1)):
            if ids != np.array(given, "<u4").tobytes():
                raise ValueError("ids differ from those of the sentencepiece library")
    return found


def encode(spark: SparkSession, docs: DataFrame, path: str, ends: bool = True, check: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), the token ids of the whole text.

    With ``ends``, between the begin and the end id. A NULL text is an empty one: it has only these two.
    Characters like ``<s>`` in a text are ordinary text. With ``check`` each Arrow batch is compared with the
    library, and a difference fails the job. A column named ids is replaced; all rows stay, repeated rows too.
    """
    model = spark.sparkContext.broadcast(read_model(path))
    docs = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, memory = tool(model.value)
        for batch in small(batches, "text", SLICE_BYTES):
            found = _rows_of_ids(vocabulary, batch, memory, ends, check)
            edges = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, id_lists(np.frombuffer(b"".join(found), "<u4"), edges)], [*batch.schema.names, "ids"])

    return docs.mapInArrow(run, _schema(docs, "ids", ArrayType(IntegerType())))


def decode(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded`` (string), the text of their ``ids``; NULL or no ids give the empty text. An unknown id fails the job."""
    model = spark.sparkContext.broadcast(read_model(path))
    rows = rows.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = tool(model.value)
        for batch in batches:
            lists = batch.column("ids")
            texts = [vocabulary.decode(np.asarray(x.values, np.int64)) if x.is_valid else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, _schema(rows, "decoded", StringType()))


def digests(spark: SparkSession, docs: DataFrame, path: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, encoded with begin and end id and decoded again in one pass.

    The ids count as little-endian unsigned 32-bit integers. A NULL text is an empty one; NULL ids of
    documents and repeated rows stay as they are.
    """
    model = spark.sparkContext.broadcast(read_model(path))
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, memory = tool(model.value)
        for batch in small(batches, "text", SLICE_BYTES):
            found = _rows_of_ids(vocabulary, batch, memory, True, check)
            decoded = [vocabulary.decode(np.frombuffer(ids, "<u4").astype(np.int64)) for ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) // 4 for ids in found], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids in found], pa.string()),
                    pa.array([hashlib.sha256(text).hexdigest() for text in decoded], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = StructType([docs.schema["doc_id"]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return docs.mapInArrow(run, schema)
