"""SentencePiece ids and texts against the sentencepiece library."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from patronage.llm import piece_bpe
from patronage.llm.pieces import Memory

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", " ", "  ", "▁", "é", "漢", "字", "\n", "\t", "<s>", "the", "\0", "🙂", "é", "   ", "<0x0A>", "of", "ing", "﻿", "​", "12", ".", "',"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return piece_bpe.Vocabulary(piece_bpe.read_model(PATH))


def random_texts(count, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randrange(60))) for _ in range(count)]


def test_ids_and_texts_equal_the_library(vocabulary, library):
    texts = [*random_texts(2000, 1), "", " ", "    ", "x" * 3000, " " * 2000, "▁", "▁▁ ▁"]
    found = vocabulary.encode(texts, Memory(100))
    for text, ids, expected in zip(texts, found, library.encode(texts)):
        assert ids == np.array(expected, "<u4").tobytes(), text
        assert vocabulary.decode(np.array([1, *expected, 2])).decode() == library.decode([1, *expected, 2])


def test_list_and_heap_give_the_same(vocabulary):
    for text in random_texts(300, 2):
        assert vocabulary._few(list(text)) == vocabulary._many(list(text))


def test_any_ids_decode_as_in_the_library(vocabulary, library):
    draw = random.Random(3)
    for _ in range(3000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(259), draw.randrange(131, 259), 0, 1, 2]) for _ in range(draw.randrange(9))]
        assert vocabulary.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([32000]))


def test_a_very_long_word_takes_no_square_time(vocabulary, library):
    draw = random.Random(4)
    word = "".join(draw.choice("abcdefghij") for _ in range(100_000))
    begin = time.time()
    assert vocabulary.encode([word], Memory(10))[0] == np.array(library.encode(word), "<u4").tobytes()
    assert time.time() - begin < 30


def test_queries_rows_columns_nulls_and_repeats(spark, library):
    rows = [(1, "The cat sat.", "x"), (2, None, "y"), (3, "", "z"), (1, "The cat sat.", "x"), (None, "漢字 <s>", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = piece_bpe.decode(spark, piece_bpe.encode(spark, docs, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    for row in coded.collect():
        assert row.ids == library.encode(row.text or "", add_bos=True, add_eos=True)
        assert row.decoded == library.decode(row.ids)
    found = {r.doc_id: r for r in piece_bpe.digests(spark, docs, PATH).collect()}
    assert piece_bpe.digests(spark, docs, PATH).count() == 5
    ids = library.encode("The cat sat.", add_bos=True, add_eos=True)
    assert found[1].n_tokens == len(ids)
    assert found[1].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert found[1].decoded_sha256 == hashlib.sha256(b"The cat sat.").hexdigest()
    assert (found[2].n_tokens, found[2].decoded_sha256) == (found[3].n_tokens, found[3].decoded_sha256) == (2, hashlib.sha256(b"").hexdigest())
    assert piece_bpe.digests(spark, docs.limit(0), PATH).count() == 0
    bare = piece_bpe.decode(spark, spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH)
    assert bare.first().decoded == ""


def test_a_difference_from_the_library_fails(vocabulary, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(piece_bpe.Vocabulary, "encode", lambda self, texts, memory: [b"" for _ in texts])
    with pytest.raises(ValueError):
        piece_bpe._rows_of_ids(vocabulary, pa.record_batch({"text": pa.array(["a"])}), Memory(1), True, True)


def test_other_vocabularies_are_refused():
    raw = piece_bpe.read_model(PATH)
    with pytest.raises(ValueError):  # removes white space: one flag of the normaliser's settings changed
        piece_bpe.Vocabulary(raw.replace(b"\x12\x00\x18\x01 \x00", b"\x12\x00\x18\x01 \x01"))


def test_parts_are_known_from_one_task_to_the_next(monkeypatch):
    model = piece_bpe.read_model(PATH)
    vocabulary, memory = piece_bpe.tool(model)
    first = vocabulary.encode(["known parts, again"], memory)
    again, kept = piece_bpe.tool(bytes(bytearray(model)))
    monkeypatch.setattr(again, "pieces", lambda text: pytest.fail("worked on twice"))
    assert again.encode(["known parts, again"], kept) == first
