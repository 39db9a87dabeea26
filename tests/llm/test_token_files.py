import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patronage.llm import pieces, simple8b, token_files
from test_bpe import HARD, some_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("high", [1, 2, 3, 200, 50_000, 2**20, 2**31, 2**60 - 1, 2**60, 2**64 - 1])
def test_blocks_give_back_their_values(high):
    source = random.Random(high)
    for size in (0, 1, 2, 239, 240, 241, 511, 512, 513, 3000):
        values = np.array([source.choice((0, 1, source.randrange(high + 1), high)) for _ in range(size)], np.uint64)
        assert (simple8b.unpack(simple8b.pack(values)) == values).all()
    zeros = np.zeros(5000, np.uint64)
    assert (simple8b.unpack(simple8b.pack(zeros)) == zeros).all()
    assert len(simple8b.pack(zeros)) < 800


def test_a_block_that_is_none_is_refused():
    with pytest.raises(ValueError):
        simple8b.unpack(b"\0" * 40)


def expected(rows):
    tool = Tokenizer.from_file(PATH)
    tool.encode_special_tokens = True
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    return out


def test_files_hold_the_ids_of_the_library(spark, layout, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 400)
    texts = HARD + some_texts(300)
    rows = [(k * 7 % 1000, text) for k, text in enumerate(texts)] + [(5, "x"), (5, "x"), (5, None), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id", "1 AS start")
    found = token_files.write_and_read(spark, docs, PATH, 2)
    key = lambda r: (r[1], r[2])
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected(rows), key=key)


def test_no_documents(spark):
    assert token_files.write_and_read(spark, spark.createDataFrame([], "doc_id long, text string"), PATH, 2).count() == 0


def test_special_tokens_are_those_of_the_unchanged_library(spark):
    tool, start, want = Tokenizer.from_file(PATH), 0, []
    texts = ["a<|endoftext|>b", "a <|endoftext|> b c", "x <|endoftext|>y x", " <|endoftext|>", "<|endoftext|><|endoftext|> a  b", "<|endoftext |> a", "a b c"]
    for k, text in enumerate(texts):
        ids = [*tool.encode(text, add_special_tokens=False).ids, 2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert want[0][2] == 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(tuple(r) for r in token_files.write_and_read(spark, docs, PATH, 2, special=True).collect()) == want


def test_words_begin_where_one_after_the_other_says():
    source = np.random.default_rng(3)
    selectors = source.integers(0, 16, (40, simple8b.LANE)).astype(np.uint8)
    selectors[0], selectors[1], selectors[2] = 15, 0, 1
    want = []
    for lane, chosen in enumerate(selectors.tolist()):
        at = 0
        while at < simple8b.LANE:
            want.append(lane * (simple8b.LANE + 1) + at)
            at += int(simple8b.COUNTS[chosen[at]])
    found = simple8b._word_starts(selectors)
    assert found[found % (simple8b.LANE + 1) != simple8b.LANE].tolist() == want
    assert simple8b._word_starts(selectors[:0]).tolist() == []


def test_pieces_that_come_back_after_a_million_others_are_not_encoded_again():
    memory, asked = pieces.Memory(), []

    def compute(keys):
        asked.extend(keys)
        return [key.encode() for key in keys]

    long = "x" * 65
    for begin in range(0, 1_000_000, 100_000):
        keys = [" first", *(f" {k}" for k in range(begin, begin + 100_000)), long]
        assert memory.fill(keys, compute) == [key.encode() for key in keys]
        if not begin:
            memory.fill([f" early{k}" for k in range(10)], compute)
    memory.fill([f" early{k}" for k in range(10)], compute)
    assert asked.count(" first") == 1 and asked.count(" early3") == 1
    assert asked.count(long) == 10 and long not in memory.young
