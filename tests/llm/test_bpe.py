import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from patronage.llm import bpe
from patronage.llm.pieces import encode_slice

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
HARD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b ", "x \n y\n\n z", "\n \nfoo", "it's  I'LL don't", " x  y", "a　b 　c",
    "aaaa" * 500, "ab" * 700 + "a", "é" * 301, "日本語のテキスト、です。", "\x1c \x1d\x85 ​﻿", "12345 67890½ ²", "a" * 49, "🙂🙂 x🙂", "<|endoftext|>",
    "the the the", "the the the", "\r\n\r\n  \t x", "-" * 300, "=" * 77 + "\n" + "=" * 78,
]


@pytest.fixture(scope="module")
def tools():
    ranks = bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Coder(ranks, public_tokenizers.PATTERN), own


def some_texts(count):
    source = random.Random(5)
    letters = "aabbceth  \n'1é日🙂-_.\t "
    return ["".join(source.choice(letters) for _ in range(source.randrange(90))) for _ in range(count)]


def test_merging_gives_the_ids_of_the_public_library(tools):
    coder, own = tools
    texts = HARD + some_texts(1500)
    ids, edges = encode_slice(pa.array(texts), coder.pieces, coder.encode)
    for text, a, b in zip(texts, edges[:-1], edges[1:]):
        assert ids[a:b].tolist() == own.encode_ordinary(text or ""), repr(text)[:80]
    data, ends = coder.decode(ids, edges)
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert data[a:b].tobytes() == (text or "").encode()


def test_both_forms_of_the_recursion_agree(tools):
    coder, own = tools
    words = [w.encode() for t in HARD + some_texts(200) if t for w in coder.pattern.findall(t)]
    words = [w for w in dict.fromkeys(words) if w not in coder.ranks and len(w) < 400]
    assert coder._run(words, bpe._SHORT) == coder._run(words, bpe._LONG)


def test_columns_and_rows_stay(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "the end\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.decode(spark, bpe.encode(spark, docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted((r.doc_id, r.text or "", bytes(r.decoded).decode()) for r in found.collect()) == [(1, "", ""), (2, "", ""), (2, "", ""), (3, "the end\n", "the end\n")]
    assert bpe.encode(spark, docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_decoding_takes_any_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 1, 2, 300])], "k long, ids array<int>")
    ranks = {i: w for w, i in bpe.read_ranks(PATH).items()}
    found = {r.k: bytes(r.decoded) for r in bpe.decode(spark, rows, PATH, public_tokenizers.PATTERN).collect()}
    assert found == {1: b"", 2: b"", 3: b"".join(ranks[i] for i in (0, 1, 2, 300))}


def test_values_are_gathered_without_an_index_for_each_item():
    """Results of codes one after the other, in little more memory than the result itself."""
    import tracemalloc

    from patronage.llm.pieces import gather

    for width, kind in ((1, np.uint8), (4, np.uint32)):
        values = [b"", b"abcd" * 2, b"wxyz", b"12345678" * 3]
        codes = np.array([3, 0, 1, 1, 0, 2, 3])
        data, counts = gather(values, codes, width)
        assert data.dtype == kind and data.tobytes() == b"".join(values[k] for k in codes)
        assert counts.tolist() == [len(values[k]) // width for k in codes]
        for some, none in (([], []), ([b"", b""], [1, 0, 1])):
            data, counts = gather(some, np.array(none, np.int64), width)
            assert data.dtype == kind and len(data) == 0 and counts.tolist() == [0] * len(none)
    codes = np.zeros(1000, np.int64)
    tracemalloc.start()
    data, _ = gather([b"x" * 10_000], codes, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(data) == 10_000_000 and most < 2 * len(data)


def test_words_that_come_back_after_a_million_others_are_not_merged_again():
    tool = bpe.Coder({bytes([b]): b for b in range(256)}, public_tokenizers.PATTERN)
    asked = []

    def compute(keys):
        asked.extend(keys)
        return [b""] * len(keys)

    for begin in range(0, 1_000_000, 100_000):
        tool.pieces.fill([f" {k}" for k in range(begin, begin + 100_000)], compute)
    tool.pieces.fill([" 7", " 99999", " 600000"], compute)
    assert len(asked) == len(set(asked)) == 1_000_000
