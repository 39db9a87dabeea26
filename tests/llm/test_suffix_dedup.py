import os
import random

import numpy as np
import pytest

import plain
from patronage.llm import suffix_dedup, suffix_runs

FOLDER = "/root/testdata/sf0.01"


def found(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(spark, docs).collect())


def patchwork(seed, count):
    source = random.Random(seed)
    shared = ["".join(source.choice("abcdé \n") for _ in range(source.randrange(30, 160))) for _ in range(12)]
    rows = []
    for k in range(count):
        parts = [source.choice(shared) if source.random() < 0.5 else "".join(source.choice("abcdefgh ") for _ in range(source.randrange(5, 120))) for _ in range(source.randrange(6))]
        rows.append((source.randrange(10**6) * 1000 + k, "".join(parts)))
    return rows


def test_spans_are_those_of_all_windows(spark, layout):
    assert found(spark, patchwork(1, 150)) == plain.without_repeats(patchwork(1, 150))


def test_runs_of_one_character_and_edges(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RUN", 100)
    line = "x" * 49
    rows = [(9, "-" * 300), (4, "-" * 200 + "end"), (5, "-" * 49), (1, None), (2, ""), (3, line), (6, line + "y"), (7, line + "y"), (8, "é" * 40), (10, "é" * 25), (11, "a\0" * 40), (12, "a\0" * 30 + "b"), (13, "\0" * 60), (14, "\0" * 51)]
    assert found(spark, rows) == plain.without_repeats(rows)


def test_a_passage_in_many_texts_and_many_copies(spark):
    source = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, f"{k}{source.random()}" + passage + f"{source.random()}") for k in range(300)] + [(1000 + k, passage * 3) for k in range(40)]
    assert found(spark, rows) == plain.without_repeats(rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_some_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == plain.without_repeats(rows)


def test_columns_rows_and_nulls(spark):
    text = "".join(chr(97 + k % 26) for k in range(80))
    rows = [(1, text, "x"), (1, text, "x"), (None, text, "y"), (2, text + "!", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = suffix_dedup.remove_repeats(spark, docs)
    assert out.columns == ["doc_id", "text", "kept", "n_removed", "n_spans"]
    assert sorted((r.doc_id or 0, bytes(r.kept).decode(), r.n_removed) for r in out.collect()) == [(0, text, 0), (1, text, 0), (1, text, 0), (2, "!", 80)]
    assert suffix_dedup.remove_repeats(spark, docs.limit(0)).count() == 0


def test_loser_tree_and_blocks():
    source = np.random.default_rng(2)
    runs = []
    for size in (0, 1, 5, 40, 40, 7):
        words = sorted(bytes(source.integers(97, 99, source.integers(0, 12)).astype(np.uint8)) for _ in range(size))
        runs.append((words, [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(words, words[1:])]))
    at, out, shared = [0] * len(runs), [], []

    def source(k):
        def head(before):
            words, common = runs[k]
            if at[k] == len(words):
                return b"", -1
            at[k] += 1
            assert not before or before == words[at[k] - 2]
            return words[at[k] - 1], common[at[k] - 1]

        return head

    for run, common in suffix_runs.merge([source(k) for k in range(len(runs))]):
        out.append(runs[run][0][at[run] - 1])
        shared.append(common)
    words = sorted(w for r in runs for w in r[0])
    assert out == words
    assert shared[1:] == [len(os.path.commonprefix([a, b])) for a, b in zip(words, words[1:])]
    assert list(suffix_runs.merge([])) == []
