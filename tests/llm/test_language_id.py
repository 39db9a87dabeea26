import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm import language_id, queries

FOLDER = "/root/testdata/sf0.01"
ENGLISH, GERMAN = "the cat and the dog with this thing", "der hund und die katze mit dem ding"


def train(spark, rows):
    return language_id.fit(spark.createDataFrame(rows, "text string, lang string"))


def test_grams_are_those_of_each_text(monkeypatch):
    texts = ["abc", "", "é日🙂x", "a", "zz" * 40]
    expected = Counter((row, text[k : k + n]) for row, text in enumerate(texts) for n in language_id.ORDERS for k in range(len(text) - n + 1))
    by_size = {}
    for segment in (4, 1 << 19):
        monkeypatch.setattr(language_id, "SEGMENT", segment)
        found = Counter()
        data, offsets = language_id.slices.__globals__["texts"](pa.array(texts))
        for codes, rows, own in language_id._segments(data, offsets):
            for order in language_id.ORDERS:
                buckets, owner = language_id._buckets(codes, rows, own, order, 1 << 30)
                found.update(zip(owner.tolist(), buckets.tolist()))
        by_size[segment] = found
        assert sorted(found.values()) == sorted(expected.values())
    assert by_size[4] == by_size[1 << 19]


def test_predictions_and_edge_cases(spark):
    model = train(spark, [(ENGLISH, "en")] * 3 + [(GERMAN, "de")] * 3 + [(None, "xx"), ("no label", None)])
    assert model["names"] == ["de", "en"]
    rows = [(1, "this and that with the thing", 5), (2, "die katze und der hund", 5), (3, None, 5), (4, "", 5), (5, "123 !?", 5), (1, "this and that with the thing", 5), (None, "mit dem ding " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = language_id.identify(spark, docs, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    got = sorted((r.doc_id or 0, r.lang_pred) for r in found.collect())
    assert got == [(0, "de"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und")]
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in found.collect())
    assert language_id.identify(spark, docs.limit(0), model).count() == 0


def test_a_tie_and_no_training_rows(spark):
    tied = train(spark, [("same words", "b"), ("same words", "a")])
    docs = spark.createDataFrame([(1, "same words")], "doc_id long, text string")
    row = language_id.identify(spark, docs, tied).first()
    assert (row.lang_pred, row.score) == ("a", pytest.approx(0.5))
    nothing = language_id.fit(docs.selectExpr("text", "cast(null as string) AS lang"))
    assert tuple(language_id.identify(spark, docs, nothing).select("lang_pred", "score").first()) == ("und", 0.0)


def test_scores_are_those_of_the_formula(spark):
    model = train(spark, [(ENGLISH, "en"), (ENGLISH, "en"), (GERMAN, "de")])
    text = "the ding with katze"
    total = np.array(model["prior"])
    data, offsets = language_id.slices.__globals__["texts"](pa.array([text]))
    for codes, rows, own in language_id._segments(data, offsets):
        for order in language_id.ORDERS:
            for bucket in language_id._buckets(codes, rows, own, order, language_id.BUCKETS)[0]:
                total = total + model["weights"][bucket]
    row = language_id.identify(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.score == pytest.approx(np.exp(total.max() - np.log(np.exp(total - total.max()).sum()) - total.max()), rel=1e-6)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_held_out_accuracy(spark):
    found = queries.op1_language_id(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
