import hashlib
import os
import re

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
import plain
from patronage.llm import bpe

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def steps(spark):
    """The rows that each stage returned, by its name; documents under ''."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "x", 0), (10**6 + 1, "12 34", None, None, None), (10**6 + 2, "", "de", "x", 0)], docs.schema)
    kept = {"": docs.union(extra).collect()}
    rows = docs.union(extra)
    for name, stage in corpus_pipeline.STAGES:
        rows = corpus_pipeline.stored(spark, stage(spark, rows, FOLDER), name)
        kept[name] = rows.collect()
        if name != "byte_bpe":
            assert rows.columns == docs.columns
    return kept


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_language_id_rejects_texts_without_letters_only(steps):
    gone = set(by_id(steps[""])) - set(by_id(steps["language_id"]))
    assert {10**6, 10**6 + 1, 10**6 + 2} <= gone
    assert all(not any(c.isalpha() for c in by_id(steps[""])[i].text or "") for i in gone)


def test_one_of_each_group_stays(steps):
    given = steps["language_id"]
    found = plain.jaccard_links([(r.doc_id, r.text) for r in given])
    assert set(by_id(steps["ngram_jaccard_join"])) == {i for i, (_, c) in found.items() if i == c}
    assert all(by_id(given)[r.doc_id] == r for r in steps["ngram_jaccard_join"])


def test_passages_are_cut(steps):
    given, found = steps["ngram_jaccard_join"], by_id(steps["suffix_array_dedup"])
    for i, kept, removed, _ in plain.without_repeats([(r.doc_id, r.text) for r in given]):
        assert found[i].text == kept.decode("utf-8", "ignore")
        assert not removed or found[i].n_chars == len(found[i].text)


def test_documents_with_items_go(spark, steps):
    items = [plain.shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for r in steps["suffix_array_dedup"]:
        own = plain.shingles(r.text)
        assert (r.doc_id in by_id(steps["benchmark_decontamination"])) == (not any(100 * len(x & own) >= 80 * len(x) for x in items))


def test_tokens(steps):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(steps["byte_bpe"])
    assert set(found) == set(by_id(steps["benchmark_decontamination"]))
    for r in steps["benchmark_decontamination"]:
        assert list(found[r.doc_id].ids) == own.encode_ordinary(r.text or "")
        assert found[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_a_worker_gives_memory_back_when_its_texts_are_read(monkeypatch):
    from patronage.llm import text

    calls = []
    monkeypatch.setattr(text, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["some words", None, ""]})
    read = text.slices(iter([batch, batch]))
    assert next(read)[0].num_rows == 3 and not calls
    assert len(list(read)) == 1 and calls == [1]


def test_stages_hand_small_batches_to_one_python_worker_a_task(spark):
    """Chained Python steps take a worker each, and an executor keeps them all."""
    rows = [(k, "ä" * 30 + f"{k} " + "ö" * 30 * (k % 2), "en", "x", 0) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.cut_repeated_passages(spark, docs, "")
    assert set(re.findall(r"ArrowEvalPython \[(\w+)\(", cut._jdf.queryExecution().optimizedPlan().toString())) == {"touched"}
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}[2] == ("2 ", 2)
    assert all(f.__wrapped__ for _, f in corpus_pipeline.STAGES)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    wide = spark.range(0, 100, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    assert max(r.n for r in wide.mapInArrow(sizes, "n long").collect()) < 2 * corpus_pipeline.BATCH_BYTES
