import glob
import os
import random
import time

import pyarrow as pa
import pytest

import plain
from patronage.llm import ngram_jaccard, shared
from patronage.llm.shared import components, stored
from patronage.session import shared_dir

FOLDER = "/root/testdata/sf0.01"


def families(seed, groups, copies, words):
    """Texts around a few originals, changed by up to a third, so that many pairs are close to the threshold."""
    source = random.Random(seed)
    rows = []
    for _ in range(groups):
        size = source.randrange(1, words)
        base = [f"w{source.randrange(10**6)}" for _ in range(size)]
        for _ in range(copies):
            text = list(base)
            for _ in range(source.choice((0, 0, 1, 1, 2, 3, size // 40, size // 25))):
                text[source.randrange(len(text))] = f"v{source.randrange(50)}"
            rows.append((len(rows), " ".join(text)))
    source.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.link(spark, docs).collect()}
    assert found == plain.jaccard_links(rows)


@pytest.mark.parametrize("least", [64, 3])
def test_links_are_those_of_all_pairs(spark, monkeypatch, least):
    monkeypatch.setattr(ngram_jaccard, "LEAST_FREQUENT", least)
    check(spark, families(1, 25, 12, 120) + [(1000 + k, t) for k, t in enumerate(("a b", "A  b", "a", None, "", " \n", "a b c d e", "a b c d e", "a b c d e f"))])


def test_a_large_group_of_near_copies_of_frequent_tokens(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "LEAST_FREQUENT", 5)
    check(spark, families(2, 2, 150, 90))


@pytest.mark.parametrize("copies", [800, 2000])
def test_near_copies_are_compared_in_linear_number(spark, monkeypatch, copies):
    source, rows, counted = random.Random(4), [], {"pairs": 0, "links": 0}
    base = [f"w{k}" for k in range(300)]
    for k in range(copies):
        text = list(base)
        for _ in range(source.randrange(4)):  # any two of them link
            text[source.randrange(300)] = f"v{source.randrange(10**6)}"
        rows.append((k, " ".join(text)))

    def counting(session, table, name):
        out = shared.stored(session, table, name)
        if name in counted:
            counted[name] += out.count()
        return out

    monkeypatch.setattr(ngram_jaccard, "stored", counting)
    found = ngram_jaccard.link(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.component_id for r in found} == {0}
    assert counted["pairs"] <= 4 * copies and counted["links"] <= 3 * copies, counted


def test_a_passage_in_many_texts_links_nothing(spark):
    source = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, passage + " " + " ".join(f"{k}x{source.randrange(10**6)}" for _ in range(60))) for k in range(200)]
    check(spark, rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_all_documents(spark, layout):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_columns_rows_and_nulls(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "y"), (2, "A b c d e f", None), (3, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_jaccard.link(spark, docs).collect())
    assert found == [(0, 2, None), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    kept = ngram_jaccard.keep_first(spark, docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 3]
    assert ngram_jaccard.link(spark, docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (None, 3), (300, 299), (300, 299)]
    found = {r.node: r.component for r in shared.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 61)}, **{k: 100 for k in range(100, 150)}, 299: 299, 300: 299}


def test_only_sets_of_pairs_are_written_and_tables_are_deleted(spark, monkeypatch):
    """Texts that share one passage but do not link are in open entries, yet their sets are not written."""
    source, written, paths = random.Random(6), [], {}
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(k, passage + " " + " ".join(f"{k}x{source.randrange(10**6)}" for _ in range(60))) for k in range(200)]
    rows += [(1000 + k, " ".join(f"y{j}" for j in range(60)) + f" z{k}") for k in range(3)]

    def noting(session, table, name):
        out = shared.stored(session, table, name)
        written.append(out.count() if name == "sets" else 0)
        paths.setdefault(name, []).extend(p.removeprefix("file:").replace("//", "") for p in out.inputFiles())
        return out

    monkeypatch.setattr(ngram_jaccard, "stored", noting)
    found = {r.doc_id: r.component_id for r in ngram_jaccard.link(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found == {**{k: k for k in range(200)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert sum(written) < 50, written
    for name in ("sets", "ids", "entries"):
        assert paths[name] and not any(map(os.path.exists, paths[name])), name


def entry_rows(entries, nodes):
    """Rows of index entries, each with all ``nodes`` (fp, label, sketch word)."""
    rows = [(entry, fp, 100 << 32 | 1, label, *[word] * ngram_jaccard.SKETCH) for entry in entries for fp, label, word in nodes]
    names = ["entry", "fp", "info", "label", *ngram_jaccard._BITS]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def test_a_pair_met_in_many_entries_is_given_out_once(monkeypatch):
    nodes = [(1, 1, 0), (2, 1, 0), (3, 3, 0), (4, 4, 0)]
    parts = [entry_rows(range(a, a + 5), nodes) for a in (100, 50, 0)]  # entries need not ascend
    for held in (1_000_000, 7):
        monkeypatch.setattr(ngram_jaccard, "HELD", held)
        out = [row for batch in ngram_jaccard._cross_pairs(iter(parts), 80) for row in batch.to_pylist()]
        sums = {}
        for row in out:
            sums[row["a"], row["b"]] = sums.get((row["a"], row["b"]), 0) + row["n"]
        assert sums == {pair: 15 for pair in [(1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]}
        assert held == 7 or len(out) == 5
    assert list(ngram_jaccard._cross_pairs(iter([]), 80)) == []


def shared_folders(spark, name):
    return set(glob.glob(f"{shared_dir(spark).removeprefix('file://').rstrip('/')}/{name}-*"))


def test_tables_of_components_and_shuffle_files_go_when_nothing_reads_them(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before, kept = shuffled(), shared_folders(spark, "edges")
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b").repartition(5)
    found = components(spark, chain)
    assert {(r.node, r.component) for r in found.collect()} == {(k, 0) for k in range(41)}
    assert len(shared_folders(spark, "edges") - kept) == 1
    before = shuffled()
    stored(spark, chain.groupBy("a").count(), "shuffled")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before


def test_components_writes_stars_once_and_later_rounds_work_on_components_only(spark, monkeypatch):
    writes, given = [], []

    def noting(session, table, name):
        writes.append(name)
        return stored(session, table, name)

    monkeypatch.setattr(shared, "stored", noting)
    stars = spark.createDataFrame([(c, c + k) for c in (1, 100) for k in range(1, 9)], "a long, b long")
    assert {(r.node, r.component) for r in components(spark, stars).collect()} == {(c + k, c) for c in (1, 100) for k in range(9)}
    assert len(writes) == 1, writes

    def counting(session, edges):
        given.append(edges.count())
        return components(session, edges)

    monkeypatch.setattr(ngram_jaccard, "components", counting)
    text = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join([f"v{k}" if j == 7 * k else w for j, w in enumerate(text)])) for k in range(40)]
    found = {r.component_id for r in ngram_jaccard.link(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0}
    assert all(n < given[0] for n in given[1:-1]), given
