"""Phrases against a plain count of all n-grams."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import pytest
from pyspark.sql import functions as F

from patronage.llm import collocations


def plain(rows, support, longest, share, top):
    counts = defaultdict(Counter)
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in range(1, longest + 1):
                for k in range(len(words) - n + 1):
                    counts["und" if lang is None else lang][tuple(words[k : k + n])] += 1
    out = []
    for lang, f in counts.items():
        total = sum(c for w, c in f.items() if len(w) == 1)
        rows = []
        candidates = [w for w, c in f.items() if len(w) > 1 and c >= support]
        for w in candidates:
            a = f[w]
            if any(len(x) > len(w) and 100 * f[x] >= share * a and any(x[k : k + len(w)] == w for k in range(len(x))) for x in candidates):
                continue
            cuts = [(floor(Fraction(10**6 * a * a, f[w[:k]] * f[w[k:]])), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(w).encode(), a, f[w[:k]], f[w[k:]]))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), a, l, r, total, -score))
    return sorted(out)


def rows_of(seed, count=150):
    draw = random.Random(seed)
    words = ["a", "B", "c", "dé", "漢", "É", "E", "\x00", "x" * 90]
    weights = [9, 6, 5, 4, 3, 2, 2, 1, 1]
    make = lambda: "".join(draw.choices(words, weights)[0] + draw.choice([" ", " ", "\t", "  ", ". ", "\n", " ", ";"]) for _ in range(draw.randrange(60)))
    return [(make(), draw.choice(["en", "en", "fr", None, ""])) for _ in range(count)]


def found(rows):
    return sorted(map(tuple, rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize("most", [1 << 21, 0], ids=["broadcast", "shuffle"])
@pytest.mark.parametrize("longest, top", [(3, 2000), (4, 7)])
def test_phrases_equal_a_plain_count(spark, most, longest, top):
    rows = rows_of(longest) + [(None, "en"), ("", None), (" . \t,", "de")]
    rows += rows[:20]  # repeated rows count again
    docs = spark.createDataFrame([(t, l, 1, "x") for t, l in rows], "text string, lang string, w1 int, piece string").repartition(5)
    expected = plain(rows, 5, longest, 50, top)
    assert len(expected) > 25
    assert found(collocations.mine(spark, docs, 5, longest, 50, top, most)) == expected


def test_one_hot_piece_and_pieces_of_one_word(spark):
    rows = [("a b " * 3000, "en"), ("a", "en"), ("b a", "en")] + [("a\nb", "fr")] * 50
    assert found(collocations.mine(spark, spark.createDataFrame(rows, "text string, lang string"))) == plain(rows, 10, 3, 50, 2000)


def test_no_rows_and_no_phrases(spark):
    docs = spark.createDataFrame([("one two three", "en"), (None, None)], "text string, lang string")
    assert found(collocations.mine(spark, docs)) == []
    assert found(collocations.mine(spark, docs.limit(0))) == []


def test_scores_beyond_64_bits(spark):
    row = spark.range(1).select(collocations.exact_score(F.lit(3_999_999_999_999), F.lit(4_000_000_000_000), F.lit(7_000_000_000_001)).alias("s")).first()
    assert row.s == 10**6 * 3_999_999_999_999**2 // (4_000_000_000_000 * 7_000_000_000_001)


def test_the_merge_join_needs_no_exchange_and_tables_go(spark):
    before = {t.name for t in spark.catalog.listTables()}
    docs = spark.createDataFrame(rows_of(9), "text string, lang string")
    relations = collocations.Relations(spark, 4)
    rows = relations.persist(spark.range(1000).select((F.col("id") % 7).alias("piece"), F.col("id").alias("place"), F.lit(1).alias("w1")))
    ahead = rows.select("piece", (F.col("place") - 1).alias("place"), F.col("w1").alias("w2"))
    with collocations._merge_by_place(spark):
        plan = rows.hint("merge").join(ahead, ["piece", "place"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    relations.remove()
    collocations.mine(spark, docs)
    assert {t.name for t in spark.catalog.listTables()} == before
