import random

import pytest

import plain
from patronage.llm import decontaminate


def contained(text, item):
    """Shared and all distinct shingles of the item; a short item counts where its words stand together."""
    wanted = plain.shingles(item)
    width = len(next(iter(wanted))) if wanted else 5
    words = (text or "").encode().lower().split()
    own = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
    return len(wanted & own), len(wanted)


def brute(docs, items):
    best = {}
    for i, text in docs:
        for j, item in items:
            if i is None or j is None or item is None:
                continue
            shared, size = contained(text, item)
            if size and 100 * shared >= 80 * size:
                best[i, j] = max(best.get((i, j), (0.0, 0, 0)), (shared / size, shared, size))
    return sorted((i, j, size, shared, ratio) for (i, j), (ratio, shared, size) in best.items())


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS item_id").repartition(4)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 AS doc_id")
    return sorted(tuple(r) for r in decontaminate.find(spark, d, i).collect())


def test_items_inside_long_documents(spark):
    source = random.Random(8)
    word = lambda: f"w{source.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(source.randrange(1, 90)))) for k in range(60)] + [(100, None), (101, ""), (102, "a b"), (102, "c d e f g h"), (None, "a b"), (103, "a b")]
    docs = []
    for k in range(120):
        words = [word() for _ in range(source.randrange(0, 600))]
        for _ in range(source.randrange(3)):
            part = (source.choice(items[:60])[1]).split()
            for _ in range(source.randrange(3)):
                part[source.randrange(len(part))] = "changed"
            if source.random() < 0.3:  # in two places
                half = len(part) // 2
                words = part[half - 4 if half > 4 else 0 :] + words + part[: half + 4]
            else:
                at = source.randrange(len(words) + 1)
                words[at:at] = part
        docs.append((k, " ".join(words).upper() if k % 5 == 0 else " \n".join(words)))
    docs += [(500, None), (501, ""), (502, "x a b y"), (502, "z"), (None, "a b"), (503, "A  B"), (504, "c d e f g h"), (504, "c d e f g h")]
    found = run(spark, docs, items)
    assert len(found) > 60 and found == brute(docs, items)


@pytest.mark.parametrize("size", range(1, 400, 7))
def test_a_signature_holds_more_than_an_item_may_miss(size):
    missing = size - -(-size * 80 // 100)
    assert missing < decontaminate.signature_size(size) <= size


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "q")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.find(spark, docs, items.limit(0)).count() == 0
    assert decontaminate.find(spark, docs.limit(0), items).count() == 0
    assert [r.doc_id for r in decontaminate.drop_contaminated(spark, docs, items).collect()] == [None]
