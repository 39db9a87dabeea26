"""Runs of words against a search that tries every period at every place."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from patronage.llm import periodic_runs, queries


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(draw):
    kinds, out = draw.choice([1, 2, 2, 3, 5]), []
    for _ in range(draw.randrange(1, 6)):
        block = [draw.randrange(kinds) for _ in range(draw.randrange(1, 9))]
        out += [draw.randrange(kinds) for _ in range(draw.randrange(20))] if draw.random() < 0.5 else block * draw.randrange(1, 9) + block[: draw.randrange(9)]
    return out


def test_runs_equal_every_period_tried():
    draw = random.Random(1)
    for _ in range(400):
        docs = [repetitive(draw) if draw.random() > 0.1 else [] for _ in range(draw.randrange(1, 8))] + [[0, 1]]
        edges = np.cumsum([0, *map(len, docs)])
        found = [[] for _ in docs]
        for d, *run in zip(*periodic_runs.runs_of(np.array([w for doc in docs for w in doc]), edges)):
            found[d].append(tuple(map(int, run)))
        assert found == [plain_runs(doc) for doc in docs]


@pytest.mark.parametrize("back", [False, True])
def test_common_extensions(back):
    draw = random.Random(2)
    words = [0] * 30 + [draw.randrange(2) for _ in range(300)] + [0, 1] * 40 + [0] * 30
    symbols = np.array([2, *words, 3, *words, 4])
    grammar = periodic_runs.Grammar(symbols, np.array([0, len(words) + 1, 2 * len(words) + 2]))
    assert len(grammar.levels) > 5
    pairs = np.array([(x, y) for x, y in (draw.sample(range(1, len(symbols) - 1), 2) for _ in range(3000))])
    way = -1 if back else 1
    for (x, y), count in zip(pairs, grammar.common(pairs[:, 0], pairs[:, 1], back)):
        size = 0
        while symbols[x + way * size] == symbols[y + way * size]:
            size += 1
        assert count == size


def test_a_very_long_text():
    words = np.concatenate((np.arange(1000), np.arange(200_000) % 7 + 5, np.arange(1000)))
    found = periodic_runs.runs_of(words, np.array([0, len(words)]))
    # the planted run takes in the neighbours that fit
    assert [len(x) for x in found] == [1, 1, 1, 1] and found[3][0] == 7 and found[2][0] >= 200_000


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(5)
    rows = [(k, "".join(draw.choice("abé漢") + draw.choice([" ", " ", "\n", "\t ", "\x1f ", "x "]) for _ in range(draw.randrange(80))), "l") for k in range(400)]
    rows += [(1000 + k, " ".join(map(str, repetitive(draw))), "l") for k in range(200)]
    rows += [(None, "a a a a a a a", None), (500, None, "l"), (501, "", "l"), (502, " \t\n\x0b\x0c\r", "l"), (7, rows[7][1], "l"), (503, "x " * 5000, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = []
    for doc_id, text, _ in rows:
        words = planted(doc_id, (text or "").encode().split())
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        out = plain_collapse(words, runs)
        milli = 1000 * best[1] // best[2] if runs else None
        expected.append((doc_id, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(out).hexdigest()))
    key = lambda row: str(tuple(row))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    assert sum(row[1] for row in expected) > 100
    kept = periodic_runs.find(docs)
    assert kept.columns == ["doc_id", "text", "runs", "collapsed"] and kept.count() == len(rows)
    assert periodic_runs.find(docs.limit(0)).count() == 0
