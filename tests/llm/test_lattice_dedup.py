import itertools

import numpy as np

import plain
from patronage.llm import lattice_dedup


def brute(rows):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    linked = []
    for (a, x), (b, y) in itertools.combinations(good, 2):
        if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
            linked.append((a, b))
    found = plain.components([i for i, _ in rows], linked)
    return sorted((i, sum(i in p for p in linked), found[i], found[i] == i) for i, _ in rows)


def found(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    return sorted(tuple(r) for r in lattice_dedup.link(spark, vectors).collect())


def some(seed, groups, copies, noise, size=32):
    source = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        center = source.normal(size=size)
        for _ in range(copies):
            out.append((len(out), [float(np.float32(x)) for x in center + noise * source.normal(size=size)]))
    return out


def test_decoding_finds_the_nearest_point():
    points = np.random.default_rng(1).normal(size=(300, 8)) * 2
    near = lattice_dedup.nearest(points)
    assert (np.rint(2 * near) == 2 * near).all() and ((near.sum(axis=1) % 2) == 0).all()
    others = ((points[:, None, :] - near[:, None, :] - lattice_dedup.NEIGHBOURS) ** 2).sum(axis=2).min(axis=1)
    assert (((points - near) ** 2).sum(axis=1) <= others + 1e-9).all()


def test_links_of_groups_and_of_faulty_vectors(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK", 16)
    rows = some(1, 20, 6, 0.1) + [(1000, [1.0] * 32), (1001, [1.0] * 32), (1002, [2.0] * 32), (1003, [1.0] * 31)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [1.0] * 31 + [None]), (2004, [1.0] * 31 + [float("nan")]), (2005, [float("inf")] * 32)]
    assert found(spark, rows) == brute(rows)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK", 32)
    rows = some(2, 1, 150, 0.15) + [(500 + k, v) for k, v in some(3, 40, 1, 0)]
    assert found(spark, rows) == brute(rows)


def test_recall_at_the_threshold(spark):
    source = np.random.default_rng(4)
    rows = []
    for k in range(400):
        x, z = source.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        y = 0.901 * x + np.sqrt(1 - 0.901**2) * z / np.linalg.norm(z)
        rows += [(2 * k, x.tolist()), (2 * k + 1, y.tolist())]
    hits = sum(r[1] > 0 for r in found(spark, rows)) / 800
    assert hits >= 0.97
    assert all(r[1] <= 1 for r in found(spark, rows))


def test_nulls_and_no_rows(spark):
    vectors = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2)], "vec_id long, embedding array<float>, kept int")
    assert sorted(lattice_dedup.link(spark, vectors).collect(), key=str) == [(1, 0, 1, True), (1, 0, 1, True), (None, 0, None, False)]
    assert lattice_dedup.link(spark, vectors.limit(0)).count() == 0
