"""Near-duplicate vectors by lattice hashing: random projections to eight dimensions, decoded to points of the E8 lattice.

In each of several tables a vector belongs to the lattice point nearest to its projection, and is also
put to the neighbouring points nearest to it. Vectors that meet at a point which is the own point
of one of them are compared by their cosine in double precision; so no pair below the threshold is
linked. With the default parameters a pair at a cosine of exactly 0.9 meets with a probability above 0.99.

Equal vectors are one. A point with many vectors is cut into blocks, and each pair of blocks is a group
of its own, so a group has at most ``2 * BLOCK`` vectors whatever the point's size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.shared import components, stored
from patronage.llm.text import mix

TABLES = 10
PROBES = 4
SCALE = 0.6
BLOCK = 1024


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            found.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    found += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


NEIGHBOURS = _shortest()


def _even(points: np.ndarray) -> np.ndarray:
    """The nearest integer point with an even sum: round, and if the sum is odd, round the worst place the other way."""
    near = np.rint(points)
    rest = points - near
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(rest[odd]).argmax(axis=1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest(points: np.ndarray) -> np.ndarray:
    """The nearest point of E8: the better one of the integer points with even sum and those moved by one half."""
    whole, half = _even(points), _even(points - 0.5) + 0.5
    closer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def cells(vectors: np.ndarray, table: int, scale: float, probes: int) -> np.ndarray:
    """Keys of the own point and of the ``probes`` nearest of its neighbours, one row per vector of length one."""
    size = vectors.shape[1]
    projected = vectors @ (np.random.default_rng([table, size]).normal(size=(size, 8)) * scale)
    own = nearest(projected)
    side = (projected - own) @ NEIGHBOURS.T  # the larger, the nearer that neighbour
    best = np.argpartition(-side, probes - 1, axis=1)[:, :probes] if probes else np.zeros((len(own), 0), np.int64)
    points = np.concatenate((own[:, None, :], own[:, None, :] + NEIGHBOURS[best]), axis=1)
    key = np.full(points.shape[:2], table * 100_003 + size, np.uint64)
    for place in range(8):
        key = mix(key + (2 * points[:, :, place]).astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _unit(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and vectors of length one, for each number of dimensions."""
    edges = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values, np.float64)
    sizes = np.diff(edges)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        block = values[edges[rows][:, None] + np.arange(size)]
        block = block / np.abs(block).max(axis=1, keepdims=True)
        yield rows, block / np.sqrt((block * block).sum(axis=1, keepdims=True))


def _keys(batches: Iterator[pa.RecordBatch], tables: int, scale: float, probes: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 1000):
            batch = whole.slice(begin, 1000)
            ids, column = batch.column("id").to_numpy(), batch.column("vector")
            column = pa.array(column) if column.offset else column
            for rows, block in _unit(pa.concat_arrays([column])):
                for table in range(tables):
                    keys = cells(block, table, scale, probes)
                    home = np.zeros(keys.shape, bool)
                    home[:, 0] = True
                    owner = np.repeat(np.arange(len(rows)), keys.shape[1])
                    columns = {"cell": pa.array(keys.ravel()), "id": pa.array(ids[rows][owner]), "home": pa.array(home.ravel())}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Linked pairs of each group of a stream sorted by group."""
    held: list[pa.RecordBatch] = []
    now = None

    def compare() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, home, side = (table[c].to_numpy() for c in ("id", "home", "side"))
        vectors = np.zeros((len(ids), len(table["vector"][0])))
        for rows, block in _unit(table["vector"].combine_chunks() if isinstance(table["vector"], pa.ChunkedArray) else table["vector"]):
            vectors[rows] = block
        one, two = table["one"][0].as_py(), table["two"][0].as_py()
        left = np.flatnonzero(side == one)
        right = left if one == two else np.flatnonzero(side == two)
        found = (vectors[left] @ vectors[right].T >= threshold) & (home[left][:, None] | home[right]) & (ids[left][:, None] != ids[right])
        a, b = np.nonzero(found)
        a, b = ids[left[a]], ids[right[b]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if one == two:
            low, high = low[a < b], high[a < b]
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "one", "two")], axis=1)
        cuts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))).tolist()
        for start, end in zip(cuts, [*cuts[1:], len(keys)]):
            key = tuple(keys[start].tolist())
            if held and key != now:
                if len(held) > 1 or held[0].num_rows > 1:
                    yield compare()
                held = []
            now = key
            held.append(batch.slice(start, end - start))
    if held and (len(held) > 1 or held[0].num_rows > 1):
        yield compare()


def link(spark: SparkSession, vectors: DataFrame, threshold: float = 0.9, tables: int = TABLES, scale: float = SCALE, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding).

    Two vectors link if their cosine is ``threshold`` or more; n_links counts the other vectors linked
    directly, copies included. component_id is the smallest vec_id that links lead to, and kept says
    that it is the vector's own. A vector that is NULL, empty, zero, or has a NULL or non-finite component
    links with nothing; vectors of different lengths do not link. A row with a NULL vec_id has no
    links and no component and is not kept. Rows with the same vec_id and vector count as one.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = given.where("vec_id IS NOT NULL").where(F.coalesce(sound, F.lit(False))).distinct()
    own = stored(spark, rows.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "vectors")

    keys = own.select("id", "vector").mapInArrow(lambda it: _keys(it, tables, scale, probes), "cell long, id long, home boolean")
    # only points at which something can meet; of these, how many blocks. Ids travel first, vectors once
    met = keys.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("any_home")).where("n > 1 AND any_home")
    met = stored(spark, met.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "points")
    placed = keys.join(met, "cell").withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("cell", "id", "home", "side", other.alias("other"))
    grouped = placed.select("cell", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"), "side", "id", "home")
    floats = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    packed = own.select("id", F.col("vector").cast("array<float>").alias("vector") if floats else F.col("vector"))
    grouped = grouped.join(packed, "id").select("cell", "one", "two", "side", "id", "home", "vector")
    grouped = grouped.repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two")
    links = stored(spark, grouped.mapInArrow(lambda it: _pairs(it, threshold), "a long, b long").distinct(), "links")
    found = components(spark, links)
    both = links.union(links.select("b", "a"))
    sizes = own.select("id", "copies")
    degrees = both.join(sizes.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others"))
    named = sizes.join(degrees, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    named = own.select("id", "vector").join(named, "id").select(
        "vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    joined = given.join(named, "vector", "left")
    has_id = F.col("vec_id").isNotNull()
    component = F.when(has_id, F.coalesce("component", "vec_id"))
    return joined.select(
        "vec_id", F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
