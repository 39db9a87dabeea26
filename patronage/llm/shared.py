"""Written intermediate tables, bitmaps of bounded size, and connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.session import remove, shared_dir


#: Spark's setting to delete the shuffle files of a query when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there, and any executor can read it.

    Nothing reads the shuffle files of the write again, so Spark is told to delete them at its end.
    """
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, table: DataFrame) -> None:
    """Delete the files of a table from ``stored`` that nothing reads again."""
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        remove(spark, folder)


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Which of 2**``bits`` places the top bits of the only column (64-bit hashes) fall on, as packed bits.

    Its size is fixed by ``bits`` alone; the more values, the fuller it gets, and what it lets pass
    must be checked by a join afterwards.
    """
    name = hashes.columns[0]
    place = F.shiftrightunsigned(F.col(name), 64 - bits)
    words = hashes.select((F.shiftright(place, 6)).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{name}`, {64 - bits}) & 63L AS int))").alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("word")).toArrow()
    out = np.zeros(1 << max(0, bits - 6), np.int64)
    out[rows["at"].to_numpy()] = rows["word"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = int(len(packed) * 64).bit_length() - 1
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (packed[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, component: for each node of an undirected graph (a, b: long) the smallest node it is joined with, by edges of any number.

    Large-star and small-star rounds: each links a node's neighbours to the smallest of them, until
    only stars are left: no node has two centres, or is a centre and has one. Edges never grow in number, and
    each round is written to the shared folder.
    NULL ends and loops are left out. A node of a very high degree is pre-aggregated to its minimum, and
    the join that hands the minimum out can be split by adaptive execution.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    pairs = stored(spark, pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("own"), F.lit(0).alias("centre")).union(pairs.select("b", F.lit(0), F.lit(1)))
        tangled = ends.groupBy("node").agg((F.sum("own") + F.max("centre")).alias("n")).agg(F.count_if(F.col("n") > 1)).first()[0]
        if not tangled:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(pairs.select("b", "b").distinct())
        last = pairs
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(lowest.select("a", "m"))
        pairs = stored(spark, small.distinct(), "edges")
        forget(spark, last)
