"""Phrases that occur more often than their parts suggest, by set-oriented mining (SETM) of occurrence relations.

A relation of length k has one row for each place where a phrase of k frequent words begins: piece, place,
and the words' codes. It is persisted in buckets by piece, sorted by piece and place. The next length is a
merge join of two such relations on piece and adjacent place, without an exchange; the phrases are counted,
the frequent ones kept as a table, and only their places go on (semi join) into the next relation. A
frequent phrase has only frequent parts, so nothing is lost.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.shared import stored
from patronage.session import remove, shared_dir

#: Rows of one bucket, on average; the number of buckets follows the number of words.
BUCKET_ROWS = 1 << 22
#: A table of frequent words or phrases with at most so many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1 << 21
UNKNOWN = "und"


def words_of(docs: DataFrame) -> DataFrame:
    """lang and piece: the stretches of words that no punctuation or line end breaks, lower-cased (A-Z), without blanks around."""
    text = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    pieces = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.explode(F.split(text, r"[.,;:!?\n-\r]")).alias("words"))
    return pieces.select("lang", F.btrim("words", F.lit(" \t")).alias("words")).where("words <> ''")


def _codes(length: int, begin: int = 1) -> list[str]:
    return [f"w{k}" for k in range(begin, begin + length)]


@contextmanager
def _merge_by_place(spark: SparkSession) -> Iterator[None]:
    """Within this block a join on piece and place may use that both sides lie in buckets by piece alone, each a sorted file.

    It only saves an exchange and a sort; a join planned without it gives the same rows.
    """
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class Relations:
    """Persisted occurrence relations, one bucketed table for each length, in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.names: list[tuple[str, str]] = []

    def persist(self, rows: DataFrame) -> DataFrame:
        """The rows (piece, place, codes) as a table in buckets by piece, sorted by piece and place."""
        name = f"setm_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark).rstrip('/')}/{name}"
        self.names.append((name, path))
        rows.write.format("parquet").option("path", path).bucketBy(self.buckets, "piece").sortBy("piece", "place").saveAsTable(name)
        return self.spark.table(name)

    def remove(self, keep: int = 0) -> None:
        """Drop all tables but the last ``keep``, with their files."""
        gone, self.names = (self.names[: len(self.names) - keep], self.names[len(self.names) - keep :])
        for name, path in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove(self.spark, path)


def _frequent_only(rows: DataFrame, frequent: DataFrame, on: list[str], how: str, buckets: int, most: int) -> DataFrame:
    """Join with a table of frequent items: broadcast up to ``most`` rows, else by a shuffle and back to the pieces' buckets."""
    if frequent.count() <= most:
        return rows.join(F.broadcast(frequent), on, how)
    return rows.join(frequent.hint("merge"), on, how).repartition(buckets, "piece")


def frequent_phrases(spark: SparkSession, docs: DataFrame, support: int = 10, longest: int = 3, most: int = BROADCAST_ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """All words (lang, word, f), and for each length 1 to ``longest`` the phrases with ``support`` occurrences or more.

    The tables of phrases have the codes w1, w2, ... and the count f; the first one also lang and word. A
    code belongs to one word of one language. All tables are written to the shared folder; the relations are
    deleted before this returns. A NULL text has no words; a NULL lang counts as ``und``.
    """
    pieces = words_of(docs)
    words = pieces.select("lang", F.explode(F.split("words", "[ \t]+")).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))
    words = stored(spark, words, "setm-words")
    tables = [stored(spark, words.where(F.col("f") >= support).withColumn("w1", F.monotonically_increasing_id()), "setm-frequent")]
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    buckets = max(spark.sparkContext.defaultParallelism, -(-total // BUCKET_ROWS))
    relations = Relations(spark, buckets)
    try:
        # the places travel as text, once, and are taken apart where they stay
        numbered = pieces.withColumn("piece", F.monotonically_increasing_id()).repartition(buckets, "piece")
        places = numbered.select("piece", "lang", F.posexplode(F.split("words", "[ \t]+")).alias("place", "word"))
        coded = _frequent_only(places, tables[0].select("lang", "word", "w1"), ["lang", "word"], "inner", buckets, most)
        relation = relations.persist(coded.select("piece", "place", "w1"))
        for length in range(2, longest + 1):
            # two phrases at neighbouring places share all words but their ends
            ahead = relation.select("piece", (F.col("place") - 1).alias("place"), F.col(f"w{length - 1}").alias(f"w{length}"))
            joined = relation.hint("merge").join(ahead, ["piece", "place"])
            with _merge_by_place(spark):
                counts = joined.groupBy(*_codes(length)).agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= support)
                tables.append(stored(spark, counts, "setm-frequent"))
                if length < longest:
                    kept = _frequent_only(joined, tables[-1].select(*_codes(length)), _codes(length), "left_semi", buckets, most)
                    relation = relations.persist(kept)
            relations.remove(keep=1)
    finally:
        relations.remove()
    return words, tables


def _count_of(rows: DataFrame, tables: list[DataFrame], begin: int, length: int, into: str) -> DataFrame:
    """``rows`` with the count of the ``length`` words from the ``begin``-th on."""
    names = _codes(length, begin)
    table = tables[length - 1].select(*[F.col(a).alias(b) for a, b in zip(_codes(length), names)], F.col("f").alias(into))
    return rows.join(table, names)


def exact_score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1,000,000 a a / (l r)) in whole numbers of 38 digits; counts up to 15 digits."""
    whole = lambda x: x.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (whole(a) * whole(a)), whole(l) * whole(r))


def _scored(tables: list[DataFrame], length: int) -> DataFrame:
    """The candidates of one length with a, l, r and score of their lowest-scoring cut."""
    rows = tables[length - 1]
    for cut in range(1, length):
        rows = _count_of(rows, tables, 1, cut, f"l{cut}")
        rows = _count_of(rows, tables, cut + 1, length - cut, f"r{cut}")
    cuts = [F.struct(exact_score(F.col("f"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, length)]
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.select(*_codes(length), F.col("f").alias("a"), lowest.alias("cut")).select(*_codes(length), "a", "cut.l", "cut.r", "cut.score")


def _without_parts(rows: DataFrame, tables: list[DataFrame], length: int, share: int) -> DataFrame:
    """Candidates that lie in no longer one with ``share`` percent of their count or more."""
    inside = [
        tables[more - 1].select(*[F.col(a).alias(b) for a, b in zip(_codes(length, at), _codes(length))], F.col("f").alias("_more"))
        for more in range(length + 1, len(tables) + 1)
        for at in range(1, more - length + 2)
    ]
    if not inside:
        return rows
    most = reduce(DataFrame.unionByName, inside).groupBy(*_codes(length)).agg(F.max("_more").alias("_more"))
    return rows.join(most, _codes(length), "left").where(F.coalesce(F.col("_more") * 100 < F.col("a") * share, F.lit(True))).drop("_more")


def mine(spark: SparkSession, docs: DataFrame, support: int = 10, longest: int = 3, share: int = 50, top: int = 2000, most: int = BROADCAST_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of 2 to ``longest`` words.

    ``docs`` has text and lang; other columns are not read. a counts the phrase, l and r the two parts of its
    lowest-scoring cut (the first of equal ones), n all words of the language. Phrases that lie in a longer one
    with ``share`` percent of their count are left out. Order: score, count, then the phrase by its UTF-8 bytes.
    Repeated rows count as often as they occur; NULL and empty texts and empty tables give no phrase. The result
    is written to the shared folder.
    """
    words, tables = frequent_phrases(spark, docs, support, longest, most)
    phrases = []
    for length in range(2, longest + 1):
        rows = _without_parts(_scored(tables, length), tables, length, share)
        for place in range(1, length + 1):
            name = tables[0].select(F.col("w1").alias(f"w{place}"), F.col("word").alias(f"word{place}"), *(["lang"] if place == 1 else []))
            rows = rows.join(name, f"w{place}")
        phrases.append(rows.select("lang", F.concat_ws(" ", *[f"word{k}" for k in range(1, length + 1)]).alias("phrase"), "a", "l", "r", "score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = reduce(DataFrame.unionByName, phrases).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    out = ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return stored(spark, out, "setm-phrases")
