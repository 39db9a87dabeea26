"""The corpus pipeline: five stages over the documents table, each written and read again before the next.

language ID, n-gram Jaccard join, suffix-array dedup, benchmark decontamination, byte-level BPE. Each
stage works on all rows that the one before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm import bpe, decontaminate, language_id, ngram_jaccard, suffix_dedup
from patronage.llm.shared import stored

#: A document stays if its language is told with at least this probability.
LEAST_SCORE = 0.5
#: Bytes of rows that Spark hands to a Python worker at once. Its default is 64 MB, which the executor's JVM and
#: its workers hold several times over; the stages work on 2 MB of text at a time anyway.
BATCH_BYTES = 4 << 20


def _in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with the session's setting for batches, which holds until its rows are written and stays."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@_in_small_batches
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: not ``und`` (no text or no letter), and with a score of ``LEAST_SCORE`` or more."""
    model = language_id.fit(docs.where(language_id.is_training()).select("text", "lang"))
    kept = language_id.identify(spark, docs, model).where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(docs.columns)


@_in_small_batches
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that Jaccard links of 0.8 or more lead to, the one with the smallest doc_id."""
    return ngram_jaccard.keep_first(spark, docs)


@_in_small_batches
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller doc_id also holds.

    Of a character that is cut in two, the bytes that are left go too, so that the text stays valid. A
    text that is cut has its new length as n_chars; a text that is cut away wholly is empty and stays a row.
    """
    found = suffix_dedup.remove_repeats(spark, docs, characters=True)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept").cast("string")).otherwise(F.col("text"))
    out = found.withColumn("text", text).withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


@_in_small_batches
def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.drop_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_in_small_batches
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of each document.

    The stages before leave more Python workers on an executor than run at once, and each comes to hold
    words, so fewer are remembered than where the operator runs alone.
    """
    return bpe.digests(spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, remember=30_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_items),
    ("byte_bpe", tokenize),
]

#: SQL cannot express the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return reduce(lambda rows, stage: stored(spark, stage[1](spark, rows, sf_dir), stage[0]), STAGES, docs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
