"""One named query per operator, over its whole table. Each digest column is derived from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from patronage.llm import bpe, collocations, decontaminate, language_id, lattice_dedup, license_scan, lm_score, ngram_jaccard, periodic_runs, piece_bpe, suffix_dedup, token_files, url_filter
from patronage.llm.oracle import ORACLE


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document, learned from four fifths of the labelled ones."""
    docs = _table(spark, folder, "documents")
    model = language_id.fit(docs.where(language_id.is_training()).select("text", "lang"))
    found = language_id.identify(spark, docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~language_id.is_training()).alias("held_out"), "lang_pred", "score")


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(spark, _table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document under the word counts and the language model of six sevenths of them."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model, counts = lm_score.fit(spark, docs.where(lm_score.is_training()))
    found = lm_score.score(spark, docs, model, counts)
    return found.withColumn("held_out", ~lm_score.is_training())


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose five-word shingle sets are similar by 0.8 or more."""
    return ngram_jaccard.link(spark, _table(spark, folder, "documents"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and detections in every document."""
    return license_scan.scan(_table(spark, folder, "documents")).drop("detections")


def op6_lattice_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.9 or more."""
    return lattice_dedup.link(spark, _table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document written to Simple-8b files and read back."""
    return token_files.write_and_read(spark, _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, special=True)


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page's URL by the base rules, else by the extra globs."""
    return url_filter.judge(_table(spark, folder, "pages").select("page_id", "url"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with every benchmark item of which it has four fifths of the five-word shingles or more."""
    return decontaminate.find(spark, _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without the 50-byte strings that a smaller doc_id also holds."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(spark, docs)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return found.select("doc_id", size.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """SentencePiece ids of every document, compared with the library, and the texts they decode to, as digests."""
    return piece_bpe.digests(spark, _table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Repeating stretches of words in every document, with periods planted in a tenth of them."""
    docs = periodic_runs.with_planted(_table(spark, folder, "documents").select("doc_id", "text"))
    best = periodic_runs.strongest(F.col("runs"))
    found = periodic_runs.find(docs).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.as_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 phrases of two or three words of each language that stand out most from their parts' counts."""
    return collocations.mine(spark, _table(spark, folder, "documents").select("text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_lm_score": op3_lm_score,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_license_scan": op5_license_scan,
    "op6_lattice_dedup": op6_lattice_dedup,
    "op7_token_files": op7_token_files,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: ORACLE[name].strip() for name in QUERIES if name in ORACLE}
