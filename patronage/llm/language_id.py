"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in every task and adds them up with one small shuffle; the
matrix of log-probabilities (languages x buckets) is the only thing that reaches the driver and is
broadcast. Its size is fixed by ``buckets`` and the number of languages and is checked before use.
Scoring treats a slice of texts as a sparse row-by-bucket matrix and multiplies it with that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.text import mix, slices

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"
MODEL_BYTES = 256 << 20
SEGMENT = 1 << 19


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Code points, their rows, and how many of them may start an n-gram, a bounded number at a time.

    A segment also holds the first characters of the next one, in which its last n-grams end, so
    that a text of any length is counted whole and each n-gram once.
    """
    look = max(ORDERS) - 1
    leads = (data & 0xC0) != 0x80
    at = np.concatenate((np.flatnonzero(leads), [len(data)]))
    rows = np.searchsorted(offsets, at[:-1], "right") - 1
    for begin in range(0, len(at) - 1, SEGMENT):
        end = min(begin + SEGMENT, len(at) - 1)
        stop = min(end + look, len(at) - 1)
        codes = np.frombuffer(data[at[begin] : at[stop]].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        yield codes, rows[begin:stop], end - begin


def _buckets(codes: np.ndarray, rows: np.ndarray, own: int, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of the n-grams that start at one of the first ``own`` characters and stay in their row."""
    count = min(own, len(codes) - order + 1)
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.full(count, order, np.uint64)
    for place in range(order):
        key = key * np.uint64(0x100000001B3) + codes[place : place + count]
    inside = rows[:count] == rows[order - 1 : order - 1 + count]
    return (mix(key[inside]) % np.uint64(buckets)).astype(np.int64), rows[:count][inside]


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch, data, offsets in slices(batches):
        labels = batch.column("lang").to_pylist()
        names = sorted(set(labels))
        index = np.array([names.index(x) for x in labels], np.int64)
        sums = np.zeros((len(names), buckets), np.int64)
        for codes, rows, own in _segments(data, offsets):
            for order in ORDERS:
                bucket, row = _buckets(codes, rows, own, order, buckets)
                sums += np.bincount(index[row] * buckets + bucket, minlength=sums.size).reshape(sums.shape)
        for name, counted in zip(names, sums):
            totals[name] = totals.get(name, 0) + counted
    for name, counted in totals.items():
        used = np.flatnonzero(counted)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counted[used])], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, buckets: int = BUCKETS, smoothing: float = 0.5) -> dict:
    """Log-probabilities of hashed n-grams for each language of all rows of ``labelled`` (text, lang).

    Rows whose text or lang is NULL are ignored. The prior is the share of rows of a language.
    The model holds languages x buckets numbers; above ``MODEL_BYTES`` of them it raises.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", F.lower("text").alias("text"))
    priors = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MODEL_BYTES // (4 * buckets) + 1).collect())
    if len(priors) * buckets * 4 > MODEL_BYTES:
        raise ValueError("languages x buckets exceed MODEL_BYTES: use fewer buckets")
    counted = rows.mapInArrow(lambda it: _count(it, buckets), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = [name for name, _ in priors]
    matrix = np.zeros((len(names), buckets))
    if names:
        table = counted.toArrow()
        place = {name: k for k, name in enumerate(names)}
        matrix[np.array([place[x] for x in table["lang"].to_pylist()], np.int64), table["bucket"].to_numpy()] = table["n"].to_numpy()
    weights = np.log((matrix + smoothing) / (matrix.sum(axis=1, keepdims=True) + smoothing * buckets))
    prior = np.log(np.array([n for _, n in priors], float) / max(1, sum(n for _, n in priors)))
    return {"names": names, "weights": np.ascontiguousarray(weights.T.astype(np.float32)), "prior": prior}


def _score(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    weights, prior, names = model["weights"], model["prior"], np.array([*model["names"], UNKNOWN], object)
    for batch, data, offsets in slices(batches, "lowered"):
        total = np.zeros((batch.num_rows, len(prior))) + prior
        for codes, rows, own in _segments(data, offsets):
            for order in ORDERS:
                bucket, row = _buckets(codes, rows, own, order, len(weights))
                if len(row):
                    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                    for k in range(len(prior)):
                        total[row[first], k] += np.add.reduceat(weights[:, k][bucket], first, dtype=np.float64)
        letters = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
        best = np.full(batch.num_rows, len(prior))
        score = np.zeros(batch.num_rows)
        if len(prior):
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best = np.where(letters, total.argmax(axis=1), len(prior))
            score = np.where(letters, 1 / odds.sum(axis=1), 0.0)
        columns = {"lang_pred": pa.array(list(names[best]), pa.string()), "score": pa.array(score)}
        kept = [c for c in batch.schema.names if c not in ("lowered", "has_letter")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns.values()], [*kept, *columns])


def identify(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred and score (the posterior of the predicted language, 0 to 1).

    A text that is NULL, empty or without any letter, and any text under a model without
    languages, gets ``und`` and score 0. Columns named lang_pred or score are replaced; of languages
    that tie, the first in alphabetical order wins. Rows are kept one for one, repeated rows too.
    """
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "lowered", "has_letter")
    ready = docs.withColumns({"lowered": F.coalesce(F.lower("text"), F.lit("")), "has_letter": F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))})
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema), "lang_pred string", "score double"])
    return ready.mapInArrow(lambda it: _score(it, shared.value), schema)


def is_training(doc_id: str = "doc_id", folds: int = 5):
    """True for the documents that may be learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % folds != 0
