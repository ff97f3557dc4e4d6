"""Quality classifier: logistic regression over hashed token n-grams, trained by follow-the-regularised-leader.

Training reads a sample of labelled rows with a documented bound (``max_rows``), chosen by a hash of the identifier
and passed once per epoch in that order. Scoring is a sparse dot product inside an Arrow function, one pass over all
texts without a shuffle.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics.llm import text as tx


@dataclass(frozen=True)
class Settings:
    bits: int = 18  # size of the hashed weight vector: 2 ** bits
    alpha: float = 0.3  # learning rate
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 4
    max_rows: int = 20_000  # labelled rows read for the fit


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int


def features(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the hashed places of its token n-grams and their unit-length log counts.

    N-grams are unigrams, bigrams, and two patterns without regard to the words: a token equal to the one before it, or
    to the second before it, as in lines that repeat a word.
    """
    shift = np.uint64(64 - bits)
    patterns = tx.mix(np.array([1, 2], np.uint64)) >> shift
    for _, data, offsets in tx.pieces(column):
        one, first = tx.tokens(data, offsets)
        again = [np.concatenate([[0], np.cumsum(one[k:] == one[:-k])]) for k in (1, 2)]
        two = tx.mix(one[:-1] * np.uint64(0x9FB21C651E98DF25) + one[1:]) >> shift
        one = tx.mix(one) >> shift
        for a, b in zip(first[:-1], first[1:], strict=True):
            places, counts = np.unique(np.concatenate([one[a:b], two[a : max(a, b - 1)]]), return_counts=True)
            repeats = np.array([c[max(a, b - k)] - c[a] if b - a > k else 0 for k, c in zip((1, 2), again, strict=True)])
            places, counts = np.append(places, patterns[repeats > 0]), np.append(counts, repeats[repeats > 0])
            values = np.log1p(counts)
            norm = np.sqrt((values * values).sum())
            yield places, values / norm if norm else values


def _leader(rows: Iterator[tuple[np.ndarray, np.ndarray, int]], s: Settings) -> tuple[np.ndarray, float]:
    """One weight vector from one ordered stream; slot ``2 ** bits`` is the bias."""
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        pull = np.sign(z[i]) * s.l1 - z[i]
        return np.where(np.abs(z[i]) <= s.l1, 0.0, pull / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2))

    for places, values, y in rows:
        i, x = np.append(places, 1 << s.bits).astype(np.int64), np.append(values, 1.0)
        w = weight(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha * w
        n[i] += g * g
    w = weight(np.arange((1 << s.bits) + 1))
    return w[:-1], float(w[-1])


def _epochs(places: array, values: array, ends: array, labels: array, epochs: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    p, v = np.frombuffer(places, np.uint32) if places else np.zeros(0, np.uint32), np.frombuffer(values, np.float32) if values else np.zeros(0, np.float32)
    for _ in range(epochs):
        for lo, hi, y in zip(ends[:-1], ends[1:], labels, strict=True):
            yield p[lo:hi], v[lo:hi], y


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, s: Settings = Settings()) -> Model:
    """Learn ``labels.quality`` from ``docs.text``.

    ``usable`` is a condition on ``doc_id`` that labelled rows must meet. Rows with a null identifier or a label other
    than 0 and 1 are ignored; an identifier with both labels counts as 1. Of the rest the ``max_rows`` with the
    smallest identifier hash are read; of texts that share an identifier, the one with the smallest hash. Without any
    usable row the model is neutral: every score is 0.5.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    if usable is not None:
        marked = marked.where(usable)
    chosen = (
        marked.groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(s.max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    least = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))  # limited map-side
    rows = rows.withColumn("copy", least).where("copy = 1").drop("copy")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "doc_id", "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # three flat arrays, not two small ones a row
        places, values, ends, labels = array("I"), array("f"), array("q", [0]), array("b")
        for b in batches:
            for p, v in features(b.column("text"), s.bits):
                places.frombytes(p.astype(np.uint32).tobytes())
                values.frombytes(v.astype(np.float32).tobytes())
                ends.append(len(places))
            labels.extend(b.column("y").to_pylist())
        weights, bias = _leader(_epochs(places, values, ends, labels, s.epochs), s)
        yield pa.RecordBatch.from_pydict({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias]})
        del places, values
        tx.release()

    got = rows.mapInArrow(train, "weights binary, bias double").collect()  # one row of 2 ** bits floats
    if not got:
        return Model(np.zeros(1 << s.bits, np.float32), 0.0, s.bits)
    return Model(np.frombuffer(got[0]["weights"], np.float32), got[0]["bias"], s.bits)


def score(docs: DataFrame, model: Model) -> Column:
    """Column expression: probability of label 1 for ``docs.text``; null and empty texts have the model's bias only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def probability(text: pa.Array) -> pa.Array:
        m = shared.value
        dots = [m.weights[places] @ values for places, values in features(text, m.bits)]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(dots, float) + m.bias, -35, 35))), pa.float64())

    return F.arrow_udf(probability, "double")(docs["text"])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept away from the fit: crc32 of the identifier as text, modulo 4, is 2 (a null identifier is not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if the score reaches ``threshold``)."""
    model = fit(docs, labels, ~held_out(), s)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """Rows of ``docs``, columns unchanged, that reach ``threshold``."""
    return docs.where(score(docs, fit(docs, labels, ~held_out(), s)) >= threshold)
