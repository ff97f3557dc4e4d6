"""Rounds of the topic fit: mixtures of documents, and sums that depend neither on partitions nor on slices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylytics.operators import reviews
from staylytics.plans import review_report
from staylytics.session import scratch_path


def test_mixtures_against_one_document_after_the_other():
    rng = np.random.default_rng(3)
    shares = rng.dirichlet(np.ones(40), 3).T
    documents = [(rng.choice(40, n, replace=False), rng.random(n) * 50) for n in (1, 7, 3, 30)]
    places, weights = (np.concatenate(parts) for parts in zip(*documents, strict=True))
    mix, split = reviews.mixtures(shares, places, weights, np.array([len(p) for p, _ in documents]))
    at = 0
    for d, (held, counts) in enumerate(documents):
        theta = np.full(3, counts.sum() / 3)
        for _ in range(reviews.MIXTURE_STEPS):
            parts = np.array([c * shares[w] * (theta + reviews.TOPIC_PRIOR) / (shares[w] @ (theta + reviews.TOPIC_PRIOR)) for w, c in zip(held, counts, strict=True)])
            theta = parts.sum(axis=0)
        assert mix[d] == pytest.approx(theta)
        assert split[at : at + len(held)] == pytest.approx(parts)
        at += len(held)


@pytest.mark.parametrize("part", [1, 25, 200_000])
def test_a_round_hands_out_the_weight_of_every_word(spark, monkeypatch, part):
    rng = np.random.default_rng(5)
    rows = [(sorted(rng.choice(60, n, replace=False).tolist()), (rng.random(n) + 0.1).tolist()) for n in rng.integers(1, 30, 50).tolist()]
    documents = spark.createDataFrame([(len(p), p, w) for p, w in rows], "sizes int, indices array<int>, values array<double>")
    topics = reviews.Topics(rng.random((64, 4)))
    monkeypatch.setattr(reviews, "_PART_WORDS", part)
    found = reviews._round(documents.repartition(3), topics).weights
    places, weights = np.concatenate([p for p, _ in rows]), np.concatenate([w for _, w in rows])
    split = reviews.mixtures(topics.shares(), places, weights, np.array([len(p) for p, _ in rows]))[1]
    want = np.zeros((64, 4))
    np.add.at(want, places, split)
    assert found == pytest.approx(want)
    assert found.sum(axis=1) == pytest.approx(np.bincount(places, weights, 64))


def test_reviews_are_annotated_once(spark, monkeypatch):
    calls = []
    annotate = review_report.ops.annotate
    monkeypatch.setattr(review_report.ops, "annotate", lambda df: calls.append(1) or annotate(df))
    rows = [(i, "great dirty room " * (i % 3 + 1), 1 + i % 5, "a", "en") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, review string, rating int, hotel_id string, language string").withColumn("date", F.make_date(F.lit(2024), F.lit(1), F.col("doc_id").cast("int") + 1))
    path = scratch_path(spark, "reviews")
    review_report.analyze(df, path)
    assert len(calls) == 1 and review_report.get_annotated(spark, path).count() == 8
    assert review_report.get_summary(spark, path).first()[0].startswith("Analyzed 8 reviews")
