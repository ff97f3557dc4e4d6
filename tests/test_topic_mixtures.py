"""Mixtures of documents in cache-sized parts against one document at a time."""

import numpy as np

from staylytics.operators import reviews


def test_mixtures_are_fitted_in_parts_that_stay_near(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 40)
    places, weights = rng.integers(0, 500, sizes.sum()), rng.random(sizes.sum()) + 0.1
    shares = rng.dirichlet(np.ones(5), 500)
    shares /= shares.sum(axis=0)
    whole = reviews.mixtures(shares, places, weights, sizes)
    monkeypatch.setattr(reviews, "_NEAR_WORDS", 100)
    parts = reviews.mixtures(shares, places, weights, sizes)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    start = 0
    for i, size in enumerate(sizes):
        own = slice(start, start + size)
        mix = np.full(5, weights[own].sum() / 5)
        for _ in range(reviews.MIXTURE_STEPS):
            split = shares[places[own]] * (mix + reviews.TOPIC_PRIOR)
            split *= (weights[own] / split.sum(axis=1))[:, None]
            mix = split.sum(axis=0)
        assert np.allclose(parts[0][i], mix, rtol=1e-12) and np.allclose(parts[1][own], split, rtol=1e-12)
        start += size
