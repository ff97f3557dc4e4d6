"""Positions, running totals, quantiles and skewed joins against plain Python."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import values
from pyspark.sql import functions as F

from staylytics.operators.joins import lookup_join, salted_join
from staylytics.operators.ordering import exact_quantile, with_global_index, with_running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    rnd = random.Random(7)
    rows = [(("hot" if i % 3 == 0 else f"k{rnd.randrange(20)}"), rnd.randrange(50), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, v long, id long").repartition(6)


def test_global_index_is_the_sorted_position(skewed):
    rows, df = skewed
    got = {r["id"]: r["row_index"] for r in with_global_index(df, ["k", "v", "id"]).collect()}
    assert got == {r[2]: i for i, r in enumerate(sorted(rows))}


def test_running_totals_per_key(skewed):
    rows, df = skewed
    got = {r["id"]: (r["n"], r["s"]) for r in with_running_totals(df, ["k"], ["v", "id"], {"n": F.lit(1), "s": F.col("v")}).collect()}
    want, seen = {}, {}
    for k, v, i in sorted(rows):
        n, s = seen.get(k, (0, 0))
        seen[k] = want[i] = (n + 1, s + v)
    assert got == want


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.995, 1.0])
def test_exact_quantile(skewed, q):
    rows, df = skewed
    got = {r["k"]: r["quantile"] for r in exact_quantile(df, "v", q, ["k"]).collect()}
    for k in {r[0] for r in rows}:
        assert got[k] == pytest.approx(np.quantile([r[1] for r in rows if r[0] == k], q))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_exact_quantile_of_doubles(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    assert exact_quantile(df, "v", 0.9).first()[0] == pytest.approx(np.quantile(xs, 0.9), abs=1e-6)


def test_joins_keep_every_row_of_a_hot_key(spark, skewed):
    rows, df = skewed
    right = spark.createDataFrame([(k, k.upper()) for k in ("hot", "k1", "k2")], "k string, name string")
    for got in (lookup_join(df, right, "k", "inner"), salted_join(df, right, ["k"], "id")):
        assert sorted(r["id"] for r in got.collect()) == sorted(r[2] for r in rows if r[0] in ("hot", "k1", "k2"))
    left = lookup_join(df, right, "k")
    assert left.count() == len(rows) and left.where("k NOT IN ('hot', 'k1', 'k2') AND name IS NOT NULL").count() == 0


def test_null_is_a_group_of_its_own(spark):
    rows = [("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert values(exact_quantile(df, "v", 0.5, ["k"]), "k", "quantile") == [("a", 2.0), (None, 7.0)]
    running = with_running_totals(df, ["k"], ["v"], {"upto": F.col("v")})
    assert values(running, "k", "upto") == sorted([("a", 1.0), ("a", 4.0), (None, 5.0), (None, 12.0), (None, 21.0)], key=repr)


def test_lookup_join_keeps_null_keys_apart(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id long, k string")
    right = spark.createDataFrame([("a", 10), (None, 99)], "k string, v int")
    assert values(lookup_join(left, right, "k"), "id", "v") == [(1, 10), (2, None), (3, None), (4, None)]
    assert values(lookup_join(left, right, "k", "inner"), "id", "v") == [(1, 10)]
