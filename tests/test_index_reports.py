"""Inverted index, topics, user functions, text drift, partial upsert, sketches and forecasts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylytics.operators import chunking, inverted, monitoring, retrieval, reviews, sketches
from staylytics.plans import ml, review_report
from staylytics.session import scratch_path
from staylytics.sources import io


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 3, 20, 60])))) for i in range(n)]
    asked = [(i, " ".join(rng.choices(words, [w ** 0.5 for w in weights], k=rng.choice([1, 4, 12])))) for i in range(12)]
    return docs, asked + [(50, "unknown words"), (51, ""), (52, None), (53, "W1 w1 w299")]


def full_ranking(spark, docs, asked, k):
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, query_text string")
    best = {}
    for r in retrieval.bm25_scores(d, q).collect():
        best.setdefault(r["query_id"], []).append((-round(r["bm25"], 9), r["doc_id"]))
    return {i: [(d, -s) for s, d in sorted(x)[:k]] for i, x in best.items()}


def found_ranking(index, asked, k, spark):
    found = inverted.top_k(index, spark.createDataFrame(asked, "query_id long, query_text string"), k)
    out = {}
    for r in sorted(found.top.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["doc_id"], round(r["bm25"], 9)))
    return out, {r["query_id"]: r["tiers"] for r in found.rounds.collect()}


def same(got, want):
    return got.keys() == want.keys() and all([d for d, _ in got[i]] == [d for d, _ in want[i]] and all(
        a == pytest.approx(b, abs=1e-8) for (_, a), (_, b) in zip(got[i], want[i])) for i in want)


def test_top_k_equals_full_scoring_and_stops_early(spark, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 4)
    docs, asked = corpus(1)
    path = scratch_path(spark, "index")
    inverted.build(spark.createDataFrame([*docs, (None, "w1 w2")], "doc_id long, text string"), path)
    index = inverted.load(spark, path)
    assert index.tiers >= 4 and inverted.exists(spark, path)
    got, tiers = found_ranking(index, asked, 5, spark)
    assert same(got, full_ranking(spark, docs, asked, 5))
    assert min(tiers.values()) < index.tiers  # some query was settled without the whole index
    allowed = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "doc_id long")
    got, _ = found_ranking(inverted.restricted(index, allowed), asked, 400, spark)
    every = full_ranking(spark, docs, asked, 400)
    assert same(got, {i: kept for i, x in every.items() if (kept := [e for e in x if e[0] % 3 == 0])})


def test_updates_replace_and_remove(spark, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 8)
    docs, asked = corpus(3)
    path = scratch_path(spark, "index")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    inverted.build(frame([(i, t if i % 4 else "old w5 w5 w5 " + t) for i, t in docs if i < 300] + [(1000 + i, "w1 w7") for i in range(30)]), path)
    changed = [(i, t) for i, t in docs if i >= 300 or i % 4 == 0]
    for _ in range(2):  # the second time replaces the segment
        inverted.update(path, 1, frame(changed), frame([(1000 + i, "") for i in range(30)]))
    inverted.update(path, 2, frame(docs[5:6]), frame([]))
    got, _ = found_ranking(inverted.load(spark, path), asked, 7, spark)
    assert same(got, full_ranking(spark, docs, asked, 7))


def test_tiny_and_empty_corpora(spark):
    for docs in ([(1, "a b"), (2, "a")], [(1, "a")], [(1, "")]):
        path = scratch_path(spark, "index")
        inverted.build(spark.createDataFrame(docs, "doc_id long, text string"), path)
        asked = [(1, "a b"), (2, "a"), (3, "z")]
        got, _ = found_ranking(inverted.load(spark, path), asked, 5, spark)
        assert same(got, full_ranking(spark, docs, asked, 5))


def test_candidates_hold_documents_without_vectors(spark):
    docs = spark.createDataFrame([(1, "red fox"), (2, "blue fox"), (3, "red wine"), (4, "red fox red"), *((i, f"filler{i} text") for i in range(20, 30))], "doc_id long, text string")
    vectors = spark.createDataFrame([(2, [1.0, 0.0]), (3, [0.0, 1.0]), (1, None), (9, [float("nan"), 1.0])], "doc_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, "red", [0.5, 1.0]), (2, "fox", None)], "query_id long, query_text string, embedding array<double>")
    path = scratch_path(spark, "index")
    inverted.build(docs, path)
    got = {(r["query_id"], r["doc_id"]): (r["dense"], round(r["sparse"], 6)) for r in retrieval.candidates(vectors, inverted.load(spark, path), asked, 2).collect()}
    assert got[1, 3][0] == 1.0 and got[1, 2] == (0.5, 0.0) and got[1, 4] == (0.0, 1.0)
    assert {k for k in got if k[0] == 2} == {(2, 1), (2, 2)} and all(v[0] == 0.0 for k, v in got.items() if k[0] == 2)


def test_vectors_of_other_lengths_and_broken_ones(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [3.0, 1.0])]
    asked = [(1, [1.0, 1.0]), (2, [2.0]), (3, None), (4, [1.0, 1.0, 1.0])]
    got = retrieval.dense_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame(asked, "query_id long, embedding array<double>"), 5)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == [(1, 1, 7, 4.0), (1, 2, 1, 3.0), (2, 1, 3, 2.0)]


# --- topics


def themed(seed, n):
    rng = random.Random(seed)
    themes = [[f"{name}{i}" for i in range(12)] for name in ("room", "food", "staff", "price", "pool")]
    return [" ".join(rng.choices(themes[i % 5], k=30) + rng.choices(sum(themes, []), k=2)) for i in range(n)]


def test_topics_beat_one_topic_on_held_out_reviews(spark):
    train = spark.createDataFrame([(t,) for t in themed(1, 150)], "review string")
    held = spark.createDataFrame([(t,) for t in themed(2, 40)], "review string")
    model = reviews.fit_topics(train, "review", k=5)
    found = model.describe(6).collect()
    assert sorted(r["topic_id"] for r in found) == list(range(5))
    assert all(len(set(r["keywords"])) == 6 for r in found)
    assert any(len({w.rstrip("0123456789") for w in r["keywords"]}) == 1 for r in found)  # some topic is one theme
    features = model.features.transform(reviews.topic_tokens(held, "review")).select("features")
    local = model.lda.toLocal()
    words = np.array(local.topicsMatrix().toArray()) + 1e-6
    words /= words.sum(0)
    many = sum(
        v * math.log(float(words[int(i)] @ r["topicDistribution"].toArray())) for r in local.transform(features).collect() for i, v in zip(r["features"].indices, r["features"].values)
    )
    counts = Counter()
    for r in model.features.transform(reviews.topic_tokens(train, "review")).select("features").collect():
        for i, v in zip(r["features"].indices, r["features"].values):
            counts[int(i)] += v
    total, size = sum(counts.values()), len(counts)
    one = sum(v * math.log((counts[int(i)] + 0.1) / (total + 0.1 * size)) for r in features.collect() for i, v in zip(r["features"].indices, r["features"].values))
    assert many > one


def test_report_holds_topics_and_annotations(spark):
    path = scratch_path(spark, "reviews")
    for read in (review_report.get_topics, review_report.get_annotated, review_report.get_summary, review_report.get_complaints, review_report.get_keywords, review_report.get_trends):
        with pytest.raises(review_report.NotAnalyzedError):
            read(spark, path)
    rows = [(i, t, i % 5 + 1, f"2024-01-{i % 28 + 1:02d}", "h", "en") for i, t in enumerate(themed(3, 30))]
    df = spark.createDataFrame(rows, "doc_id long, review string, rating int, date string, hotel_id string, language string").withColumn("date", F.to_date("date"))
    review_report.analyze(df, path)
    assert review_report.get_topics(spark, path).count() == 5 and review_report.get_annotated(spark, path).count() == 30
    assert review_report.get_keywords(spark, path).count() == 15
    assert reviews.topics(df.limit(4), "review").collect() == [] == reviews.topics(df.withColumn("review", F.lit("")), "review").collect()


# --- user functions


def test_user_aggregate_equals_the_expression(spark):
    rows = [("a", r, f"2024-01-{d:02d}") for d, r in enumerate([1, 5, 3, 4, 2, 5, None], 1)] + [(None, 4, "2024-02-01"), ("b", None, "2024-02-01")]
    df = spark.createDataFrame(rows, "hotel_id string, rating int, date string").withColumn("date", F.to_date("date"))
    want = {r["hotel_id"]: r["csat"] for r in reviews.csat_by_hotel(df).collect() if r["csat"] is not None}
    assert {r["hotel_id"]: r["csat"] for r in reviews.csat_by_function(df).collect()} == want
    days = [r["csat"] for r in reviews.csat_rolling(df.where("hotel_id = 'a'"), "daily", 2).orderBy("period").collect()]
    assert days == [0.0, 50.0, 75.0, 62.5, 50.0, 62.5]


def test_table_function(spark):
    text = "First part. " * 90 + "\n\n" + "x" * 1700
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "short")], "doc_id long, t string")
    got = chunking.lateral_chunks(df, "t").orderBy("doc_id", "chunk_index").collect()
    assert [(r["begin"], r["end"]) for r in got if r["doc_id"] == 1] == chunking.separator_spans(text, 800)
    assert all(r["chunk"] == (text if r["doc_id"] == 1 else "short")[r["begin"] : r["end"]] for r in got) and {r["doc_id"] for r in got} == {1, 4}
    spark.udtf.register("separator_chunks", chunking.separator_chunks())
    df.createOrReplaceTempView("texts_to_cut")
    assert spark.sql("SELECT doc_id, c.* FROM texts_to_cut, LATERAL separator_chunks(t, 800) c").count() == len(got)
    for wrong in ("separator_chunks(doc_id, 800)", "separator_chunks(t, 0)", "separator_chunks(t, 'x')"):
        with pytest.raises(Exception):
            spark.sql(f"SELECT * FROM texts_to_cut, LATERAL {wrong}").collect()


# --- drift of text columns


def test_text_drift_by_hand(spark):
    before = ["a"] * 60 + ["b"] * 40 + [f"rare{i}" for i in range(3)] + [None] * 9
    after = ["a"] * 30 + ["c"] * 70 + [f"other{i}" for i in range(5)]
    rows = [("k", v, False) for v in before] + [("k", v, True) for v in after] + [("half", "x", True), ("same", "y", True), ("same", "y", False)]
    df = spark.createDataFrame(rows, "column_name string, v string, is_current boolean")
    got = {r["column_name"]: r for r in monitoring.text_drift(df, ["column_name"], rare=0.02).collect()}
    assert got.keys() == {"k", "same"} and got["same"]["distance"] == 0 and not got["same"]["drifted"]
    p = np.array([60, 40, 0, 3]) / 103
    q = np.array([30, 0, 70, 5]) / 105
    m = (p + q) / 2
    want = math.sqrt(sum(x * math.log(x / y) for x, y in zip(p, m) if x) / 2 + sum(x * math.log(x / y) for x, y in zip(q, m) if x) / 2)
    assert got["k"]["distance"] == pytest.approx(want) and got["k"]["drifted"]


def test_column_drift_picks_the_test_by_type(spark):
    df = spark.createDataFrame([(i % 2 == 0, f"v{i % 3}", float(i % 2), i % 2 == 0) for i in range(600)], "cur boolean, name string, number double, flag boolean")
    got = {r["column_name"]: r for r in monitoring.column_drift(df, F.col("cur"), ["name", "number", "flag"]).collect()}
    assert {k: r["test"] for k, r in got.items()} == {"name": "jensen_shannon", "flag": "jensen_shannon", "number": "kolmogorov_smirnov"}
    assert not got["name"]["drifted"] and got["number"]["drifted"] and got["flag"]["drifted"]


# --- tables, sketches, forecasts


def test_partial_upsert_touches_only_its_folders(spark):
    path = scratch_path(spark, "keyed")
    rows = [(i, f"v{i}") for i in range(200)] + [(None, "none")]
    io.write_keyed(spark.createDataFrame(rows, "id long, v string"), path, ["id"], 16)
    files = lambda: {r[0]: r[1] for r in spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}
    before = files()
    touched = io.upsert_keyed(spark.createDataFrame([("new", 7), ("added", 1000), ("null", None)], "v string, id long"), path, ["id"], 16)
    assert 1 <= len(touched) <= 3
    after = files()
    kept = {f for f in before if int(f.split("_part=")[1].split("/")[0]) not in touched}
    assert len(kept) >= 12 and all(after.get(f) == before[f] for f in kept)
    got = {r["id"]: r["v"] for r in io.read_keyed(spark, path).collect()}
    assert got == dict(rows) | {7: "new", 1000: "added", None: "null"} and io.read_keyed(spark, path).count() == 202
    assert io.upsert_keyed(spark.createDataFrame([], "id long, v string"), path, ["id"], 16) == []


def test_sketches_unite(spark):
    rng = random.Random(5)
    rows = [("h", f"2024-01-{i % 9 + 1:02d}", rng.randint(0, 5000), rng.gauss(100, 20)) for i in range(20_000)] + [("empty", "2024-01-01", None, None)]
    df = spark.createDataFrame(rows, "hotel string, day string, guest long, rate double")
    got = {r["hotel"]: r for r in sketches.united(sketches.daily(df, ["hotel"], "day", "guest", "rate"), ["hotel"], 0.5).collect()}
    assert got["h"]["n"] == 20_000 and abs(got["h"]["distinct_count"] / len({r[2] for r in rows[:-1]}) - 1) < sketches.DISTINCT_ERROR
    rates = sorted(r[3] for r in rows[:-1])
    assert rates[int(20_000 * (0.5 - sketches.RANK_ERROR))] <= got["h"]["quantile"] <= rates[int(20_000 * (0.5 + sketches.RANK_ERROR))]
    assert (got["empty"]["n"], got["empty"]["distinct_count"], got["empty"]["quantile"]) == (1, 0, None)


def test_forecast_follows_a_change_of_trend_and_covers(spark):
    rng = np.random.default_rng(4)
    days = np.arange(900)
    trend = np.where(days < 500, 0.02 * days, 10 - 0.03 * (days - 500))
    values = 50 + trend + 6 * np.sin(2 * np.pi * days / 365.25) + 4 * (days % 7 == 5) + rng.normal(0, 2, 900)
    rows = [(1, f"{d}", float(v)) for d, v in zip(np.datetime64("2020-01-06") + days, values)] + [(2, "2020-01-06", 40.0), (2, "2020-01-07", None)]
    df = spark.createDataFrame(rows, "branch_id int, occupancy_date string, occupancy_pct double").withColumn("occupancy_date", F.to_date("occupancy_date"))
    tested = ml.backtest(df.where("branch_id = 1")).first()
    assert tested["n"] == 300 and 0.9 <= tested["covered"] <= 0.99 and tested["mae"] < tested["naive_mae"]
    found = ml.forecast_occupancy(df)
    assert found.groupBy("branch_id").count().collect() and found.where("branch_id = 2").count() == 30
    future = np.arange(900, 930)
    truth = 50 + 10 - 0.03 * (future - 500) + 6 * np.sin(2 * np.pi * future / 365.25) + 4 * (future % 7 == 5)
    got = [r["predicted_occupancy_pct"] for r in found.where("branch_id = 1").orderBy("occupancy_date").collect()]
    assert np.mean(np.abs(np.array(got) - truth)) < 2
