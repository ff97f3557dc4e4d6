"""Chunking, vector search, BM25, caches and reviews against brute force."""

import math
import random

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from staylytics.operators import chunking, retrieval, reviews


def _chunks(spark, texts, size=800, overlap=0):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r["chunks"] for r in chunking.chunk_text(df, "text", size, overlap).orderBy("id").collect()]


def test_separator_chunks_cover_the_text_and_fit(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 12))) for _ in range(600)]
    seps = [" ", " ", " ", ". ", "\n", "\n\n"]
    texts = ["".join(w + rnd.choice(seps) for w in rnd.sample(words, 150)) for _ in range(10)]
    for text, got in zip(texts, _chunks(spark, texts, size=60)):
        assert all(0 < len(c) <= 60 for c in got)
        # Only separators may be lost between chunks.
        flat = "".join(text.split()).replace(".", "")
        assert "".join("".join(got).split()).replace(".", "") == flat


@pytest.mark.parametrize("text,size,want", [
    ("aa bb cc", 5, ["aa bb", "cc"]), ("one. two. three", 9, ["one. two", "three"]), ("abcdefgh", 3, ["abc", "def", "gh"]),
    ("p1 p1\n\np2", 7, ["p1 p1", "p2"]), ("   ", 5, []), ("aa\nbb cccc dd", 6, ["aa", "bb", "cccc", "dd"]),
])
def test_separator_chunk_examples(spark, text, size, want):
    assert _chunks(spark, [text], size)[0] == want


def test_overlap_prefixes_the_previous_tail(spark):
    assert _chunks(spark, ["aaaa bbbb cccc"], 4, 2)[0] == ["aaaa", "aa bbbb", "bb cccc"]


def test_markdown_sections(spark):
    df = spark.createDataFrame([(1, "intro\n# One\nx\n## Two \ny"), (2, "plain")], "id int, text string")
    out = values(chunking.markdown_sections(df, "text"), "id", "heading", "section_text")
    assert out == [(1, "One", "# One\nx"), (1, "Two", "## Two \ny"), (2, None, "plain")]


@pytest.mark.parametrize("per_pass", [4096, 2])
def test_dense_top_k_with_many_copies(spark, monkeypatch, per_pass):
    monkeypatch.setattr(retrieval, "BLOCK_QUERIES", per_pass)
    monkeypatch.setattr(retrieval, "SHARD_VECTORS", 100)
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 8)).astype("float32")
    m[::3] = m[0]  # a third of the vectors are copies
    q = rng.normal(size=(5, 8)).astype("float32")
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<float>").repartition(4)
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in retrieval.dense_top_k(vectors, queries, 7).collect()}
    for i, v in enumerate(q):
        s = np.round(m.astype(float) @ v.astype(float), 9)
        for rank, j in enumerate(sorted(range(300), key=lambda j: (-s[j], j))[:7], 1):
            assert got[(i, rank)] == j


def test_bm25_against_the_formula(spark):
    docs = ["the cat sat", "the dog sat on the mat", "a bird", "the cat and the cat"]
    queries = ["the cat", "bird bird zebra"]
    tok = [d.split() for d in docs]
    n, avg = len(docs), sum(map(len, tok)) / len(docs)
    vocab = {w for t in tok for w in t}
    raw = {w: math.log(n - sum(w in t for t in tok) + 0.5) - math.log(sum(w in t for t in tok) + 0.5) for w in vocab}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: floor if v < 0 else v for w, v in raw.items()}
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    q = spark.createDataFrame(list(enumerate(queries)), "query_id long, query_text string")
    got = {(r["query_id"], r["doc_id"]): r["bm25"] for r in retrieval.bm25_scores(d, q).collect()}
    for i, query in enumerate(queries):
        for j, t in enumerate(tok):
            s = sum(idf[w] * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in query.split() if w in t)
            assert got.get((i, j), 0.0) == pytest.approx(s)


def test_context_budget_cuts_the_last_piece(spark):
    rows = [(1, p, "x" * 40) for p in (1, 2, 3)]
    df = spark.createDataFrame(rows, "query_id long, position int, text string")
    assert retrieval.compress_context(df, 100).first()["context"] == "x" * 40 + "\n\n" + "x" * 40 + "\n\n" + "x" * 20


def test_filter_ignores_dates_where_there_are_none(spark):
    df = spark.createDataFrame([("a", "1", None), ("a", "1", "2024-01-01"), ("b", "1", "2024-05-01"), ("a", "2", "2024-05-01")], "doc_type string, branch_id string, date string")
    flt = retrieval.MetadataFilter(doc_type="a", branch_id=1, date_from="2024-03-01")
    assert df.where(flt.condition()).count() == 1


def test_sentiment_is_substring_based(spark):
    texts = ["Staff were UNHELPFUL", "spotless and great", "nothing", "rude but friendly and clean", "not clean"]
    df = spark.createDataFrame([(t,) for t in texts], "review string")
    got = [tuple(r) for r in reviews.annotate(df).select("sentiment", "emotion").collect()]
    assert got == [("neutral", "satisfied"), ("positive", "happy"), ("neutral", "satisfied"), ("positive", "happy"), ("neutral", "satisfied")]


def test_complaints_fire_on_negative_words_only(spark):
    df = spark.createDataFrame([("The room was spotless",), ("mold and a broken lock",)], "review string")
    got = [r["complaints"] for r in reviews.with_complaints(df).collect()]
    assert got[0] == [] and "cleanliness" in got[1] and "maintenance" in got[1]


@pytest.mark.parametrize("series,label", [([50] * 5, "stable"), ([50, 50, 50, 60, 60, 60], "improving"), ([60, 60, 60, 50, 50, 50], "declining"), ([50, 50, 50, 51, 51, 51], "stable")])
def test_trend_labels(spark, series, label):
    df = spark.createDataFrame([("h", f"p{i:02d}", float(v)) for i, v in enumerate(series)], "hotel_id string, period string, csat double")
    assert reviews.csat_trend(df).first()["trend"] == label


def test_cache_split(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(30)], "doc_id long, text string")
    cache = docs.where("doc_id = 1").select(retrieval.cache_key(F.col("text")).alias("key"))
    marked = retrieval.split_by_cache(docs, cache)
    assert marked.where("cached").count() == 20 and retrieval.missing_keys(marked).count() == 10
