"""Parts of the index build and of full scores grow with the data."""

from pyspark.sql import functions as F

from staylytics.operators import inverted
from staylytics.session import scratch_path


def _built(spark, docs, asked):
    path = scratch_path(spark, "index")
    inverted.build(docs, path)
    index = inverted.load(spark, path)
    found = inverted.ranked(inverted.scores(index, asked))
    return index, found, sorted((r["query_id"], r["doc_id"], r["rank"], round(r["bm25"], 9)) for r in found.collect())


def test_more_data_makes_more_parts_and_the_same_scores(spark, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("all"), F.col("id") % 7, F.col("id") % 11, F.col("id") % 3).alias("text"))
    asked = spark.createDataFrame([(1, "all 3 5"), (2, "2 9 all")], "query_id long, query_text string")
    _, _, want = _built(spark, docs, asked)
    for limit in ("TASK_CHARS", "TASK_POSTINGS", "TASK_PAIRS"):
        monkeypatch.setattr(inverted, limit, 5)
    index, _, got = _built(spark, docs, asked)
    assert got == want
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert inverted.scores(index, asked).rdd.getNumPartitions() > width
    assert inverted._parts(spark, 5 * width, 5) is None and inverted._parts(spark, 5 * width + 1, 5) == width + 1
    assert inverted._parts(spark, None, 5) is None


def test_bounds_of_a_tier_are_summed_once(spark, monkeypatch):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("all"), F.col("id") % 7, F.col("id") % 11).alias("text"))
    path, k = scratch_path(spark, "index"), 5
    inverted.build(docs, path)
    index, asked = inverted.load(spark, path), spark.createDataFrame([(1, "all 3 5"), (2, "2 9 all")], "query_id long, query_text string")
    stored, settle = [], inverted.settle
    monkeypatch.setattr(inverted, "settle", lambda df: stored.append(df.columns) or settle(df))
    found = inverted.top_k(index, asked, k)
    tiers = found.rounds.agg(F.max("tiers")).first()[0]
    assert stored.count(["query_id", "doc_id", "low", "met"]) == tiers
    best = inverted.ranked(inverted.scores(index, asked)).where(F.col("rank") <= k).select("query_id", "doc_id", "rank")
    assert sorted(found.top.select("query_id", "doc_id", "rank").collect()) == sorted(best.collect())
