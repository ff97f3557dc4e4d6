"""What the index build and the keyword search leave on disk, and blocks against their definition."""

import math
import os
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from staylytics.operators import inverted
from staylytics.session import scratch_path, settle


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()) if f.getName().startswith("shuffle_")}


def left_over(spark, before, seconds=15):
    """Shuffle files that are not in ``before``; they are deleted a little after a write."""
    end = time.time() + seconds
    while (found := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return found


def corpus(seed, n):
    rng = random.Random(seed)
    words, weights = [f"w{i}" for i in range(80)] + ["É", "naïve x"], [1 / (i + 1) for i in range(82)]
    return [(i % (n - 5) - 2, rng.choice([" \t", ""]) + "\r\n ".join(rng.choices(words, weights, k=rng.choice([0, 3, 20, 60]))) if i % 17 else None) for i in range(n)]


def test_a_settled_frame_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = settle(spark.range(2000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert left_over(spark, before) == set()
    assert sorted(r["k"] for r in out.collect()) == list(range(7))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_build_leaves_no_shuffle_files_of_texts_and_postings(spark):
    docs = spark.createDataFrame(corpus(1, 300), "doc_id long, text string")
    before = shuffle_files(spark)
    inverted.build(docs, scratch_path(spark, "index"))
    # the few that stay are of counts, not of rows
    size = sum(os.path.getsize(f.getPath()) for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName() in left_over(spark, before, 3))
    assert size < 20_000


def test_a_search_keeps_the_gains_of_no_tier(spark, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 4)
    path, kept, real = scratch_path(spark, "index"), [], inverted.settle
    inverted.build(spark.createDataFrame(corpus(2, 300), "doc_id long, text string"), path)
    index = inverted.load(spark, path)

    def noted(df):
        kept.append(real(df))
        return kept[-1]

    monkeypatch.setattr(inverted, "settle", noted)
    inverted.top_k(index, spark.createDataFrame([(1, "w0 w1 w30"), (2, "w2 w70")], "query_id long, query_text string"), 3).top.collect()
    wide = [f._settled_at.removeprefix("file:") for f in kept if {"gain", "low"} & set(f.columns)]
    assert wide and not any(os.path.exists(p) for p in wide)


@pytest.mark.parametrize("limit", [2_000_000, 30])
def test_blocks_follow_their_definition(spark, monkeypatch, limit):
    monkeypatch.setattr(inverted, "BLOCK", 4)
    monkeypatch.setattr(inverted, "TASK_POSTINGS", limit)  # with 30, common terms are spread over tasks
    monkeypatch.setattr(inverted, "HELD_POSTINGS", 50)
    monkeypatch.setattr(inverted, "ROWS_OUT", 3)
    path, rows = scratch_path(spark, "index"), corpus(3, 250)
    inverted.build(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path)
    words = defaultdict(Counter)
    for doc, text in rows:
        words[doc].update((text or "").lower().encode().split())
    avgdl = sum(c.total() for c in words.values()) / len(words)
    postings = defaultdict(list)
    for doc, found in words.items():
        for word, tf in found.items():
            dl = found.total()
            postings[word.decode()].append((-(tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), doc, tf, dl))
    want = set()
    for word, entries in postings.items():
        entries.sort()
        for at in range(0, len(entries), 4):
            part, number = entries[at : at + 4], at // 4
            tier = 0 if number == 0 else int(math.log(number, 4) + 1e-12) + 1
            want.add((word, tier, tuple(e[1] for e in part), tuple(e[2] for e in part), tuple(e[3] for e in part), -part[0][0]))
    found = spark.read.parquet(f"{path}/blocks").collect()
    assert len(found) == len(want) and {(r["term"], r["tier"], tuple(r["ids"]), tuple(r["tfs"]), tuple(r["dls"]), r["peak"]) for r in found} == want
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{path}/docs").collect()}
    assert docs.keys() == words.keys() and all(
        r["dl"] == words[d].total() and r["terms"] == sorted(w.decode() for w in words[d]) and r["tfs"] == [words[d][w.encode()] for w in r["terms"]] for d, r in docs.items())


def test_a_pair_given_twice_is_one_row(spark):
    path = scratch_path(spark, "index")
    inverted.build(spark.createDataFrame([(1, "a b c"), (2, "b"), (3, "c d e"), (4, "x"), (5, "y z")], "doc_id long, text string"), path)
    index = inverted.load(spark, path)
    wanted = inverted.query_terms(index, spark.createDataFrame([(7, "a b")], "query_id long, query_text string"))
    once, twice, none = (spark.createDataFrame([(7, d) for d in ids], "query_id long, doc_id long") for ids in ((1, 2), (1, 2, 1), (4, 5)))
    got = {r["doc_id"]: r["bm25"] for r in inverted.score_pairs(index, wanted, once).collect()}
    again = [(r["doc_id"], r["bm25"]) for r in inverted.score_pairs(index, wanted, twice).collect()]
    assert sorted(again) == [(1, pytest.approx(2 * got[1])), (2, pytest.approx(got[2]))] and inverted.score_pairs(index, wanted, none).isEmpty()
