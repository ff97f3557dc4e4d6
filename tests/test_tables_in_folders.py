"""Streams over tables that are a folder of files, whole hashes and whole scores over odd documents."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from staylytics.operators import inverted
from staylytics.session import scratch_path
from staylytics.sources.lake import Lake
from staylytics.streaming import jobs


@pytest.fixture(scope="module")
def root(spark):
    path = scratch_path(spark, "tables")
    texts = ["one two", "one two", "two\r\nthree", "", None, "tab\tand \\n"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(1, "one two"), (1, "other")], "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_a_folder_is_streamed_like_a_file(spark, root):
    got = {r["hash"] for r in jobs.distinct_documents(jobs.file_stream(spark, root, "documents.parquet")).collect()}
    want = {r["hash"] for r in Lake(spark, root).table("documents").select(F.sha2("text", 256).alias("hash")).distinct().collect()}
    assert got == want and len(got) == 6


def test_a_file_is_streamed(spark):
    source = "/root/testdata/sf0.001"
    got = jobs.distinct_documents(jobs.file_stream(spark, source, "documents.parquet")).count()
    assert got == Lake(spark, source).table("documents").select("text").distinct().count()


def test_each_document_is_hashed(spark, root):
    got = sorted(map(tuple, entry.queries()["S12_document_hashes"](spark, root).collect()), key=repr)
    rows = Lake(spark, root).table("documents").collect()
    want = [(f"doc-{r['doc_id']}", r["text"] if r["text"] is None else hashlib.sha256((r["text"] + "\n").encode()).hexdigest()) for r in rows]
    assert got == sorted(want, key=repr)


def test_every_document_with_a_common_term_is_scored(spark):
    docs = spark.createDataFrame([(k, "common " * (k % 3 + 1) + f"word{k % 7} " * (k % 2)) for k in range(60)], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "common word3"), (2, "word5"), (3, "absent")], "query_id long, query_text string")
    path = scratch_path(spark, "index")
    inverted.build(docs, path)
    index = inverted.load(spark, path)
    found = inverted.ranked(inverted.scores(index, queries)).collect()
    sizes = {q: sum(r["query_id"] == q for r in found) for q in (1, 2, 3)}
    assert sizes == {1: 60, 2: sum(k % 7 == 5 and k % 2 == 1 for k in range(60)), 3: 0}
    top = {(r["query_id"], r["doc_id"]): r for r in inverted.scaled(inverted.top_k(index, queries, 5).top).collect()}
    for q in (1, 2):
        rows = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, sizes[q] + 1))
        assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in sorted(rows, key=lambda r: (-round(r["bm25"], 9), r["doc_id"]))]
        for r in rows[:4]:
            same = top[q, r["doc_id"]]
            assert same["rank"] == r["rank"] and abs(same["bm25"] - r["bm25"]) < 1e-9 and abs(same["sparse"] - r["sparse"]) < 1e-9
