"""Corpus pipeline: quality filter, near-duplicate removal, source mixing and packing, each stage written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylytics.llm import mixing, ngram_join, packing, quality
from staylytics.session import reachable, settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7; the model is fitted on labelled rows of ``docs``."""
    return quality.keep_good(docs, reachable(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest doc_id."""
    reachable(spark)
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents left out, taken once, or taken twice."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2048 words."""
    reachable(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# A fitted classifier and best-fit bins are beyond SQL; tests/llm holds both stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
