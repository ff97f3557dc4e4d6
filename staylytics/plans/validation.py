"""Nightly dataset validation and lexicon snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.functions.arrays import exploded
from staylytics.operators.monitoring import fingerprint, ks_drift


def validate_domains(snapshot: DataFrame, current: DataFrame, is_current: Column, value: str, columns: Sequence[str]) -> DataFrame:
    """Per domain: fingerprint now, changed since the stored snapshot, and drift of ``value`` against it."""
    now = fingerprint(current, columns, ["domain"])
    before = fingerprint(snapshot, columns, ["domain"]).select("domain", F.col("content_hash").alias("old_hash"))
    drift = ks_drift(current.select("domain", is_current.alias("is_current"), F.col(value).alias("v")), ["domain"])
    return now.join(before, "domain", "left").join(drift, "domain", "left").select(
        "domain", "row_count", "content_hash", (~F.col("content_hash").eqNullSafe(F.col("old_hash"))).alias("changed"), "ks", "drifted",
    )


def lexicon_snapshot(reviews: DataFrame, entries: Sequence[str]) -> DataFrame:
    """Lexicon entries in use per hotel: count and hash of the sorted list (at most the lexicon's size per hotel)."""
    low = F.lower("review")
    used = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(w)), w) for w in entries]))
    seen = exploded(reviews, used, "entry", "hotel_id").distinct()
    return seen.groupBy("hotel_id").agg(
        F.count("*").alias("vocab_size"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("entry"))), 256).alias("content_hash")
    )
