"""The booking fact: positions as before, and no content hash in its files."""

from pyspark.sql import functions as F

from staylytics.operators import ordering


def test_columns_of_the_order_alone_are_not_stored(spark, monkeypatch):
    stored = []
    settle = ordering.settle
    monkeypatch.setattr(ordering, "settle", lambda df: stored.append(df.columns) or settle(df))
    df = spark.range(500).select("id", (F.col("id") % 7).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    as_text = {r["id"]: r["row_index"] for r in ordering.with_global_index(df, ["k", "h"]).collect()}
    as_bytes = {r["id"]: r["row_index"] for r in ordering.with_global_index(df.withColumn("h", F.unhex("h")), ["k", "h"], drop=["h"]).collect()}
    assert as_text == as_bytes and sorted(as_text.values()) == list(range(500))
    assert "h" in stored[0] and "h" not in stored[1]
