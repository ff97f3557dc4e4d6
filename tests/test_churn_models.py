"""Churn models in a session that has observed metrics before."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.plans import ml


@pytest.mark.parametrize("kind", ["random_forest", "boosted"])
def test_scores_after_an_observation(spark, kind):
    seen = Observation("seen")
    spark.range(10).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 10
    df = spark.range(400).select(F.col("id").alias("guest_key"), *[(F.col("id") % (k + 5)).cast("double").alias(c) for k, c in enumerate(C.CHURN_FEATURES)])
    df = df.withColumn("churn", (F.col("guest_key") % 5 > 2).cast("int")).withColumn("split", F.when(F.col("guest_key") % 4 == 0, "test").otherwise("train"))
    model = ml.fit_churn(df, kind, (3, 3))
    row = ml.evaluate_churn(model, df, "m").first()
    assert row["accuracy"] > 0.9 and row["roc_auc"] > 0.9
