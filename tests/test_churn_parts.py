"""Churn fits on parts of equal rows."""

import math

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.plans import ml


def _guests(spark, n):
    df = spark.range(n).select(F.col("id").alias("guest_key"), *[(F.col("id") % (k + 3)).cast("double").alias(c) for k, c in enumerate(C.CHURN_FEATURES)])
    return df.withColumn("churn", (F.col("guest_key") % 4 == 0).cast("int")).withColumn("split", F.when(F.col("guest_key") % 10 == 9, "test").otherwise("train"))


def test_a_fit_reads_parts_that_weigh_as_much_as_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ml, "PARTS", 500, raising=False)
    seen, gathered = [], ml._gathered

    def noted(train, *least):
        seen.append(train.agg(F.count("*"), F.sum(F.when(F.col("churn") == 1, F.col("_weight"))), F.sum(F.when(F.col("churn") == 0, F.col("_weight")))).first())
        return gathered(train, *least)

    monkeypatch.setattr(ml, "_gathered", noted)
    df = _guests(spark, 200_000)
    train = df.where("split = 'train'")
    rows, cells = train.count(), train.select(*C.CHURN_FEATURES, "churn").distinct().count()
    for kind in ("random_forest", "boosted"):
        ml.fit_churn(df, kind, (2, 2))
    assert all(n <= 500 + cells < rows / 10 for n, _, _ in seen)
    negatives = train.where("churn = 0").count()
    for (_, pos, neg), both in zip(seen, ((rows / 2, rows / 2), (negatives, negatives)), strict=True):
        assert math.isclose(pos, both[0], rel_tol=1e-9) and math.isclose(neg, both[1], rel_tol=1e-9)


def test_rows_of_a_small_table_are_drawn_one_by_one(spark):
    df = _guests(spark, 1_000)
    binned = ml.Bucketizer(splitsArray=ml._edges(df, C.CHURN_FEATURES), inputCols=C.CHURN_FEATURES, outputCols=ml._BINNED)
    assert ml._parts(df, "churn", binned, balanced=True).count() == 1_000


def test_bins_part_few_values_and_follow_quantiles_of_many(spark):
    df = spark.range(10_000).select((F.col("id") % 3).cast("int").alias("few"), F.col("id").cast("double").alias("many"), F.lit(7).alias("one"))
    few, many, one = ml._edges(df, ["few", "many", "one"])
    assert few == [-math.inf, 0.5, 1.5, math.inf] and one == [-math.inf, 0.0, math.inf]
    assert len(many) == ml.BINS + 1 and all(abs(x - i * 10_000 / ml.BINS) <= 2 for i, x in enumerate(many[1:-1], 1))


def test_every_row_gets_the_probability_of_the_model(spark):
    df = _guests(spark, 2_000)
    model = ml.fit_churn(df, "boosted", (3, 3))
    direct = {r["guest_key"]: (r["prediction"], r["probability"][1]) for r in model.transform(df).collect()}
    found = ml.churn_probabilities(model, df)
    assert found.columns == [*df.columns, "prediction", "probability"]
    assert {r["guest_key"]: (r["prediction"], r["probability"]) for r in found.collect()} == direct


def test_boosted_fits_of_few_rows_are_one_task_a_stage(spark):
    assert ml._gathered(spark.range(12_000)).rdd.getNumPartitions() == 1
