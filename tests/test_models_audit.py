"""Cleaning audit observed in the write, and the forms of fitted tables."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.operators import cleaning
from staylytics.plans import jobs, ml
from staylytics.session import scratch_path
from staylytics.sources.bookings import raw_bookings
from staylytics.sources.lake import Lake

ROOT = "/root/testdata/sf0.001"


def test_audit_equals_counts_of_the_steps(spark):
    """Every number of the audit against the same count taken by a pass of its own."""
    raw = raw_bookings(Lake(spark, ROOT))
    written, audit = jobs.audited_clean_job(Lake(spark, ROOT), scratch_path(spark, "clean"))
    got = {r["step"]: r for r in audit.collect()}
    assert [r["step_no"] for r in audit.orderBy("step_no").collect()] == list(range(1, 12))
    unique = cleaning.dedupe_full_row(raw)
    n, u = raw.count(), unique.count()
    assert (got["dedupe_full_row"]["rows_before"], got["dedupe_full_row"]["rows_after"], got["dedupe_full_row"]["values_changed"]) == (n, u, n - u)
    undefined = sum(unique.where(F.col(c) == "Undefined").count() for c in C.SENTINEL_COLUMNS)
    assert got["replace_undefined_with_null"]["values_changed"] == undefined > 0
    assert got["impute_missing_country"]["values_changed"] == unique.where("country IS NULL").count()
    kept = cleaning.drop_negative_rates(unique)
    assert got["clean_adr"]["rows_after"] == kept.count() == written.count()
    assert got["check_cancellation_consistency"]["extra"] == kept.where(cleaning.cancellation_mismatch()).count()
    assert got["build_arrival_date"]["extra"] == written.where("arrival_date IS NULL").count()
    assert cleaning.clean(raw).count() == written.count()


def test_audit_of_no_rows(spark):
    audit = cleaning.CleanAudit(spark)
    assert cleaning.clean(raw_bookings(Lake(spark, ROOT)).limit(0), audit).collect() == []
    assert {(r["rows_before"], r["rows_after"]) for r in audit.table().collect()} == {(0, 0)}


def test_fits_are_dealt_over_the_cores(spark):
    few, many = spark.range(100).repartition(7), spark.range(200_000).repartition(2)
    assert ml._gathered(few).rdd.getNumPartitions() == 1
    assert ml._gathered(many).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_a_regressor_beats_the_mean(spark):
    df = spark.range(600).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("y", F.col("x") * 2 + F.col("z")).withColumn("split", F.when(F.col("x") % 5 == 0, "test").otherwise("train"))
    model = ml.fit_regressor(df, ["x", "z"], "y", (10, 3))
    row = ml.evaluate_regressor(model, df, "y", "m").first()
    assert row["rmse"] < 0.8 * row["naive_rmse"] and row["n"] == 120
