"""Model and drift records derived from the order and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.operators.ordering import with_running_totals
from staylytics.sources.lake import Lake

TASKS = ["occupancy", "pricing", "restaurant", "staffing", "churn"]


def training_runs(lake: Lake) -> DataFrame:
    """One training run per order: the customer is the model, the price its error, the status its stage."""
    key = F.col("o_orderkey")
    mae = F.when(key % 41 != 0, F.col("o_totalprice") / 1000)
    return lake.table("orders").select(
        key.alias("record_id"), F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("model_name"),
        F.element_at(F.array(*[F.lit(t) for t in TASKS]), (F.col("o_custkey") % 5 + 1).cast("int")).alias("task"),
        F.col("o_orderdate").cast("timestamp").alias("trained_at"),
        F.when(F.col("o_orderstatus") == "P", "Production").when(F.col("o_orderstatus") == "F", "Archived")
        .otherwise("Staging").alias("stage"),
        F.map_filter(
            F.create_map(F.lit("mae"), mae, F.lit("rmse"), mae * 1.25, F.lit("roc_auc"), key % 1000 / 1000),
            lambda k, v: v.isNotNull(),
        ).alias("metrics"),
    )


def model_records(lake: Lake) -> DataFrame:
    """Training runs with a version number: the run's position within its model."""
    return with_running_totals(
        training_runs(lake), ["model_name"], ["trained_at", "record_id"], {"version": F.lit(1)}
    )


def drift_reports(lake: Lake) -> DataFrame:
    """One drift report per event; some carry no score."""
    k = F.get_json_object("props", "$.k").cast("int")
    return lake.table("events").select(
        "event_id", F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("module"),
        F.col("ts").alias("generated_at"), F.when(k % 17 != 0, k / 100).alias("drift_score"),
    )


def prediction_log(lake: Lake) -> DataFrame:
    """Prediction log lines; some are truncated, blank or without a time, as real logs are."""
    event = F.col("event_id")
    head = F.concat(
        F.lit('{"domain":"'), F.col("event_type"), F.lit('","value":'), F.col("value").cast("string"), F.lit(',"k":'),
        F.get_json_object("props", "$.k"), F.lit(',"cached":false'),
    )
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return lake.table("events").select(
        F.when(event % 97 == 0, F.concat(F.lit('{"domain":"'), F.col("event_type")))
        .when(event % 101 == 0, "")
        .when(event % 103 == 0, F.concat(head, F.lit("}")))
        .otherwise(F.concat(head, F.lit(',"_logged_at":"'), stamp, F.lit('"}')))
        .alias("value")
    )
