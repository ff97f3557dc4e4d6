"""Batch jobs composed of the operators, from raw rows to tables, reports and decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.operators import cleaning, features, marts, monitoring, warehouse
from staylytics.plans import ml
from staylytics.session import discard, settle
from staylytics.sources.bookings import booking_parts, bookings, raw_bookings
from staylytics.sources.calendar import calendar
from staylytics.sources.io import save_both, write_result
from staylytics.sources.lake import Lake
from staylytics.sources.models import drift_reports, model_records

PRIMARY_KEYS = {
    "dim_date": "date_key", "dim_hotel": "hotel_key", "dim_room_type": "room_type_key", "dim_guest": "guest_key",
    "fact_booking": "surrogate_key",
}
REQUIRED = {"fact_booking": ["surrogate_key", "room_key", "branch_key", "guest_key", "check_in_date_key"]}


def clean_job(lake: Lake, path: str) -> DataFrame:
    """Clean the raw rows, write them, and return what was written."""
    cleaning.clean(raw_bookings(lake), parts=booking_parts(lake)).write.mode("overwrite").parquet(path)
    return lake.spark.read.parquet(path)


def audited_clean_job(lake: Lake, path: str) -> tuple[DataFrame, DataFrame]:
    """``clean_job``, and the audit of its steps, observed in the same passes."""
    audit = cleaning.CleanAudit(lake.spark)
    cleaning.clean(raw_bookings(lake), audit, booking_parts(lake)).write.mode("overwrite").parquet(path)
    return lake.spark.read.parquet(path), audit.table()


def warehouse_job(lake: Lake, path: str) -> DataFrame:
    """Build and write the star schema, then validate what was written: keys per table, orphans per foreign key."""
    rows = settle(bookings(lake).drop("row_hash"))  # a hash does not compress; the fact computes its own
    tables = {
        "dim_date": warehouse.dim_date(rows), "dim_hotel": warehouse.dim_hotel(rows),
        "dim_room_type": warehouse.dim_room_type(rows), "dim_guest": warehouse.dim_guest(rows),
        "fact_booking": warehouse.fact_booking(rows),
    }
    for name, table in tables.items():
        save_both(table, f"{path}/{name}")
    discard(rows)  # from here on only what was written is read
    stored = {name: lake.spark.read.parquet(f"{path}/{name}/parquet") for name in tables}
    checks = [
        warehouse.key_check(n, t, PRIMARY_KEYS[n], REQUIRED.get(n, [])).select(
            F.lit("table").alias("kind"), F.col("table_name").alias("name"), F.col("row_count").alias("rows_or_orphans"),
            (F.col("pk_unique") & (F.col("null_violations") == 0)).alias("ok"),
        )
        for n, t in stored.items()
    ]
    fact = stored["fact_booking"]
    links = [
        ("room_key", "dim_room_type"), ("branch_key", "dim_hotel"), ("guest_key", "dim_guest"),
        ("check_in_date_key", "dim_date"), ("check_out_date_key", "dim_date"),
    ]
    orphans = [
        warehouse.foreign_key_check(c, fact, c, stored[parent], PRIMARY_KEYS[parent]).select(
            F.lit("foreign_key").alias("kind"), F.col("fk_name").alias("name"),
            F.col("orphan_count").alias("rows_or_orphans"), (F.col("orphan_count") == 0).alias("ok"),
        )
        for c, parent in links
    ]
    return reduce(DataFrame.unionByName, [*checks, *orphans])


def feature_job(lake: Lake, path: str, report_columns: list[str]) -> DataFrame:
    """Write the five feature tables and report their sizes, with means and strongest correlations of the occupancy
    table; the daily mart is stored once and read by all that need it."""
    spark, rows, cal = lake.spark, settle(bookings(lake)), calendar(lake)
    fact = warehouse.fact_rows(rows)
    marts.daily_occupancy(fact).write.mode("overwrite").parquet(f"{path}/daily")
    daily = spark.read.parquet(f"{path}/daily")
    tables = {
        "occupancy": features.occupancy_features(daily, cal),
        "pricing": features.pricing_features(daily, cal, warehouse.dim_room_type(rows)),
        "restaurant": features.restaurant_features(marts.mart_restaurant_daily(lake), cal),
        "staff": features.staff_features(marts.mart_staff_daily(lake), cal),
        "churn": features.churn_features(warehouse.dim_guest(rows), fact),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    counts = [
        spark.read.parquet(f"{path}/{n}").agg(F.count("*").cast("double").alias("value")).select(F.lit(n).alias("domain"), F.lit("rows").alias("name"), "value")
        for n in tables
    ]
    statistics, correlations = feature_reports(path, lake, "occupancy", report_columns)
    return reduce(DataFrame.unionByName, [
        *counts,
        statistics.select(F.lit("occupancy").alias("domain"), F.concat(F.lit("mean of "), "column_name").alias("name"), F.col("mean").alias("value")),
        correlations.select(F.lit("occupancy").alias("domain"), F.concat_ws(" with ", "feature_a", "feature_b").alias("name"), F.col("abs_corr").alias("value")),
    ])


def feature_reports(path: str, lake: Lake, domain: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Statistics and strongest correlations of a written feature table."""
    df = lake.spark.read.parquet(f"{path}/{domain}")
    return features.column_statistics(df, columns), features.top_correlations(df, columns)


def train_domain(lake: Lake, domain: str, sizes: dict[str, tuple[int, int]], path: str) -> DataFrame:
    """Train, evaluate, save and report one domain; returns the metrics as (model_name, metric, value)."""
    rows, cal = bookings(lake), calendar(lake)
    if domain == "churn":
        df = settle(ml.churn_table(warehouse.dim_guest(rows), warehouse.fact_rows(rows)))
        kinds = ["random_forest", "boosted"]
        fits = ml.side_by_side(lambda k: ml.fit_churn(df, k, sizes["forest" if k == "random_forest" else "churn"]), kinds)
        models = dict(zip(kinds, fits, strict=True))
        results = [ml.evaluate_churn(m, df, f"churn_{k}") for k, m in models.items()]
    elif domain == "restaurant":
        df = settle(ml.restaurant_table(marts.mart_restaurant_daily(lake), cal))
        models = ml.fit_meals(df, sizes["restaurant"])
        results = [ml.evaluate_regressor(m, df, f"{k}_revenue", f"restaurant_{k}") for k, m in models.items()]
    else:
        if domain == "occupancy":
            df = ml.occupancy_table(marts.daily_occupancy(warehouse.fact_rows(rows)), cal)
            inputs, label = C.OCCUPANCY_FEATURES, "occupancy_pct"
        elif domain == "pricing":
            daily = marts.daily_occupancy(warehouse.fact_rows(rows))
            df = ml.scaled_prices(ml.pricing_table(daily, cal, warehouse.dim_room_type(rows)))
            inputs, label = C.PRICING_FEATURES, "avg_daily_rate"
        elif domain == "staffing":
            df = ml.staffing_table(marts.mart_staff_daily(lake), cal)
            inputs, label = C.STAFFING_FEATURES, "present_employees"
        else:
            raise ValueError(f"unknown domain {domain}")
        df = settle(df)
        models = {"boosted": ml.fit_regressor(df, inputs, label, sizes[domain])}
        results = [ml.evaluate_regressor(models["boosted"], df, label, f"{domain}_boosted")]
    for key, model in models.items():
        model.write().overwrite().save(f"{path}/models/{domain}_{key}")
    metrics = [c for c in results[0].columns if c not in ("model_name", "n", "tp", "fp", "fn")]
    long = reduce(DataFrame.unionByName, results).unpivot(["model_name"], metrics, "metric", "value")
    write_result(long.select(F.lit(domain).alias("task"), "*"), path, domain)
    return lake.spark.read.schema("task string, model_name string, metric string, value double").json(f"{path}/latest_{domain}.json")


def train_domains(lake: Lake, domains: list[str], sizes: dict[str, tuple[int, int]], path: str) -> DataFrame:
    """The metrics of several domains, trained side by side."""
    return reduce(DataFrame.unionByName, ml.side_by_side(lambda d: train_domain(lake, d, sizes, f"{path}/{d}"), domains))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Best model per task by its primary metric: ROC-AUC for churn, MAPE elsewhere."""
    churn = F.col("task") == "churn"
    primary = metrics.where(F.col("metric") == F.when(churn, "roc_auc").otherwise("mape"))
    signed = F.when(churn, F.col("value")).otherwise(-F.col("value"))
    return primary.groupBy("task").agg(
        F.max_by("model_name", F.struct(signed, "model_name")).alias("best_model"),
        F.max_by("value", F.struct(signed, "model_name")).alias("value"),
    )


def retrain_decision(lake: Lake) -> DataFrame:
    """Models to retrain now, with the verdict on their newest staging version."""
    records = model_records(lake)
    signals = monitoring.retrain_signals(records, drift_reports(lake))
    verdict = monitoring.beats_production(monitoring.stage_summary(records)).select("model_name", "beats_production")
    return signals.where("retrain").join(verdict, "model_name", "left").select("model_name", "drift_breached", "accuracy_breached", "beats_production")
