"""Prediction drift kept up to date batch by batch, from stored sums per hour.

A batch adds its own file of moments per (domain, field, hour) and its records. The windows of the report end at each
domain's newest record, so they begin inside an hour: whole hours come from the moments, the two hours that an edge
cuts from the records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylytics.operators.joins import null_safe_join
from staylytics.operators.monitoring import drift_verdict, log_fields, parse_log, window_label, with_marker
from staylytics.streaming.sinks import batches, write_batch

_RECORDS = "domain string, logged_at timestamp, fields map<string,string>, hour timestamp"
_MOMENTS = "domain string, field string, hour timestamp, n long, mean double, m2 double, newest timestamp"


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    n = F.col("number")
    return rows.groupBy("domain", "field", *keys).agg(
        F.count("*").alias("n"), F.avg(n).alias("mean"), (F.var_pop(n) * F.count("*")).alias("m2"), F.max("logged_at").alias("newest")
    )


def _numbers(log: DataFrame, *keep: str) -> DataFrame:
    return log_fields(with_marker(log), "logged_at", *keep)


def drift_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writer of micro-batches of log lines below ``path``; replaying a batch leaves the same state."""

    def write(lines: DataFrame, batch_id: int) -> None:
        write_batch(parse_log(lines).withColumn("hour", F.date_trunc("hour", "logged_at")).select("domain", "logged_at", "fields", "hour"), f"{path}/records", batch_id)
        landed = lines.sparkSession.read.schema(_RECORDS).parquet(f"{path}/records/batch={batch_id}")
        write_batch(_moments(_numbers(landed, "hour"), "hour"), f"{path}/moments", batch_id)

    return write


def _merged(moments: DataFrame, *keys: str) -> DataFrame:
    """Moments of the union: squares are taken around the common mean, so nothing cancels out."""
    group = Window.partitionBy(*keys)
    total = F.sum("n").over(group)
    centred = moments.withColumn("_mean", F.sum(F.col("n") * F.col("mean") / total).over(group))
    off = F.col("mean") - F.col("_mean")
    return centred.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2")
    )


def drift_report(spark: SparkSession, path: str, window_days: int = 7) -> DataFrame:
    """The report of ``monitoring.prediction_drift`` over all batches so far, from the stored moments."""
    moments = batches(spark, f"{path}/moments", _MOMENTS).drop("batch")
    records = batches(spark, f"{path}/records", _RECORDS).drop("batch")
    now = moments.groupBy("domain").agg(F.max("newest").alias("now"))

    def label(t: Column) -> Column:
        return window_label(t, F.col("now"), window_days)

    hour_end = F.col("hour") + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MICROSECOND")
    placed = null_safe_join(moments, now, ["domain"]).withColumn("window", label(F.col("hour")))
    whole = placed.where(F.col("window").eqNullSafe(label(hour_end)) & F.col("window").isNotNull())
    edges = now.select("domain", "now", F.explode(F.array(*[F.date_trunc("hour", F.col("now") - F.expr(f"INTERVAL {k * int(window_days)} DAYS")) for k in (1, 2)])).alias("hour"))
    cut = null_safe_join(records, edges, ["domain", "hour"]).withColumn("window", label(F.col("logged_at"))).where("window IS NOT NULL")
    parts = whole.select("domain", "field", "window", "n", "mean", "m2").union(
        _moments(_numbers(cut, "window"), "window").select("domain", "field", "window", "n", "mean", "m2")
    )
    each = _merged(parts, "domain", "field", "window")

    def of(window: str, c: Column | str) -> Column:
        return F.max(F.when(F.col("window") == window, c))

    spread = F.sqrt(F.col("m2") / F.col("n"))
    return drift_verdict(each.groupBy("domain", "field").agg(
        *[F.coalesce(of(w, F.col("n")), F.lit(0)).alias(f"n_{w}") for w in ("recent", "prior")],
        *[of(w, c).alias(f"{w}_{name}") for w in ("recent", "prior") for name, c in (("mean", F.col("mean")), ("std", spread))],
    ))
