"""Checks for file sources and sinks."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.marts import daily
from staylytics.checks.registry import query
from staylytics.operators import monitoring
from staylytics.session import scratch_path, settle
from staylytics.sources import io
from staylytics.sources.bookings import raw_bookings
from staylytics.sources.models import model_records


@query("S1_strict_csv_scan", """
SELECT hotel, country, count(*) AS row_count, sum(adr_cents)::BIGINT AS cents, count(children) AS with_children,
  count(*) FILTER (WHERE reservation_status_date = 'unknown') AS unknown_dates FROM raw_bookings GROUP BY 1, 2""")
def _(lake):
    path = scratch_path(lake.spark, "raw-csv")
    raw = raw_bookings(lake).withColumn("adr", F.col("adr_cents") / 100).select(*C.RAW_COLUMNS)
    io.write_csv(raw, path)
    return io.read_raw_bookings(lake.spark, path).groupBy("hotel", "country").agg(
        F.count("*").alias("row_count"), F.sum(F.round(F.col("adr") * 100).cast("long")).alias("cents"),
        F.count("children").alias("with_children"), F.count_if(F.col("reservation_status_date") == "unknown").alias("unknown_dates"),
    )


@query("S7_log_sink", """
SELECT event_type AS domain, 2 * count(*) AS records, 2 * count(value) AS stamped FROM events GROUP BY 1""")
def _(lake):
    path = scratch_path(lake.spark, "log")
    batch = lake.table("events").select(F.col("event_type").alias("domain"), "event_id", "value")
    io.append_log(batch, path)
    io.append_log(batch, path)
    back = lake.spark.read.schema("event_id long, value double, _logged_at timestamp, domain string").json(path)
    return back.groupBy("domain").agg(F.count("*").alias("records"), F.count("_logged_at").alias("stamped"))


@query("S9_parquet_and_csv_sink", """
SELECT format, branch_id, count(*) AS row_count, sum(occupied_rooms)::BIGINT AS rooms FROM daily_base CROSS JOIN (VALUES ('csv'), ('parquet')) f(format) GROUP BY 1, 2""")
def _(lake):
    path = scratch_path(lake.spark, "dual")
    io.save_both(daily(lake), path)
    a = lake.spark.read.parquet(f"{path}/parquet").select(F.lit("parquet").alias("format"), "branch_id", "occupied_rooms")
    b = lake.spark.read.option("header", True).csv(f"{path}/csv").select(
        F.lit("csv").alias("format"), F.col("branch_id").cast("int").alias("branch_id"), F.col("occupied_rooms").cast("long").alias("occupied_rooms")
    )
    return a.unionByName(b).groupBy("format", "branch_id").agg(F.count("*").alias("row_count"), F.sum("occupied_rooms").alias("rooms"))


@query("S11_table_guard", "SELECT 'known' AS kind, count(*) AS row_count FROM orders UNION ALL SELECT 'unknown', NULL")
def _(lake):
    lake.table("orders").createOrReplaceTempView("stay_guarded_orders")
    known = io.require_table(lake.spark, "stay_guarded_orders").agg(F.count("*").alias("row_count"))
    out = known.select(F.lit("known").alias("kind"), "row_count")
    try:
        io.require_table(lake.spark, "stay_no_such_table")
    except io.MissingTable:
        out = out.unionByName(known.select(F.lit("unknown").alias("kind"), F.lit(None).cast("long").alias("row_count")))
    return out


@query("S13_latest_reports", """
SELECT task AS module, count(*) AS models, count(metric) AS with_metric FROM latest_metric GROUP BY 1""")
def _(lake):
    path = scratch_path(lake.spark, "reports")
    latest = monitoring.latest_metrics(model_records(lake))
    for task in ("occupancy", "pricing", "restaurant", "staffing", "churn"):
        io.write_result(latest.where(F.col("task") == task), path, task)
    return io.read_latest_reports(lake.spark, path).groupBy("module").agg(
        F.count("*").alias("models"), F.count("metric").alias("with_metric")
    )


@query("S15_history_and_latest_sink", """
SELECT 'history' AS part, 2 * count(*) AS row_count FROM dim_guest UNION ALL SELECT 'latest', count(*) FROM dim_guest""")
def _(lake):
    from staylytics.operators.warehouse import dim_guest
    from staylytics.sources.bookings import bookings

    path = scratch_path(lake.spark, "versions")
    guests = settle(dim_guest(bookings(lake)).select("guest_key", "lifetime_bookings"))  # written twice, counted once
    io.write_result(guests, path, "guests")
    io.write_result(guests, path, "guests")
    history = lake.spark.read.json(f"{path}/history/guests").agg(F.count("*").alias("row_count"))
    latest = io.read_latest_reports(lake.spark, path).agg(F.count("*").alias("row_count"))
    return history.select(F.lit("history").alias("part"), "row_count").unionByName(latest.select(F.lit("latest").alias("part"), "row_count"))


@query("S16_materialise_once", "SELECT branch_id, count(*) AS row_count FROM daily_base GROUP BY 1")
def _(lake):
    path = scratch_path(lake.spark, "seed")
    io.ensure(lake.spark, path, lambda: daily(lake).select("branch_id", "occupancy_date"))
    again = io.ensure(lake.spark, path, lambda: lake.spark.range(1).select(F.col("id").cast("int").alias("branch_id")))
    return again.groupBy("branch_id").agg(F.count("*").alias("row_count"))
