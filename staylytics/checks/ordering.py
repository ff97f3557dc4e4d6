"""Checks for set operations, head/tail, versions per model and exact quantiles."""

from pyspark.sql import functions as F

from staylytics.checks.registry import query
from staylytics.operators import marts, monitoring
from staylytics.operators.ordering import exact_quantile
from staylytics.operators.warehouse import check_out
from staylytics.sources.bookings import bookings
from staylytics.sources.models import model_records


@query("A9_exact_quantile", """
SELECT hotel, round(quantile_cont(adr_cents, 0.995), 6) AS p995 FROM bookings GROUP BY 1""")
def _(lake):
    return exact_quantile(bookings(lake).select("hotel", "adr_cents"), "adr_cents", 0.995, ["hotel"], "p995").withColumn("p995", F.round("p995", 6))


@query("U1_union_all", """
SELECT source, count(*) AS row_count, sum(orders)::BIGINT AS orders FROM (
 SELECT 'revenue' AS source, total_orders AS orders FROM branch_days UNION ALL SELECT 'staff', scheduled_employees FROM mart_staff
) GROUP BY 1""")
def _(lake):
    a = marts.mart_restaurant_daily(lake).select(F.lit("revenue").alias("source"), F.col("total_orders").alias("orders"))
    b = marts.mart_staff_daily(lake).select(F.lit("staff").alias("source"), F.col("scheduled_employees").alias("orders"))
    return a.unionByName(b).groupBy("source").agg(F.count("*").alias("row_count"), F.sum("orders").alias("orders"))


@query("U2_union_distinct", """
SELECT arrival_date::VARCHAR AS day FROM guest_rows UNION SELECT (arrival_date + nights)::VARCHAR FROM guest_rows""")
def _(lake):
    rows = bookings(lake)
    return rows.select(F.col("arrival_date").alias("day")).union(rows.select(check_out())).distinct()


@query("U3_set_difference", "SELECT (arrival_date + nights)::VARCHAR AS day FROM guest_rows EXCEPT SELECT arrival_date::VARCHAR FROM guest_rows")
def _(lake):
    rows = bookings(lake)
    return rows.select(check_out().alias("day")).subtract(rows.select("arrival_date"))


@query("K5_head_and_tail", """
(SELECT 'head' AS part, branch_id, date::VARCHAR AS date, total_revenue FROM mart_revenue ORDER BY date, branch_id LIMIT 50)
UNION ALL (SELECT 'tail', branch_id, date::VARCHAR, total_revenue FROM mart_revenue ORDER BY date DESC, branch_id DESC LIMIT 200)""")
def _(lake):
    mart = marts.mart_revenue_daily(lake).select("branch_id", "date", "total_revenue")
    head = mart.orderBy("date", "branch_id").limit(50).select(F.lit("head").alias("part"), "*")
    tail = mart.orderBy(F.desc("date"), F.desc("branch_id")).limit(200).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


@query("W15_version_per_model", "SELECT model_name, record_id, version FROM model_records")
def _(lake):
    return model_records(lake).select("model_name", "record_id", "version")


@query("K6_best_model_per_task", """
SELECT task, arg_max(model_name, (signed, model_name)) AS best_model, round(max(signed), 6) AS signed_metric FROM (
  SELECT model_name, task, CASE WHEN lower_is_better THEN -metric ELSE metric END AS signed FROM latest_metric WHERE metric IS NOT NULL)
GROUP BY 1""")
def _(lake):
    return monitoring.best_per_task(monitoring.latest_metrics(model_records(lake)))
