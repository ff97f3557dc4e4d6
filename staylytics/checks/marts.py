"""Checks for daily marts, joins between them and parameterised reads."""

from pyspark.sql import functions as F

from staylytics.checks.registry import query
from staylytics.operators import features
from staylytics.operators import marts as ops
from staylytics.operators import warehouse
from staylytics.operators.windows import ordered
from staylytics.session import scratch_path
from staylytics.sources.bookings import bookings
from staylytics.sources.sql import run_query_file


def daily(lake):
    return ops.daily_occupancy(warehouse.fact_rows(bookings(lake)))


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("A6_daily_occupancy", """
SELECT branch_id, branch_name, occupancy_date::VARCHAR AS occupancy_date, occupied_rooms, total_rooms,
  occupancy_pct, total_revenue, avg_daily_rate,
  round(revenue_7day_avg, 6) AS revenue_7day_avg, round(occupancy_7day_avg, 6) AS occupancy_7day_avg,
  round(occupancy_30day_avg, 6) AS occupancy_30day_avg FROM daily_occ""")
def _(lake):
    return rounded(daily(lake), "revenue_7day_avg", "occupancy_7day_avg", "occupancy_30day_avg")


@query("W3_trailing_mean_or_current", """
SELECT branch_id, date::VARCHAR AS date, round(revenue_7day_avg, 4) AS revenue_7day_avg FROM mart_revenue""")
def _(lake):
    return ops.mart_revenue_daily(lake).select("branch_id", "date", F.round("revenue_7day_avg", 4).alias("revenue_7day_avg"))


@query("S6_mart_resolver", """
SELECT 'mart_occupancy_daily' AS mart, count(*) AS row_count FROM daily_occ
UNION ALL SELECT 'mart_restaurant_daily', count(*) FROM mart_restaurant
UNION ALL SELECT 'mart_revenue_daily', count(*) FROM mart_revenue UNION ALL SELECT 'mart_staff_daily', count(*) FROM mart_staff""")
def _(lake):
    from functools import reduce

    from staylytics.sources.marts import get_mart, list_marts

    return reduce(lambda a, b: a.unionByName(b), [
        get_mart(lake, n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("mart"), "row_count")
        for n in list_marts()
    ])


@query("J1_mart_inner_join", """
SELECT o.branch_id, o.occupancy_date::VARCHAR AS date, o.total_rooms, o.occupancy_pct, r.avg_daily_rate, r.room_revenue, r.total_revenue, r.revpar
FROM daily_occ o JOIN mart_revenue r ON r.branch_id = o.branch_id AND r.date = o.occupancy_date ORDER BY 1, 2""")
def _(lake):
    o = ops.mart_occupancy_daily(daily(lake)).select("branch_id", "date", "total_rooms", "occupancy_pct")
    r = ops.mart_revenue_daily(lake).select(
        "branch_id", "date", "avg_daily_rate", "room_revenue", "total_revenue", "revpar"
    )
    return o.join(r, ["branch_id", "date"]).orderBy("branch_id", "date")


@query("J2_guest_left_join", """
SELECT g.guest_key, g.nationality, g.lifetime_bookings, g.lifetime_spend, g.first_stay_date::VARCHAR AS first_stay_date,
  g.last_stay_date::VARCHAR AS last_stay_date, count(b.guest_key) AS completed_bookings,
  coalesce(sum(b.nights), 0)::BIGINT AS total_nights, coalesce(sum(b.total_amount_cents)::BIGINT / (nullif(count(b.guest_key), 0) * 100), 0) AS avg_spend_per_stay
FROM dim_guest g LEFT JOIN guest_rows b ON b.guest_key = g.guest_key AND b.is_completed GROUP BY 1, 2, 3, 4, 5, 6""")
def _(lake):
    rows = bookings(lake)
    return ops.guest_history(warehouse.dim_guest(rows), warehouse.fact_rows(rows)).drop("guest_id", "full_name")


@query("P14_key_and_date_range", """
SELECT branch_id, occupancy_date::VARCHAR AS occupancy_date, occupied_rooms, occupancy_pct
FROM daily_occ WHERE branch_id = 1 AND occupancy_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' ORDER BY 2""")
def _(lake):
    wanted = (F.col("branch_id") == 1) & F.col("occupancy_date").between("1996-01-01", "1998-12-31")
    columns = ["branch_id", "occupancy_date", "occupied_rooms", "occupancy_pct"]
    return daily(lake).where(wanted).select(*columns).orderBy("occupancy_date")


@query("S4_parameterised_sql", """
SELECT branch_id, department_name, date::VARCHAR AS date, scheduled_employees, present_employees
FROM mart_staff WHERE branch_id = 1 AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' ORDER BY 2, 3""")
def _(lake):
    text = """SELECT branch_id, department_name, date, scheduled_employees, present_employees FROM {mart}
      WHERE branch_id = :branch_id AND date BETWEEN :start_date AND :end_date ORDER BY department_name, date"""
    path = scratch_path(lake.spark, "sql")
    lake.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return run_query_file(
        lake.spark, path, {"branch_id": 1, "start_date": "2024-01-05", "end_date": "2024-01-25"},
        mart=ops.mart_staff_daily(lake),
    )


@query("A26_nights_per_guest", "SELECT guest_key, sum(nights)::BIGINT AS total_nights FROM guest_rows GROUP BY 1")
def _(lake):
    return warehouse.fact_rows(bookings(lake)).groupBy("guest_key").agg(F.sum("nights").alias("total_nights"))


@query("A7_cancellation_ratio", """
SELECT guest_key, avg((reservation_status = 'Canceled')::INT) AS cancellation_ratio FROM guest_rows GROUP BY 1""")
def _(lake):
    return features.guest_totals(warehouse.fact_rows(bookings(lake))).select(
        "guest_key", "cancellation_ratio"
    )


@query("J6_left_join_totals", """
SELECT g.guest_key, g.lifetime_bookings, coalesce(t.nights, 0)::BIGINT AS completed_nights FROM dim_guest g LEFT JOIN
 (SELECT guest_key, sum(nights) AS nights FROM guest_rows WHERE is_completed GROUP BY 1) t ON t.guest_key = g.guest_key""")
def _(lake):
    rows = bookings(lake)
    totals = features.guest_totals(warehouse.fact_rows(rows).where("is_completed"))
    return warehouse.dim_guest(rows).join(totals, "guest_key", "left").select(
        "guest_key", "lifetime_bookings", F.coalesce("total_nights", F.lit(0)).alias("completed_nights")
    )


_FACTOR = "(CASE WHEN isodow(occupancy_date) >= 6 THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END)"


@query("M6_expected_meal_revenue", f"""
SELECT branch_id, occupancy_date::VARCHAR AS date, round(8.0::DOUBLE * occupied_rooms * {_FACTOR}, 2) AS breakfast_revenue,
  round(6.0::DOUBLE * occupied_rooms * {_FACTOR}, 2) AS lunch_revenue,
  round(12.0::DOUBLE * occupied_rooms * {_FACTOR}, 2) AS dinner_revenue FROM daily_base""")
def _(lake):
    return ops.expected_meal_revenue(daily(lake))


@query("M6_expected_staff", f"""
SELECT branch_id, occupancy_date::VARCHAR AS date, id AS department_id, dept AS department_name,
  ceil(ratio * occupied_rooms * {_FACTOR})::BIGINT AS scheduled_employees
FROM daily_base, (VALUES (1, 'Reception', 0.03::DOUBLE), (2, 'Kitchen', 0.05::DOUBLE), (3, 'Housekeeping', 0.08::DOUBLE)) d(id, dept, ratio)""")
def _(lake):
    return ops.expected_staff(daily(lake))


@query("K1_multi_key_sort", """
SELECT department_name, date::VARCHAR AS date, branch_id, present_employees FROM mart_staff ORDER BY 1, 2, 3""")
def _(lake):
    return ops.mart_staff_daily(lake).select("department_name", "date", "branch_id", "present_employees").orderBy(
        "department_name", "date", "branch_id"
    )


@query("W6_latest_row_per_group", """
SELECT branch_id, date::VARCHAR AS date, total_revenue FROM mart_revenue
QUALIFY row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) = 1""")
def _(lake):
    return ops.mart_revenue_daily(lake).groupBy("branch_id").agg(
        F.max("date").alias("date"), F.max_by("total_revenue", "date").alias("total_revenue")
    )


@query("W7_eighth_from_last", """
SELECT branch_id, date::VARCHAR AS date, occupancy_pct, week_ago FROM (
 SELECT branch_id, date, occupancy_pct, lag(occupancy_pct, 7) OVER w AS week_ago, count(*) OVER (PARTITION BY branch_id) AS n,
  row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) AS rn FROM mart_revenue WINDOW w AS (PARTITION BY branch_id ORDER BY date))
WHERE rn = 1 AND n >= 8""")
def _(lake):
    from staylytics.operators.insights import last_and_week_ago

    return last_and_week_ago(ops.mart_revenue_daily(lake), "branch_id", "occupancy_pct").where("row_count >= 8").select(
        "branch_id", "date", F.col("latest").alias("occupancy_pct"), "week_ago"
    )


@query("W8_mean_of_previous_seven", """
SELECT branch_id, round(avg_7d, 6) AS avg_7d FROM (SELECT branch_id, date,
  avg(total_orders) OVER (PARTITION BY branch_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS avg_7d FROM mart_restaurant)
QUALIFY row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) = 1""")
def _(lake):
    mean = F.avg("total_orders").over(ordered(["branch_id"], "date").rowsBetween(-7, -1))
    return ops.mart_restaurant_daily(lake).withColumn("m", mean).groupBy("branch_id").agg(
        F.round(F.max_by("m", "date"), 6).alias("avg_7d")
    )


@query("W9_latest_z_score", """
WITH r AS (SELECT branch_id, total_revenue, row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) AS rn FROM mart_revenue)
SELECT branch_id, max(total_revenue) FILTER (WHERE rn = 1) AS latest, round(avg(total_revenue) FILTER (WHERE rn > 1), 4) AS mean,
 round((max(total_revenue) FILTER (WHERE rn = 1) - avg(total_revenue) FILTER (WHERE rn > 1))
   / stddev_pop(total_revenue) FILTER (WHERE rn > 1), 6) AS z_score FROM r GROUP BY 1 HAVING count(*) >= 10""")
def _(lake):
    from staylytics.operators.insights import latest_against_history

    return latest_against_history(ops.mart_revenue_daily(lake), "total_revenue").select(
        "branch_id", "latest", F.round("mean", 4).alias("mean"), F.round("z_score", 6).alias("z_score")
    )
