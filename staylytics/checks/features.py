"""Checks for feature tables and their building blocks."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.marts import daily, rounded
from staylytics.checks.registry import query
from staylytics.checks.views import calendar_columns, hash63, view
from staylytics.operators import features as ops
from staylytics.operators import marts, warehouse, windows
from staylytics.session import scratch_path, settle
from staylytics.sources.bookings import bookings
from staylytics.sources.calendar import calendar, read_calendar
from staylytics.sources.io import write_csv

_DOUBLES = ["revenue_7day_avg", "occupancy_7day_avg", "occupancy_30day_avg"]
# Quotients of exact integers are the same in both engines and stay unrounded (rounding them could hit a tie).
_EXACT = {"occupancy_pct", "avg_daily_rate", "avg_order_value", "avg_item_value", "attendance_rate_pct",
          *[f"{m}_{k}" for m in ("breakfast", "lunch", "dinner") for k in ("qty", "qty_check")]}


def _round_doubles(df, places=6):
    return df.withColumns({n: F.round(n, places) for n, t in df.dtypes if t == "double" and n not in _EXACT})


def _lags(c, lags, means, part, order):
    w = f"(PARTITION BY {part} ORDER BY {order}"
    out = [f"lag({c}, {n}) OVER {w}) AS {c}_lag_{n}" for n in lags]
    out += [f"avg({c}) OVER {w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {c}_rolling_mean_{n}" for n in means]
    return ", ".join(out)


def _median(source, columns):
    return ", ".join(f"coalesce({c}::DOUBLE, (SELECT quantile_cont({c}, 0.5) FROM {source})) AS {c}" for c in columns)


_OCC_LAGS = [f"occupancy_pct_lag_{n}" for n in (1, 7, 30)] + [f"occupancy_pct_rolling_mean_{n}" for n in (7, 30)]
view("occ_lagged", f"""
SELECT f.*, {calendar_columns('f.occupancy_date')}, {_lags('occupancy_pct', [1, 7, 30], [7, 30], 'branch_id', 'occupancy_date')},
  occupancy_pct - occupancy_7day_avg AS occupancy_trend, total_revenue - revenue_7day_avg AS revenue_trend
FROM daily_occ f LEFT JOIN calendar c ON c.date = f.occupancy_date""")
view("occ_features", f"SELECT * REPLACE ({_median('occ_lagged', _OCC_LAGS)}) FROM occ_lagged")


def occupancy_features(lake):
    return ops.occupancy_features(daily(lake), calendar(lake))


@query("S2_parquet_scan_pushdown", """
SELECT l_returnflag AS flag, count(*) AS row_count, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS cents
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_quantity > 25 GROUP BY 1""")
def _(lake):
    wanted = (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 25)
    return lake.table("lineitem").where(wanted).groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count("*").alias("row_count"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents")
    )


@query("S3_calendar_dimension", "SELECT date::VARCHAR AS date, is_public_holiday, is_local_event, event_name FROM calendar")
def _(lake):
    path = scratch_path(lake.spark, "calendar")
    write_csv(calendar(lake), path)
    return read_calendar(lake.spark, path)


@query("J4_calendar_left_join", f"""
SELECT date::VARCHAR AS date, branch_id, month, quarter, day_of_week, is_weekend, season, is_holiday, is_event, event_name
FROM (SELECT f.branch_id, f.date, {calendar_columns('f.date')} FROM mart_staff f LEFT JOIN calendar c ON c.date = f.date)""")
def _(lake):
    df = ops.add_calendar(marts.mart_staff_daily(lake), "date", calendar(lake))
    return df.select("date", "branch_id", "month", "quarter", "day_of_week", "is_weekend", "season", "is_holiday",
                     "is_event", "event_name")


_ROOM_TYPES = """(SELECT * FROM (VALUES ('Deluxe', 1.4::DOUBLE), ('Standard', 1.0::DOUBLE), ('Suite', 2.0::DOUBLE),
  ('Unmapped', NULL::DOUBLE)) v(room_type_name, base_price_multiplier)
  WHERE room_type_name <> 'Unmapped' OR EXISTS (SELECT 1 FROM guest_rows WHERE room_key = 0))"""


@query("J5_rows_per_room_type", f"""
SELECT branch_id, occupancy_date::VARCHAR AS occupancy_date, occupied_rooms, room_type_name, base_price_multiplier
FROM daily_base, {_ROOM_TYPES}""")
def _(lake):
    rooms = warehouse.dim_room_type(bookings(lake))
    return ops.add_room_types(daily(lake).select("branch_id", "occupancy_date", "occupied_rooms"), rooms)


@query("W1_lags", """
SELECT branch_id, date::VARCHAR AS date, total_orders, lag(total_orders, 1) OVER w AS total_orders_lag_1,
  lag(total_orders, 7) OVER w AS total_orders_lag_7, lag(total_orders, 30) OVER w AS total_orders_lag_30
FROM mart_restaurant WINDOW w AS (PARTITION BY branch_id ORDER BY date)""")
def _(lake):
    df = marts.mart_restaurant_daily(lake).select("branch_id", "date", "total_orders")
    return windows.add_lags(df, "total_orders", [1, 7, 30], ["branch_id"], "date")


_TRAILING = f"""SELECT branch_id, date::VARCHAR AS date, round(total_orders_rolling_mean_7, 6) AS total_orders_rolling_mean_7,
  round(total_orders_rolling_mean_30, 6) AS total_orders_rolling_mean_30 FROM (SELECT branch_id, date,
  {_lags('total_orders', [], [7, 30], 'branch_id', 'date')} FROM mart_restaurant)"""


def _trailing(lake):
    df = marts.mart_restaurant_daily(lake).select("branch_id", "date", "total_orders")
    return _round_doubles(windows.add_trailing_means(df, "total_orders", [7, 30], ["branch_id"], "date")).drop("total_orders")


query("W2_trailing_mean", _TRAILING)(_trailing)
query("D4_window_callable_native", _TRAILING)(_trailing)


@query("W4_trend_residual", """
SELECT branch_id, occupancy_date::VARCHAR AS occupancy_date, round(occupancy_pct - occupancy_7day_avg, 6) AS occupancy_trend,
  round(total_revenue - revenue_7day_avg, 6) AS revenue_trend FROM daily_occ""")
def _(lake):
    return _round_doubles(occupancy_features(lake).select("branch_id", "occupancy_date", "occupancy_trend", "revenue_trend"))


@query("W16_fill_forward_then_back", """
WITH h AS (SELECT branch_id, date, CASE WHEN day(date) % 5 <> 0 THEN total_orders END AS v FROM mart_restaurant)
SELECT branch_id, date::VARCHAR AS date, coalesce(
  last_value(v IGNORE NULLS) OVER (PARTITION BY branch_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY branch_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM h""")
def _(lake):
    gaps = marts.mart_restaurant_daily(lake).select(
        "branch_id", "date", F.when(F.day("date") % 5 != 0, F.col("total_orders")).alias("v")
    )
    return windows.fill_forward_then_back(gaps, ["v"], ["branch_id"], "date")


@query("W14_chronological_split", """
SELECT branch_id, occupancy_date::VARCHAR AS occupancy_date, CASE WHEN row_number() OVER (PARTITION BY branch_id ORDER BY occupancy_date)
  <= floor(count(*) OVER (PARTITION BY branch_id) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM daily_base""")
def _(lake):
    return windows.chronological_split(
        daily(lake).select("branch_id", "occupancy_date"), ["branch_id"], "occupancy_date"
    )


@query("A10_median_fill", f"""
SELECT branch_id, date::VARCHAR AS date, {_median('g', ['lag_7'])} FROM (SELECT * FROM
 (SELECT branch_id, date, lag(total_revenue, 7) OVER (PARTITION BY branch_id ORDER BY date) AS lag_7 FROM mart_revenue))
""".replace("FROM g)", "FROM (SELECT lag(total_revenue, 7) OVER (PARTITION BY branch_id ORDER BY date) AS lag_7 FROM mart_revenue))"))
def _(lake):
    df = windows.add_lags(marts.mart_revenue_daily(lake).select("branch_id", "date", "total_revenue"), "total_revenue",
                          [7], ["branch_id"], "date")
    return ops.fill_with_medians(
        df.select("branch_id", "date", F.col("total_revenue_lag_7").alias("lag_7")), ["lag_7"]
    )


_CHURN = """
SELECT g.guest_key, g.lifetime_bookings, t.total_nights, t.cancellation_ratio, (g.lifetime_bookings > 1)::INT AS repeat_guest,
  date_diff('day', g.last_stay_date, (SELECT max(last_stay_date) + 1 FROM dim_guest))::INT AS recency_days,
  g.lifetime_bookings AS frequency, g.lifetime_spend AS monetary, g.lifetime_spend / g.lifetime_bookings AS avg_spend_per_stay
FROM dim_guest g JOIN (SELECT guest_key, sum(nights)::BIGINT AS total_nights,
  avg((reservation_status = 'Canceled')::INT) AS cancellation_ratio FROM guest_rows GROUP BY 1) t ON t.guest_key = g.guest_key
WHERE g.lifetime_bookings >= 1"""
view("churn_features", f"SELECT *, (recency_days > 180)::INT AS churn FROM ({_CHURN})")


def guest_rows(lake):
    """What guests, stays and daily occupancy need of the bookings, joined and stored once for all that read it."""
    columns = {*C.GUEST_FIELDS, "country", "arrival_date", "stays_in_weekend_nights", "stays_in_week_nights", "adr_cents",
               "reservation_status", "hotel", "assigned_room_type"}
    return settle(bookings(lake).select(*sorted(columns)))


def churn_features(lake, rows=None):
    rows = guest_rows(lake) if rows is None else rows
    return ops.churn_features(settle(warehouse.dim_guest(rows)), warehouse.fact_rows(rows))


@query("M5_churn_features", """
SELECT guest_key, lifetime_bookings, total_nights, cancellation_ratio, repeat_guest, recency_days,
  churn, frequency, monetary, avg_spend_per_stay FROM churn_features""")
def _(lake):
    return churn_features(lake).select(
        "guest_key", "lifetime_bookings", "total_nights", "cancellation_ratio", "repeat_guest", "recency_days", "churn",
        "frequency", "monetary", "avg_spend_per_stay",
    )


_CAL = "month, quarter, day_of_week, is_weekend, season, is_holiday, is_event, event_name"
_OCC_OUT = ", ".join(f"round({c}, 6) AS {c}" for c in [*_DOUBLES, *_OCC_LAGS, "occupancy_trend", "revenue_trend"])


@query("M1_occupancy_features", f"""
SELECT branch_id, branch_name, occupancy_date::VARCHAR AS occupancy_date, occupied_rooms, total_rooms, total_revenue, occupancy_pct, avg_daily_rate,
  {_CAL}, {_OCC_OUT} FROM occ_features""")
def _(lake):
    return _round_doubles(occupancy_features(lake))


@query("M2_pricing_features", f"""
WITH p AS (SELECT f.*, {calendar_columns('f.occupancy_date')},
  f.occupancy_pct * coalesce(f.total_revenue / nullif(f.revenue_7day_avg, 0), 1.0) AS demand_index
  FROM daily_occ f LEFT JOIN calendar c ON c.date = f.occupancy_date)
SELECT branch_id, branch_name, occupancy_date::VARCHAR AS date, occupied_rooms, total_rooms, total_revenue, occupancy_pct, avg_daily_rate,
  {', '.join(f'round({c}, 6) AS {c}' for c in _DOUBLES)}, {_CAL.replace('season', "(CASE season WHEN 'autumn' THEN 0 WHEN 'spring' THEN 1 WHEN 'summer' THEN 2 ELSE 3 END)::DOUBLE AS season")},
  round(demand_index, 6) AS demand_index, base_price_multiplier,
  (CASE room_type_name WHEN 'Deluxe' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Suite' THEN 2 ELSE 3 END)::DOUBLE AS room_type_name
FROM p, {_ROOM_TYPES}""")
def _(lake):
    rooms = warehouse.dim_room_type(bookings(lake))
    return _round_doubles(ops.pricing_features(daily(lake), calendar(lake), rooms))


_MEALS = ["breakfast", "lunch", "dinner"]
_QTY = ", ".join(
    f"items_sold * coalesce({m}_revenue / nullif(total_revenue, 0), 0.0) AS {m}_qty, "
    f"coalesce({m}_revenue / nullif(avg_item_value, 0), 0.0) AS {m}_qty_check" for m in _MEALS
)
_REST_LAGS = ["total_orders_lag_1", "total_orders_lag_7", "total_orders_rolling_mean_7"]
view("rest_lagged", f"""
SELECT f.*, {calendar_columns('f.date')}, {_QTY}, {_lags('total_orders', [1, 7], [7], 'branch_id', 'f.date')}
FROM mart_restaurant f LEFT JOIN calendar c ON c.date = f.date""")


@query("M3_restaurant_features", f"""
SELECT branch_id, date::VARCHAR AS date, total_orders, items_sold, total_revenue, {_CAL},
  {', '.join(f'{m}_revenue' for m in _MEALS)}, avg_order_value, avg_item_value,
  {', '.join(f'{m}_{k}' for m in _MEALS for k in ('qty', 'qty_check'))},
  {', '.join(f'round({c}, 6) AS {c}' for c in _REST_LAGS)}
FROM (SELECT * REPLACE ({_median('rest_lagged', _REST_LAGS)}) FROM rest_lagged)""")
def _(lake):
    return _round_doubles(ops.restaurant_features(marts.mart_restaurant_daily(lake), calendar(lake)))


_QTY_BY_ORDER = _QTY.replace("avg_item_value", "avg_order_value")


@query("M3_meal_divergence", f"""
WITH q AS (SELECT {_QTY_BY_ORDER} FROM mart_restaurant) """ + " UNION ALL ".join(
    f"SELECT '{m}' AS meal, count(*) FILTER (WHERE coalesce(abs({m}_qty - {m}_qty_check) / nullif({m}_qty, 0), 0) > 0.20) AS divergent, count(*) AS row_count FROM q"
    for m in _MEALS))
def _(lake):
    # The value per order stands in for the value per item, so that the two estimates really differ.
    mart = marts.mart_restaurant_daily(lake).withColumn("avg_item_value", F.col("avg_order_value"))
    return ops.meal_divergence(ops.derive_meal_quantities(mart))


_STAFF_LAGS = [f"present_employees_lag_{n}" for n in (1, 7, 30)] + [f"present_employees_rolling_mean_{n}" for n in (7, 30)]
view("staff_lagged", f"""
SELECT f.*, {calendar_columns('f.date')}, {_lags('present_employees', [1, 7, 30], [7, 30], 'branch_id, department_name', 'f.date')}
FROM mart_staff f LEFT JOIN calendar c ON c.date = f.date""")


@query("M4_staff_features", f"""
SELECT branch_id, department_name, date::VARCHAR AS date, scheduled_employees, present_employees, {_CAL},
  attendance_rate_pct, {', '.join(f'round({c}, 6) AS {c}' for c in _STAFF_LAGS)},
  (dense_rank() OVER (ORDER BY department_name) - 1)::DOUBLE AS department_name_code
FROM (SELECT * REPLACE ({_median('staff_lagged', _STAFF_LAGS)}) FROM staff_lagged)""")
def _(lake):
    return _round_doubles(ops.staff_features(marts.mart_staff_daily(lake), calendar(lake)))


@query("M7_ordinal_encoding", """
WITH fit AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS code FROM (SELECT DISTINCT meal AS c FROM bookings WHERE meal <> 'SC'))
SELECT meal, coalesce(code, -1)::DOUBLE AS meal_code, count(*) AS row_count FROM bookings LEFT JOIN fit ON meal = c GROUP BY 1, 2""")
def _(lake):
    rows = bookings(lake).select("meal")
    fitted = ops.fit_categories(rows.where("meal <> 'SC'"), "meal")
    return ops.apply_categories(rows, "meal", fitted).groupBy("meal", "meal_code").agg(F.count("*").alias("row_count"))


@query("M8_standard_scaling", """
SELECT branch_id, date::VARCHAR AS date, round((total_revenue - (SELECT avg(total_revenue) FROM mart_revenue)) / (SELECT stddev_pop(total_revenue) FROM mart_revenue), 6) AS total_revenue,
  round((avg_daily_rate - (SELECT avg(avg_daily_rate) FROM mart_revenue)) / (SELECT stddev_pop(avg_daily_rate) FROM mart_revenue), 6) AS avg_daily_rate FROM mart_revenue""")
def _(lake):
    columns = ["total_revenue", "avg_daily_rate"]
    df = marts.mart_revenue_daily(lake).select("branch_id", "date", *columns)
    return rounded(ops.apply_scaler(df, columns, ops.fit_scaler(df, columns)), *columns)


@query("M9_hash_split", f"""
SELECT o_orderkey, CASE WHEN {hash63('o_orderkey::VARCHAR')} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM orders""")
def _(lake):
    return lake.table("orders").select("o_orderkey", ops.hash_split(F.col("o_orderkey")).alias("split"))


_STAT_COLUMNS = ["occupied_rooms", "occupancy_pct", "total_revenue", "avg_daily_rate", *_OCC_LAGS, "occupancy_trend"]


@query("A11_column_statistics", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, "
    f"round(min({c})::DOUBLE, 3) AS min, round(max({c})::DOUBLE, 3) AS max FROM occ_features" for c in _STAT_COLUMNS))
def _(lake):
    return ops.column_statistics(occupancy_features(lake), _STAT_COLUMNS)


_CORR_COLUMNS = ["occupied_rooms", "occupancy_pct", "avg_daily_rate", "occupancy_7day_avg", "occupancy_30day_avg",
                 "occupancy_pct_lag_1", "occupancy_pct_lag_7", "month", "quarter", "day_of_week", "is_weekend"]
_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:]]


@query("A12_top_correlations", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(abs(corr({a}, {b})), 6) AS abs_corr FROM occ_features" for a, b in _PAIRS)
    + ") ORDER BY abs_corr DESC, feature_a, feature_b LIMIT 10")
def _(lake):
    return ops.top_correlations(occupancy_features(lake), _CORR_COLUMNS)
