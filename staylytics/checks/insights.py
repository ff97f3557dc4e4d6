"""Checks for insight rules, scoring, ranking and summaries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.checks.features import churn_features, guest_rows
from staylytics.checks.marts import daily
from staylytics.checks.registry import query
from staylytics.checks.views import view
from staylytics.operators import insights as ops
from staylytics.operators import marts, warehouse
from staylytics.operators import reviews as rv
from staylytics.session import settle
from staylytics.sources.reviews import reviews

SHOWN = ["category", "title", "metric", "metric_delta", "severity", "branch_id", "citation"]


def _finding(category, title, metric, delta, severity, branch, citation, source):
    return (f"SELECT '{category}' AS category, {title} AS title, '{metric}' AS metric, {delta}::DOUBLE AS metric_delta, "
            f"{severity} AS severity, {branch}::VARCHAR AS branch_id, '{citation}' AS citation FROM {source}")


def _last8(mart, cols):
    return f"""(SELECT branch_id, count(*) AS n, {', '.join(
        f"max({c}) FILTER (WHERE rn = 1) AS {c}, max({c}) FILTER (WHERE rn = 8) AS {c}_8, avg({c}) FILTER (WHERE rn > 1) AS {c}_prev" for c in cols)}
      FROM (SELECT *, row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) AS rn FROM {mart}) WHERE rn <= 8 GROUP BY 1)"""


view("mart_occupancy", "SELECT branch_id, occupancy_date AS date, occupancy_pct, total_rooms, occupied_rooms FROM daily_occ")
view("rev_last", f"SELECT *, (total_revenue - revenue_7day_avg) / revenue_7day_avg * 100 AS pct FROM {_last8('mart_revenue', ['total_revenue', 'revenue_7day_avg'])} WHERE n >= 2 AND revenue_7day_avg <> 0")
view("i_revenue", _finding("revenue", "'Revenue drop at branch ' || branch_id", "total_revenue", "round_even(pct, 2)",
     "CASE WHEN pct <= -20 THEN 'high' ELSE 'medium' END", "branch_id", "mart_revenue_daily", "rev_last WHERE pct <= -10")
     + " UNION ALL " + _finding("revenue", "'Revenue surge at branch ' || branch_id", "total_revenue", "round_even(pct, 2)",
                                "'low'", "branch_id", "mart_revenue_daily", "rev_last WHERE pct >= 15"))
_OCC = [
    ("'Low occupancy at branch ' || branch_id", "occupancy_pct", "round_even(occupancy_pct - 40, 2)",
     "CASE WHEN occupancy_pct <= 25 THEN 'high' ELSE 'medium' END", "occupancy_pct <= 40"),
    ("'Near-capacity occupancy at branch ' || branch_id", "occupancy_pct", "round_even(occupancy_pct - 95, 2)", "'medium'",
     "occupancy_pct >= 95"),
    ("'Sharp week-over-week occupancy swing at branch ' || branch_id", "occupancy_pct_wow",
     "round_even(occupancy_pct - occupancy_pct_8, 2)", "'medium'", "n >= 8 AND abs(occupancy_pct - occupancy_pct_8) >= 15"),
]
view("occ_last", f"SELECT * FROM {_last8('mart_occupancy', ['occupancy_pct'])}")
view("i_occupancy", " UNION ALL ".join(
    _finding("occupancy", t, m, d, s, "branch_id", "mart_occupancy_daily", f"occ_last WHERE {w}") for t, m, d, s, w in _OCC))
view("nation_occ_last", f"SELECT * FROM {_last8('mart_revenue', ['occupancy_pct'])}")
view("price_last", f"""SELECT *, coalesce((avg_daily_rate - avg_daily_rate_8) / nullif(avg_daily_rate_8, 0) * 100, 0) AS growth
  FROM {_last8('mart_revenue', ['avg_daily_rate', 'occupancy_pct'])} WHERE n >= 8""")
view("i_pricing", _finding("pricing", "'Potential under-pricing at branch ' || branch_id", "avg_daily_rate_growth_pct",
     "round_even(growth, 2)", "'medium'", "branch_id", "mart_revenue_daily", "price_last WHERE occupancy_pct >= 85 AND growth < 2"))
view("waste_last", f"""SELECT *, (total_orders - total_orders_prev) / total_orders_prev * 100 AS pct
  FROM {_last8('mart_restaurant', ['total_orders'])} WHERE n >= 8 AND total_orders_prev <> 0""")
view("i_waste", _finding("restaurant_waste", "'Restaurant demand deviation at branch ' || branch_id", "total_orders",
     "round_even(pct, 2)", "CASE WHEN abs(pct) < 40 THEN 'medium' ELSE 'high' END", "branch_id", "mart_restaurant_daily",
     "waste_last WHERE abs(pct) >= 25"))
view("staff_last", """SELECT *, coalesce(nullif(attendance_rate_pct, 0), 100) AS a, scheduled_employees - present_employees AS gap FROM mart_staff
  QUALIFY row_number() OVER (PARTITION BY branch_id, department_name ORDER BY date DESC) = 1""")
view("i_staff", _finding("staff", "'Low attendance at branch ' || branch_id || ' (' || department_name || ')'", "attendance_rate_pct",
     "round_even(a - 80, 2)", "CASE WHEN a < 65 THEN 'high' ELSE 'medium' END", "branch_id", "mart_staff_daily", "staff_last WHERE a < 80")
     + " UNION ALL " + _finding("staff", "'Understaffing gap at branch ' || branch_id || ' (' || department_name || ')'", "staffing_gap",
                                "gap", "CASE WHEN gap < 4 THEN 'medium' ELSE 'high' END", "branch_id", "mart_staff_daily", "staff_last WHERE gap >= 2"))


def _anomaly(mart, metric):
    return f"""SELECT branch_id, latest, mean, (latest - mean) / std AS z FROM (SELECT branch_id, count(*) AS n,
      max({metric}) FILTER (WHERE rn = 1) AS latest, avg({metric}) FILTER (WHERE rn > 1) AS mean, stddev_pop({metric}) FILTER (WHERE rn > 1) AS std
      FROM (SELECT *, row_number() OVER (PARTITION BY branch_id ORDER BY date DESC) AS rn FROM {mart}) GROUP BY 1) WHERE n >= 10 AND std <> 0"""


view("anomaly_revenue", _anomaly("mart_revenue", "total_revenue"))
view("anomaly_occupancy", _anomaly("mart_occupancy", "occupancy_pct"))


def _anomaly_finding(metric, source):
    return _finding("anomaly", f"'Statistical anomaly in {metric} at branch ' || branch_id", metric, "round_even(latest - mean, 2)",
                    "CASE WHEN abs(z) >= 3.5 THEN 'high' ELSE 'medium' END", "branch_id", "anomaly_detector", f"{source} WHERE abs(z) >= 2.5")


view("i_anomaly", _anomaly_finding("total_revenue", "anomaly_revenue"))
view("churn_scored", "SELECT guest_key AS guest_id, round(recency_days / (recency_days + 180), 4) AS p, total_nights FROM churn_features")
view("i_churn", _finding("churn", "'High churn risk guest ' || guest_id || CASE WHEN total_nights >= 10 THEN ' (high-value)' ELSE '' END",
     "churn_probability", "round_even(p - 0.6::DOUBLE, 4)", "CASE WHEN total_nights >= 10 THEN 'critical' ELSE 'medium' END", "NULL",
     "predict_churn", "churn_scored WHERE p >= 0.6"))
view("i_guest", _finding("guest_experience", "'Low guest satisfaction at ' || hotel_id", "csat", "round_even(csat - 60, 2)",
     "CASE WHEN csat < 45 THEN 'high' ELSE 'medium' END", "hotel_id", "guest_review_analysis", "csat_hotel WHERE csat < 60")
     + " UNION ALL " + _finding("guest_experience", "'Declining satisfaction trend at ' || hotel_id", "csat_trend", "NULL", "'medium'",
                                "hotel_id", "guest_review_analysis", "csat_trends WHERE trend = 'declining'")
     + " UNION ALL " + _finding("guest_experience", "'High volume of ''' || category || ''' complaints'", "complaint_count", "n",
                                "CASE WHEN n >= 100 THEN 'high' ELSE 'medium' END", "NULL", "guest_review_analysis", "complaint_totals WHERE n >= 50"))
view("all_findings", " UNION ALL ".join(
    f"SELECT * FROM {v}" for v in ["i_revenue", "i_occupancy", "i_pricing", "i_waste", "i_staff", "i_anomaly", "i_churn", "i_guest"]))
view("scored_findings", """SELECT *, round_even((CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END)
  + ln(1 + abs(coalesce(metric_delta, 0))) / 10, 4) AS priority_score FROM all_findings""")


def churn_scored(lake, rows=None):
    """Deterministic stand-in for a model score: recency against the churn window."""
    p = F.round(F.col("recency_days") / (F.col("recency_days") + 180), 4)
    return churn_features(lake, rows).select(F.col("guest_key").alias("guest_id"), p.alias("churn_probability"), "total_nights")


def review_findings(lake):
    rows = settle(reviews(lake).select("hotel_id", "date", "rating", "review"))
    trends = rv.csat_trend(rv.csat_by_period(rows, "weekly"))
    complaints = rv.complaint_counts(rv.with_complaints(rows))
    return ops.guest_experience(rv.csat_by_hotel(rows), complaints, trends)


def all_findings(lake, categories=None):
    """Findings of all rules, or of the rules of some categories only: others are not computed at all.

    The order lines are summed per branch and day once, and that table is stored and read by all rules that need it; so are the
    bookings behind occupancy and churn.
    """
    rows = guest_rows(lake) if categories is None or set(categories) & {"occupancy", "churn"} else None
    days = settle(marts.branch_days(lake)) if categories is None or set(categories) & {"revenue", "pricing", "anomaly", "restaurant"} else None
    revenue_mart = settle(marts.mart_revenue_daily(lake, days)) if days is not None else None
    rules = {
        "revenue": lambda: ops.revenue(revenue_mart), "occupancy": lambda: ops.occupancy(marts.mart_occupancy_daily(marts.daily_occupancy(warehouse.fact_rows(rows)))),
        "pricing": lambda: ops.pricing(revenue_mart), "restaurant": lambda: ops.restaurant_waste(marts.mart_restaurant_daily(lake, days)),
        "staff": lambda: ops.staff(marts.mart_staff_daily(lake)), "anomaly": lambda: ops.anomaly(revenue_mart, "total_revenue"),
        "churn": lambda: ops.churn(churn_scored(lake, rows)), "guest_experience": lambda: review_findings(lake),
    }
    parts = [rule() for category, rule in rules.items() if categories is None or category in categories]
    return settle(reduce(DataFrame.unionByName, parts))


@query("I1_revenue_rule", "SELECT * FROM i_revenue")
def _(lake):
    return ops.revenue(marts.mart_revenue_daily(lake)).select(*SHOWN)


@query("I2_occupancy_rule", "SELECT * FROM i_occupancy UNION ALL " + " UNION ALL ".join(
    _finding("occupancy", t, m, d, s, "branch_id", "mart_occupancy_daily", f"nation_occ_last WHERE {w}") for t, m, d, s, w in _OCC))
def _(lake):
    nations = marts.mart_revenue_daily(lake).select("branch_id", "date", "occupancy_pct")
    return ops.occupancy(marts.mart_occupancy_daily(daily(lake))).unionByName(ops.occupancy(nations)).select(*SHOWN)


@query("I3_pricing_rule", _finding("pricing", "'Potential under-pricing at branch ' || branch_id", "avg_daily_rate_growth_pct",
     "round_even(growth, 2)", "'medium'", "branch_id", "mart_revenue_daily",
     "(SELECT * REPLACE (occupancy_pct * 40 AS occupancy_pct) FROM price_last) WHERE occupancy_pct >= 85 AND growth < 2"))
def _(lake):
    busy = marts.mart_revenue_daily(lake).withColumn("occupancy_pct", F.col("occupancy_pct") * 40)
    return ops.pricing(busy).select(*SHOWN)


@query("I4_restaurant_rule", "SELECT * FROM i_waste")
def _(lake):
    return ops.restaurant_waste(marts.mart_restaurant_daily(lake)).select(*SHOWN)


@query("I5_staff_rule", "SELECT * FROM i_staff")
def _(lake):
    return ops.staff(marts.mart_staff_daily(lake)).select(*SHOWN)


@query("I6_anomaly_rule", f"SELECT * FROM i_anomaly UNION ALL {_anomaly_finding('occupancy_pct', 'anomaly_occupancy')}")
def _(lake):
    found = ops.anomaly(marts.mart_revenue_daily(lake), "total_revenue").unionByName(
        ops.anomaly(marts.mart_occupancy_daily(daily(lake)), "occupancy_pct"))
    return found.select(*SHOWN)


@query("I7_churn_rule", "SELECT * FROM i_churn")
def _(lake):
    return ops.churn(churn_scored(lake)).select(*SHOWN)


@query("I8_guest_experience_rule", "SELECT * FROM i_guest")
def _(lake):
    return review_findings(lake).select(*SHOWN)


@query("I9_severity_score", "SELECT title, severity, priority_score FROM scored_findings")
def _(lake):
    return ops.score(all_findings(lake)).select("title", "severity", "priority_score")


@query("I10_category_and_severity_filter", "SELECT * FROM all_findings WHERE category = 'staff' AND severity IN ('high', 'critical')")
def _(lake):
    return ops.with_min_severity(ops.with_category(all_findings(lake, ["staff"]), "staff"), "high").select(*SHOWN)


@query("I11_recommendation_text", """
SELECT title, '[' || upper(severity) || '] ' || title || CASE WHEN metric_delta IS NULL THEN '' ELSE ' (delta: ' || metric_delta::VARCHAR || ')' END
  || '. Review ' || metric || ' for ' || citation || ' and take corrective action if this persists beyond the next reporting cycle.' AS recommendation
FROM all_findings""")
def _(lake):
    return ops.recommend(all_findings(lake)).select("title", "recommendation")


@query("I12_ranked_insights", "SELECT * FROM scored_findings ORDER BY priority_score DESC, category, title")
def _(lake):
    return ops.rank(all_findings(lake)).select(*SHOWN, "priority_score")


@query("K2_top_findings", "SELECT category, title, priority_score FROM scored_findings ORDER BY priority_score DESC, category, title LIMIT 5")
def _(lake):
    return ops.rank(all_findings(lake), 5).select("category", "title", "priority_score")


@query("I13_executive_summary", """
SELECT 'Top findings requiring attention:' || chr(10) || string_agg('- [' || upper(severity) || '] ' || title, chr(10)
  ORDER BY priority_score DESC, category, title) AS narrative
FROM (SELECT * FROM scored_findings ORDER BY priority_score DESC, category, title LIMIT 5)""")
def _(lake):
    return ops.executive_summary(all_findings(lake))
