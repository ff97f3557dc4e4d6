"""Checks for model jobs. Fits have no SQL twin; the arithmetic around them is checked elsewhere."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.marts import daily
from staylytics.checks.registry import query
from staylytics.checks.features import churn_features
from staylytics.operators import features as fe
from staylytics.operators import marts, warehouse
from staylytics.plans import index, jobs, ml
from staylytics.plans.scoring import meal_outputs, price_outputs
from staylytics.session import scratch_path, settle
from staylytics.sources.bookings import bookings
from staylytics.sources.calendar import calendar

# The full models; the same sizes at every scale.
SIZES = ml.FULL_SIZES


def _trained(lake, domains):
    """Metric names of each model and whether each value is sound: in its range, the error not above that of the naive predictor by
    more than a tenth (some targets are nearly noise), the area under the curve well above that of chance. The values
    themselves depend on the learner."""
    metrics = settle(jobs.train_domains(lake, domains, SIZES, scratch_path(lake.spark, "train")))
    naive = metrics.where("metric = 'naive_rmse'").select("model_name", F.col("value").alias("naive"))
    share = F.col("metric").isin("accuracy", "precision", "recall", "f1", "roc_auc")
    sound = (F.col("value") >= 0) & (~share | (F.col("value") <= 1)) & ((F.col("metric") != "rmse") | (F.col("value") < 1.1 * F.col("naive")))
    sound = sound & ((F.col("metric") != "roc_auc") | (F.col("value") > 0.6))
    found = metrics.where("metric <> 'naive_rmse'").join(naive, "model_name", "left")
    return found.select("model_name", "metric", F.coalesce(sound, F.lit(False)).alias("in_range"))


def _metric_sql(models, metrics):
    rows = ", ".join(f"('{m}', '{k}')" for m in models for k in metrics)
    return f"SELECT model_name, metric, true AS in_range FROM (VALUES {rows}) v(model_name, metric)"


_REGRESSION = ["mae", "rmse", "mape"]


@query("M10_boosted_regression", _metric_sql([f"{d}_boosted" for d in ("occupancy", "pricing", "staffing")], _REGRESSION))
def _(lake):
    return _trained(lake, ["occupancy", "pricing", "staffing"])


@query("M13_train_evaluate_report", _metric_sql([f"restaurant_{m}" for m in C.MEALS], _REGRESSION))
def _(lake):
    return _trained(lake, ["restaurant"])


@query("M11_churn_classifiers", _metric_sql(["churn_random_forest", "churn_boosted"], ["accuracy", "precision", "recall", "f1", "roc_auc"]))
def _(lake):
    return _trained(lake, ["churn"])


@query("M12_daily_forecast", """
SELECT branch_id, (last + step)::DATE::VARCHAR AS occupancy_date, true AS ordered, 'trend_and_season' AS model_used
FROM (SELECT branch_id, max(occupancy_date) AS last FROM daily_base GROUP BY 1), (SELECT unnest(range(1, 31))::INT AS step)""")
def _(lake):
    found = ml.forecast_occupancy(daily(lake))
    ordered = F.col("predicted_occupancy_pct").between(F.col("ci_lower"), F.col("ci_upper"))
    return found.select("branch_id", "occupancy_date", ordered.alias("ordered"), "model_used")


# Forecasts of ten past months per branch, each from the days before it; compared on days whose naive value is known.
@query("M12_forecast_backtest", """
SELECT d.branch_id, count(*) AS n, true AS covered, true AS beats_naive FROM (
  SELECT branch_id, occupancy_date, max(occupancy_date) OVER (PARTITION BY branch_id) - (((max(occupancy_date) OVER (PARTITION BY branch_id) - occupancy_date) // 30 + 1) * 30)::INT AS cut,
    (max(occupancy_date) OVER (PARTITION BY branch_id) - occupancy_date) // 30 AS w FROM daily_base) d
JOIN daily_base p ON p.branch_id = d.branch_id AND p.occupancy_date = d.occupancy_date - (ceil((d.occupancy_date - cut) / 7) * 7)::INT
WHERE w < 10 GROUP BY 1""")
def _(lake):
    found = ml.backtest(settle(daily(lake)))
    return found.select(
        "branch_id", "n", F.col("covered").between(0.90, 0.99).alias("covered"), (F.col("mae") < F.col("naive_mae")).alias("beats_naive")
    )


@query("R4_forecast_sentences", """
SELECT 'forecast/' || branch_id || '/' || (last + step)::DATE AS path, 'Occupancy forecast for branch ' || branch_id || ' on ' || (last + step)::DATE AS head, true AS whole
FROM (SELECT branch_id, max(occupancy_date) AS last FROM daily_base GROUP BY 1), (SELECT unnest(range(1, 31))::INT AS step)""")
def _(lake):
    docs = index.forecast_documents(ml.forecast_occupancy(daily(lake)))
    whole = F.col("text").rlike(r": -?[0-9.E-]+% \(range -?[0-9.E-]+--?[0-9.E-]+%, model trend_and_season\)\.$")
    return docs.select("path", F.substring_index("text", ": ", 1).alias("head"), whole.alias("whole"))


@query("M14_price_scoring", """
SELECT branch_id, occupancy_date::VARCHAR AS date, count(*) AS room_types, true AS priced FROM daily_base,
  (SELECT 1 FROM (SELECT unnest(range(3 + (SELECT (count(*) > 0)::INT FROM guest_rows WHERE room_key = 0)))))  GROUP BY 1, 2""")
def _(lake):
    rows = bookings(lake)
    df = settle(ml.scaled_prices(ml.pricing_table(daily(lake), calendar(lake), warehouse.dim_room_type(rows))))
    model = ml.fit_regressor(df, C.PRICING_FEATURES, "avg_daily_rate", SIZES["pricing"])
    scored = ml.score_prices(model, df)
    revenue = F.col("recommended_price") * F.col("occupancy_pct") / 100 * F.col("total_rooms")
    # price and revenue are rounded apart, each by half a cent at most
    sound = (F.col("recommended_price") >= 0) & (F.abs(F.col("expected_revenue") - revenue) <= 0.006 * (1 + F.col("total_rooms")))
    return scored.groupBy("branch_id", "date").agg(F.count("*").alias("room_types"), F.bool_and(sound).alias("priced"))


@query("M14_price_arithmetic", """
SELECT branch_id, occupancy_date::VARCHAR AS date, round_even(greatest(0.0, p), 2) AS recommended_price,
  round_even(greatest(0.0, p) * occupancy_pct / 100 * total_rooms, 2) AS expected_revenue
FROM (SELECT *, floor(avg_daily_rate) - 1500 AS p FROM daily_base)""")
def _(lake):
    shifted = daily(lake).withColumn("p", F.floor("avg_daily_rate").cast("double") - 1500)
    return price_outputs(shifted, "p").select("branch_id", F.col("occupancy_date").alias("date"), "recommended_price", "expected_revenue")


@query("M15_meal_scoring", f"""
SELECT branch_id, date::VARCHAR AS date, meal, true AS sound FROM mart_restaurant, (VALUES {', '.join(f"('{m}')" for m in C.MEALS)}) v(meal)""")
def _(lake):
    df = settle(ml.restaurant_table(marts.mart_restaurant_daily(lake), calendar(lake)))
    scored = ml.score_meals(ml.fit_meals(df, SIZES["restaurant"]), df).join(df.select("branch_id", "date", "avg_item_value"), ["branch_id", "date"])
    # quantity and revenue are rounded apart, to a tenth of an item and to a cent
    off = F.abs(F.col("expected_quantity") * F.col("avg_item_value") - F.col("expected_revenue"))
    sound = F.when(F.coalesce(F.col("avg_item_value"), F.lit(0.0)) == 0, F.col("expected_quantity") == 0).otherwise(
        off <= 0.051 * F.abs("avg_item_value") + 0.0051)
    return scored.select("branch_id", "date", "meal", sound.alias("sound"))


@query("M15_meal_arithmetic", """
SELECT branch_id, date::VARCHAR AS date, coalesce(round_even(lunch_revenue / nullif(avg_item_value, 0), 1), 0) AS expected_quantity, round_even(lunch_revenue, 2) AS expected_revenue FROM mart_restaurant""")
def _(lake):
    return meal_outputs(marts.mart_restaurant_daily(lake), "lunch_revenue", "avg_item_value").select(
        "branch_id", "date", "expected_quantity", "expected_revenue"
    )


@query("M16_staffing_scoring", "SELECT branch_id, department_name, date::VARCHAR AS date, true AS sound FROM mart_staff")
def _(lake):
    df = settle(ml.staffing_table(marts.mart_staff_daily(lake), calendar(lake)))
    scored = ml.score_staffing(ml.fit_regressor(df, C.STAFFING_FEATURES, "present_employees", SIZES["staffing"]), df)
    return scored.select("branch_id", "department_name", "date", (F.col("required_staff") >= 0).alias("sound"))


@query("M17_churn_scoring", """
SELECT known * guest_key AS guest_id,
  known = 1 AND lifetime_bookings >= 1 AND recency_days + frequency + monetary + avg_spend_per_stay + total_nights IS NOT NULL AS scored, true AS level_fits, CASE WHEN known = -1 THEN 'guest_id ' || -guest_key || ' not found' END AS error
FROM churn_features, (VALUES (1), (-1)) v(known)""")
def _(lake):
    guests = settle(churn_features(lake).withColumn("split", fe.hash_split(F.col("guest_key"))))
    model = ml.fit_churn(guests.na.drop(subset=C.CHURN_FEATURES), "random_forest", SIZES["forest"])
    # Every guest once, and for every guest an id that does not exist.
    ids = guests.select(F.explode(F.array(F.col("guest_key"), -F.col("guest_key"))).alias("guest_id"))
    scored = ml.score_guests(model, guests, ids, "random_forest")
    p = F.col("churn_probability")
    fits = F.when(p.isNull(), F.coalesce(F.col("risk_level"), F.lit("Unknown")) == "Unknown").otherwise(
        p.between(0, 1) & F.col("risk_level").isin("Low", "Medium", "High"))
    return scored.select("guest_id", p.isNotNull().alias("scored"), fits.alias("level_fits"), "error")
