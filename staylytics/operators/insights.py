"""Rule-based findings. Every rule reduces a day-grain mart to its last rows per group and emits findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.keys import lookup
from staylytics.operators.windows import latest_rows

SEVERITY_ORDER = ["low", "medium", "high", "critical"]


def finding(category: str, title: Column, metric: str, delta: Column, severity: Column, branch: Column,
            data: Column, citation: str) -> Column:
    return F.struct(
        F.lit(category).alias("category"), title.alias("title"), F.lit(metric).alias("metric"),
        delta.cast("double").alias("metric_delta"), severity.alias("severity"),
        branch.cast("string").alias("branch_id"), F.to_json(data).alias("supporting_data"),
        F.lit(citation).alias("citation"),
    )


def emit(df: DataFrame, candidates: list[tuple[Column, Column]]) -> DataFrame:
    """One output row per candidate whose condition holds."""
    options = F.array(*[F.when(F.coalesce(cond, F.lit(False)), row) for cond, row in candidates])
    return df.select(F.inline(F.filter(options, lambda x: x.isNotNull())))


def titled(text: str, who: Column, tail: Column | None = None) -> Column:
    parts = [F.lit(text), who.cast("string")]
    return F.concat(*parts, *([tail] if tail is not None else []))


def either(cond: Column, yes: str, no: str) -> Column:
    return F.when(cond, yes).otherwise(no)


def last_and_week_ago(df: DataFrame, key: str, c: str) -> DataFrame:
    """Latest value, the value seven rows earlier, and how many of the last eight rows exist."""
    return latest_rows(df, [key], "date", 8).groupBy(key).agg(
        F.max("date").alias("date"),
        F.max(F.when(F.col("recency") == 1, F.col(c))).alias("latest"),
        F.max(F.when(F.col("recency") == 8, F.col(c))).alias("week_ago"),
        F.count("*").alias("row_count"),
    )


def latest_against_history(df: DataFrame, c: str, key: str = "branch_id", order: str = "date") -> DataFrame:
    """z-score of the newest value against all earlier ones (population deviation, at least ten values)."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    ranked = df.where(F.col(c).isNotNull()).withColumn("recency", rn)
    past = F.when(F.col("recency") > 1, F.col(c))
    stats = ranked.groupBy(key).agg(
        F.max(F.when(F.col("recency") == 1, F.col(c))).alias("latest"), F.avg(past).alias("mean"),
        F.stddev_pop(past).alias("std"), F.count("*").alias("n"),
    )
    return stats.where("n >= 10 AND std <> 0").withColumn(
        "z_score", (F.col("latest") - F.col("mean")) / F.col("std")
    )


def revenue(mart: DataFrame) -> DataFrame:
    last = latest_rows(mart, ["branch_id"], "date", 2).groupBy("branch_id").agg(
        F.max(F.when(F.col("recency") == 1, F.col("total_revenue"))).alias("latest_revenue"),
        F.max(F.when(F.col("recency") == 1, F.col("revenue_7day_avg"))).alias("avg_7d"),
        F.count("*").alias("n"),
    ).where("n >= 2 AND avg_7d <> 0")
    pct = (F.col("latest_revenue") - F.col("avg_7d")) / F.col("avg_7d") * 100
    last, pct = last.withColumn("pct", pct), F.col("pct")
    b, data = F.col("branch_id"), F.struct("latest_revenue", "avg_7d")
    delta = F.bround(pct, 2)
    return emit(last, [
        (pct <= -10, finding("revenue", titled("Revenue drop at branch ", b), "total_revenue", delta,
                             either(pct <= -20, "high", "medium"), b, data, "mart_revenue_daily")),
        (pct >= 15, finding("revenue", titled("Revenue surge at branch ", b), "total_revenue", delta, F.lit("low"), b,
                            data, "mart_revenue_daily")),
    ])


def occupancy(mart: DataFrame) -> DataFrame:
    last = last_and_week_ago(mart, "branch_id", "occupancy_pct").withColumnRenamed("latest", "occupancy_pct")
    occ, b = F.col("occupancy_pct"), F.col("branch_id")
    swing = occ - F.col("week_ago")
    level = F.struct("occupancy_pct")
    src = "mart_occupancy_daily"
    return emit(last, [
        (occ <= 40, finding("occupancy", titled("Low occupancy at branch ", b), "occupancy_pct", F.bround(occ - 40, 2),
                            either(occ <= 25, "high", "medium"), b, level, src)),
        (occ >= 95, finding("occupancy", titled("Near-capacity occupancy at branch ", b), "occupancy_pct",
                            F.bround(occ - 95, 2), F.lit("medium"), b, level, src)),
        ((F.col("row_count") >= 8) & (F.abs(swing) >= 15),
         finding("occupancy", titled("Sharp week-over-week occupancy swing at branch ", b), "occupancy_pct_wow",
                 F.bround(swing, 2), F.lit("medium"), b, F.struct("occupancy_pct", "week_ago"), src)),
    ])


def pricing(mart: DataFrame) -> DataFrame:
    last = latest_rows(mart, ["branch_id"], "date", 8).groupBy("branch_id").agg(
        F.max(F.when(F.col("recency") == 1, F.col("avg_daily_rate"))).alias("rate"),
        F.max(F.when(F.col("recency") == 8, F.col("avg_daily_rate"))).alias("rate_week_ago"),
        F.coalesce(F.max(F.when(F.col("recency") == 1, F.col("occupancy_pct"))), F.lit(0.0)).alias("occupancy_pct"),
        F.count("*").alias("n"),
    ).where("n >= 8")
    growth = F.coalesce(
        F.try_divide(F.col("rate") - F.col("rate_week_ago"), F.col("rate_week_ago")) * 100, F.lit(0.0)
    )
    last = last.withColumn("growth", growth)
    b = F.col("branch_id")
    row = finding("pricing", titled("Potential under-pricing at branch ", b), "avg_daily_rate_growth_pct",
                  F.bround("growth", 2), F.lit("medium"), b, F.struct("occupancy_pct", "growth"), "mart_revenue_daily")
    return emit(last, [((F.col("occupancy_pct") >= 85) & (F.col("growth") < 2), row)])


def restaurant_waste(mart: DataFrame) -> DataFrame:
    last = latest_rows(mart, ["branch_id"], "date", 8).groupBy("branch_id").agg(
        F.max(F.when(F.col("recency") == 1, F.col("total_orders"))).alias("latest_orders"),
        F.avg(F.when(F.col("recency") > 1, F.col("total_orders"))).alias("avg_7d"), F.count("*").alias("n"),
    ).where("n >= 8 AND avg_7d <> 0")
    last = last.withColumn("pct", (F.col("latest_orders") - F.col("avg_7d")) / F.col("avg_7d") * 100)
    pct, b = F.col("pct"), F.col("branch_id")
    row = finding("restaurant_waste", titled("Restaurant demand deviation at branch ", b), "total_orders",
                  F.bround(pct, 2), either(F.abs(pct) < 40, "medium", "high"), b,
                  F.struct("latest_orders", "avg_7d"), "mart_restaurant_daily")
    return emit(last, [(F.abs(pct) >= 25, row)])


def staff(mart: DataFrame) -> DataFrame:
    """An attendance of 0 or NULL is read as 100, as a missing measurement."""
    newest = mart.groupBy("branch_id", "department_name").agg(
        F.max_by(F.struct("scheduled_employees", "present_employees", "attendance_rate_pct"), "date").alias("r")
    ).select("branch_id", "department_name", "r.*")
    attendance = F.coalesce(F.nullif(F.col("attendance_rate_pct"), F.lit(0.0)), F.lit(100.0))
    gap = F.coalesce("scheduled_employees", F.lit(0)) - F.coalesce("present_employees", F.lit(0))
    newest = newest.withColumns({"attendance": attendance, "gap": gap})
    a, g, b = F.col("attendance"), F.col("gap"), F.col("branch_id")
    where = F.concat(F.lit(" ("), F.col("department_name"), F.lit(")"))
    src = "mart_staff_daily"
    return emit(newest, [
        (a < 80, finding("staff", titled("Low attendance at branch ", b, where), "attendance_rate_pct",
                         F.bround(a - 80, 2), either(a < 65, "high", "medium"), b,
                         F.struct("attendance", "department_name"), src)),
        (g >= 2, finding("staff", titled("Understaffing gap at branch ", b, where), "staffing_gap", g,
                         either(g < 4, "medium", "high"), b, F.struct("gap", "department_name"), src)),
    ])


def anomaly(mart: DataFrame, metric: str, category: str = "anomaly", key: str = "branch_id") -> DataFrame:
    last = latest_against_history(mart, metric, key)
    z, b = F.col("z_score"), F.col(key)
    row = finding(category, titled(f"Statistical anomaly in {metric} at branch ", b), metric,
                  F.bround(F.col("latest") - F.col("mean"), 2), either(F.abs(z) >= 3.5, "high", "medium"), b,
                  F.struct(F.bround(z, 2).alias("z_score"), "latest", F.bround("mean", 2).alias("mean")),
                  "anomaly_detector")
    return emit(last, [(F.abs(z) >= 2.5, row)])


def churn(scored: DataFrame) -> DataFrame:
    """Findings for guests with a churn probability of at least 0.6; ten or more nights makes them critical."""
    p, guest = F.col("churn_probability"), F.col("guest_id")
    rich = F.coalesce("total_nights", F.lit(0)) >= 10
    row = finding("churn", titled("High churn risk guest ", guest, either(rich, " (high-value)", "")),
                  "churn_probability", F.bround(p - 0.6, 4), either(rich, "critical", "medium"),
                  F.lit(None).cast("string"), F.struct("guest_id", "churn_probability", "total_nights"),
                  "predict_churn")
    return emit(scored, [(p >= 0.6, row)])


def guest_experience(csat: DataFrame, complaints: DataFrame, trends: DataFrame) -> DataFrame:
    hotels = csat.join(trends, "hotel_id", "left")
    c, h, src = F.col("csat"), F.col("hotel_id"), "guest_review_analysis"
    per_hotel = emit(hotels, [
        (c < 60, finding("guest_experience", titled("Low guest satisfaction at ", h), "csat", F.bround(c - 60, 2),
                         either(c < 45, "high", "medium"), h, F.struct("csat"), src)),
        (F.col("trend") == "declining",
         finding("guest_experience", titled("Declining satisfaction trend at ", h), "csat_trend",
                 F.lit(None).cast("double"), F.lit("medium"), h, F.struct("trend"), src)),
    ])
    n = F.col("count")
    title = F.concat(F.lit("High volume of '"), F.col("category"), F.lit("' complaints"))
    per_category = emit(complaints, [
        (n >= 50, finding("guest_experience", title, "complaint_count", n, either(n >= 100, "high", "medium"),
                          F.lit(None).cast("string"), F.struct("category", "count"), src)),
    ])
    return per_hotel.unionByName(per_category)


def score(df: DataFrame) -> DataFrame:
    """Severity weight plus a damped magnitude."""
    weight = F.coalesce(F.element_at(lookup(C.SEVERITY_WEIGHTS), F.col("severity")), F.lit(1))
    size = F.log1p(F.abs(F.coalesce("metric_delta", F.lit(0.0)))) / 10
    return df.withColumn("priority_score", F.bround(weight + size, 4))


def rank(df: DataFrame, n: int | None = None) -> DataFrame:
    """By score, then category; the title makes the order total. With n this is a distributed top-n."""
    ranked = score(df).orderBy(F.desc("priority_score"), "category", "title")
    return ranked if n is None else ranked.limit(n)


def with_min_severity(df: DataFrame, least: str = "medium") -> DataFrame:
    return df.where(F.col("severity").isin(SEVERITY_ORDER[SEVERITY_ORDER.index(least):]))


def with_category(df: DataFrame, category: str) -> DataFrame:
    return df.where(F.col("category") == category)


def recommend(df: DataFrame) -> DataFrame:
    # Deltas have at most four decimals; plain notation without padding zeros.
    plain = F.regexp_replace(F.col("metric_delta").cast("decimal(24,4)").cast("string"), r"(\.\d*?[1-9])0+$|(\.0)0+$", "$1$2")
    delta = F.when(F.col("metric_delta").isNotNull(), F.concat(F.lit(" (delta: "), plain, F.lit(")"))).otherwise("")
    source = F.when(F.coalesce("citation", F.lit("")) == "", "the relevant source").otherwise(F.col("citation"))
    return df.withColumn("recommendation", F.concat(
        F.lit("["), F.upper("severity"), F.lit("] "), F.col("title"), delta, F.lit(". Review "), F.col("metric"),
        F.lit(" for "), source, F.lit(" and take corrective action if this persists beyond the next reporting cycle."),
    ))


def executive_summary(df: DataFrame, n: int = 5) -> DataFrame:
    """One narrative row from the top n findings; only those n rows are collected into the text."""
    top = rank(df, n)
    line = F.concat(F.lit("- ["), F.upper("severity"), F.lit("] "), F.col("title"))
    entry = F.struct((-F.col("priority_score")).alias("o"), F.col("category"), F.col("title"), line.alias("line"))
    lines = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["line"])
    return top.agg(F.count("*").alias("n"), lines.alias("lines")).select(
        F.when(F.col("n") == 0, "No significant findings at this time.")
        .otherwise(F.concat(F.lit("Top findings requiring attention:\n"), F.concat_ws("\n", "lines")))
        .alias("narrative")
    )
