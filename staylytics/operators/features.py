"""Feature tables for occupancy, pricing, restaurant, staffing and churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.dates import is_weekend, season
from staylytics.operators.windows import add_lags, add_trailing_means


def safe_ratio(a: Column, b: Column, default: float) -> Column:
    """a / b with the default for NULL, zero-divisor and non-finite results."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(default))


def add_calendar(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Date parts, season and holiday/event flags; dates missing from the calendar get 0 and ''."""
    d = F.col(day)
    parts = df.withColumns({
        "month": F.month(d), "quarter": F.quarter(d), "day_of_week": F.weekday(d),
        "is_weekend": is_weekend(d).cast("int"), "season": season(d),
    })
    events = calendar.withColumnRenamed("date", day)
    return parts.join(events, day, "left").withColumns({
        "is_holiday": F.coalesce("is_public_holiday", F.lit(0)),
        "is_event": F.coalesce("is_local_event", F.lit(0)),
        "event_name": F.coalesce("event_name", F.lit("")),
    }).drop("is_public_holiday", "is_local_event")


def fill_with_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULLs by the column's overall median; all medians come from one aggregate over day-grain rows."""
    medians = df.agg(F.struct(*[F.percentile(c, 0.5).alias(c) for c in columns]).alias("m")).scalar()
    return df.withColumn("_m", medians).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_m")[c]) for c in columns}
    ).drop("_m")


def fit_categories(df: DataFrame, column: str) -> DataFrame:
    """Code per category in lexicographic order; the window runs over the distinct categories only."""
    order = Window.orderBy(column)
    cats = df.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct()
    return cats.withColumn(f"{column}_code", (F.row_number().over(order) - 1).cast("double"))


def apply_categories(df: DataFrame, column: str, categories: DataFrame) -> DataFrame:
    """Encode with fitted categories; values not seen in the fit become -1."""
    return df.join(categories, column, "left").withColumn(
        f"{column}_code", F.coalesce(f"{column}_code", F.lit(-1.0))
    )


def encode(df: DataFrame, columns: list[str]) -> DataFrame:
    for c in columns:
        df = apply_categories(df, c, fit_categories(df, c)).drop(c).withColumnRenamed(f"{c}_code", c)
    return df


def fit_scaler(df: DataFrame, columns: list[str]) -> Column:
    """Mean and population deviation per column as one struct-valued scalar subquery."""
    stats = [
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ]
    return df.agg(F.struct(*stats).alias("s")).scalar()


def apply_scaler(df: DataFrame, columns: list[str], fitted: Column) -> DataFrame:
    """(x - mean) / std, with a zero deviation read as 1."""
    df = df.withColumn("_s", fitted)
    return df.withColumns({
        c: (F.col(c) - F.col("_s")[c]["mean"])
        / F.when(F.col("_s")[c]["std"] == 0, 1.0).otherwise(F.col("_s")[c]["std"])
        for c in columns
    }).drop("_s")


def add_demand_index(df: DataFrame) -> DataFrame:
    ratio = safe_ratio(F.col("total_revenue"), F.col("revenue_7day_avg"), 1.0)
    return df.withColumn("demand_index", F.col("occupancy_pct") * ratio)


def add_room_types(df: DataFrame, room_types: DataFrame) -> DataFrame:
    """Every row once per room type. The types (at most the seed tiers plus one) travel as one small array."""
    types = room_types.agg(
        F.array_sort(F.collect_list(F.struct("room_type_key", "room_type_name", "base_price_multiplier")))
    ).scalar()
    return df.select("*", F.inline(types)).drop("room_type_key")


def occupancy_features(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    df = add_calendar(daily, "occupancy_date", calendar)
    df = add_lags(df, "occupancy_pct", [1, 7, 30], ["branch_id"], "occupancy_date")
    df = add_trailing_means(df, "occupancy_pct", [7, 30], ["branch_id"], "occupancy_date")
    df = df.withColumns({
        "occupancy_trend": F.col("occupancy_pct") - F.col("occupancy_7day_avg"),
        "revenue_trend": F.col("total_revenue") - F.col("revenue_7day_avg"),
    })
    return fill_with_medians(df, [c for c in df.columns if "lag" in c or "rolling" in c])


def pricing_features(daily: DataFrame, calendar: DataFrame, room_types: DataFrame) -> DataFrame:
    df = add_calendar(daily.withColumnRenamed("occupancy_date", "date"), "date", calendar)
    return encode(add_room_types(add_demand_index(df), room_types), ["season", "room_type_name"])


def derive_meal_quantities(df: DataFrame) -> DataFrame:
    """Per-meal quantity from the revenue share, and the cross-check from the average item value."""
    out = {}
    for m in C.MEALS:
        share = safe_ratio(F.col(f"{m}_revenue"), F.col("total_revenue"), 0.0)
        out[f"{m}_qty"] = F.col("items_sold") * share
        out[f"{m}_qty_check"] = safe_ratio(F.col(f"{m}_revenue"), F.col("avg_item_value"), 0.0)
    return df.withColumns(out)


def meal_divergence(df: DataFrame, limit: float = 0.20) -> DataFrame:
    """Rows per meal whose two quantity estimates differ by more than ``limit`` of the first."""
    counts = []
    for m in C.MEALS:
        gap = safe_ratio(F.abs(F.col(f"{m}_qty") - F.col(f"{m}_qty_check")), F.col(f"{m}_qty"), 0.0)
        counts.append(F.struct(F.lit(m).alias("meal"), F.count_if(gap > limit).alias("divergent")))
    return df.agg(F.array(*counts).alias("a"), F.count("*").alias("row_count")).select(F.inline("a"), "row_count")


def restaurant_features(mart: DataFrame, calendar: DataFrame) -> DataFrame:
    df = derive_meal_quantities(add_calendar(mart, "date", calendar))
    df = add_lags(df, "total_orders", [1, 7], ["branch_id"], "date")
    df = add_trailing_means(df, "total_orders", [7], ["branch_id"], "date")
    return fill_with_medians(df, [c for c in df.columns if "lag" in c or "rolling" in c])


def staff_features(mart: DataFrame, calendar: DataFrame) -> DataFrame:
    """Lags per (branch, department), so branches are not mixed."""
    group = ["branch_id", "department_name"]
    df = add_calendar(mart, "date", calendar)
    df = add_lags(df, "present_employees", [1, 7, 30], group, "date")
    df = add_trailing_means(df, "present_employees", [7, 30], group, "date")
    df = fill_with_medians(df, [c for c in df.columns if "lag" in c or "rolling" in c])
    return apply_categories(df, "department_name", fit_categories(df, "department_name"))


def guest_totals(fact: DataFrame) -> DataFrame:
    """Nights and cancellation ratio per guest in one aggregate over the fact."""
    canceled = F.coalesce(F.col("reservation_status") == "Canceled", F.lit(False))
    return fact.groupBy("guest_key").agg(
        F.sum("nights").alias("total_nights"), F.avg(canceled.cast("int")).alias("cancellation_ratio")
    )


def label_churn(df: DataFrame, snapshot: Column, window_days: int = C.CHURN_WINDOW_DAYS) -> DataFrame:
    """Recency and label for guests with at least one booking; an unknown last stay is not churn."""
    recency = F.datediff(snapshot, F.col("last_stay_date"))
    return df.where(F.col("lifetime_bookings") >= 1).withColumns({
        "recency_days": recency,
        "churn": F.coalesce(recency > window_days, F.lit(False)).cast("int"),
    })


def add_rfm(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "frequency": F.col("lifetime_bookings"), "monetary": F.col("lifetime_spend"),
        "avg_spend_per_stay": safe_ratio(F.col("lifetime_spend"), F.col("lifetime_bookings"), 0.0),
    })


def churn_features(dim_guest: DataFrame, fact: DataFrame) -> DataFrame:
    """Guest features. The fact is reduced to one row per guest before the join; the snapshot is a scalar subquery."""
    df = dim_guest.join(guest_totals(fact), "guest_key", "left").withColumns({
        "total_nights": F.coalesce("total_nights", F.lit(0)),
        "cancellation_ratio": F.coalesce("cancellation_ratio", F.lit(0.0)),
        "repeat_guest": (F.col("lifetime_bookings") > 1).cast("int"),
    })
    snapshot = dim_guest.agg(F.date_add(F.max("last_stay_date"), 1)).scalar()
    return add_rfm(label_churn(df, snapshot))


def hash_split(key: Column, test_share: float = 0.2) -> Column:
    """Deterministic random split: the key's hash bucket decides."""
    from staylytics.functions.keys import hash63

    return F.when(F.pmod(hash63(key.cast("string")), F.lit(100)) < int((1 - test_share) * 100), "train").otherwise("test")


def column_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample deviation, min and max per column, three decimals, from one aggregate."""
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.round(F.avg(c), 3).alias("mean"), F.round(F.stddev_samp(c), 3).alias("std"),
            F.round(F.min(c).cast("double"), 3).alias("min"), F.round(F.max(c).cast("double"), 3).alias("max"),
        )
        for c in columns
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def top_correlations(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """Strongest distinct column pairs by absolute Pearson correlation; all pairs in one aggregate. Where one of two columns does not
    vary the correlation is not a number, which sorts first, as in SQL."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]

    def strength(a: str, b: str) -> Column:
        # corr() itself divides by the deviations, which fails where one is 0
        x, y = (F.when(F.col(other).isNotNull(), F.col(own).cast("double")) for own, other in ((a, b), (b, a)))
        found = F.round(F.abs(F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))), 6)
        return F.when(F.count(x + y) > 0, F.coalesce(found, F.lit(float("nan"))))

    rows = F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), strength(a, b).alias("abs_corr")) for a, b in pairs
    ])
    listed = df.agg(rows.alias("r")).select(F.inline("r"))
    return listed.where("abs_corr is not null").orderBy(F.desc("abs_corr"), "feature_a", "feature_b").limit(n)
