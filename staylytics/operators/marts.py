"""Daily marts. All are at most one row per (branch, day[, department]), whatever the size of the inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.dates import is_weekend
from staylytics.functions.keys import lookup
from staylytics.operators.joins import placed
from staylytics.operators.windows import trailing_mean
from staylytics.sources.lake import Lake

BRANCH_ROOMS = 20  # capacity assumed for each nation-level branch


def clip(c: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Clamp to [low, high]; NULL stays NULL (least/greatest alone would drop it)."""
    out = c if low is None else F.greatest(c, low)
    out = out if high is None else F.least(out, high)
    return F.when(c.isNotNull(), out)


def occupying(fact: DataFrame) -> DataFrame:
    """Bookings that used a room; a NULL status counts as occupying."""
    status = F.coalesce(F.col("reservation_status").isin(C.NON_OCCUPYING), F.lit(False))
    return fact.where(~status & (F.col("nights") > 0))


def known_check_in(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Keep bookings whose check-in key is in the date dimension."""
    return fact.join(dim_date.select(F.col("date_key").alias("check_in_date_key")), "check_in_date_key", "left_semi")


def occupied_nights(fact: DataFrame) -> DataFrame:
    """One row per occupied night of each stay; the check-out day is not a night."""
    return occupying(fact).withColumn(
        "stay_date", F.explode(F.sequence("arrival_date", F.date_add("arrival_date", F.col("nights") - 1)))
    )


def rooms_by_rate(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """Rooms per (branch, night, rate). Rates can be as many as bookings: with ``parts`` the nights are dealt over that many tasks
    first, so that none holds the groups of more."""
    groups = ["branch_key", "hotel", "stay_date", "adr_cents"]
    nights = occupied_nights(fact).select(*groups)
    return (nights if parts is None else placed(nights, parts, *groups)).groupBy(*groups).agg(F.count("*").alias("rooms"))


def nightly_totals(fact: DataFrame) -> DataFrame:
    """Rooms and rate cents per (branch, night). Stays with equal branch, arrival and length are summed before the
    expansion, so the exploded input is bounded by the calendar and not by the number of bookings."""
    stays = occupying(fact).groupBy("branch_key", "hotel", "arrival_date", "nights").agg(
        F.count("*").alias("rooms"), F.sum("adr_cents").alias("cents")
    )
    nights = stays.withColumn(
        "stay_date", F.explode(F.sequence("arrival_date", F.date_add("arrival_date", F.col("nights") - 1)))
    )
    return nights.groupBy("branch_key", "hotel", "stay_date").agg(
        F.sum("rooms").alias("occupied_rooms"), F.sum("cents").alias("revenue_cents")
    )


def daily_occupancy(fact: DataFrame) -> DataFrame:
    """Daily occupancy and revenue per hotel with trailing means that exclude the current row."""
    rooms = F.element_at(lookup(C.TOTAL_ROOMS), F.col("hotel"))
    daily = nightly_totals(fact).select(
        F.col("branch_key").alias("branch_id"), F.col("hotel").alias("branch_name"),
        F.col("stay_date").alias("occupancy_date"), "occupied_rooms", rooms.alias("total_rooms"),
        clip(F.col("occupied_rooms") / rooms * 100, high=F.lit(100.0)).alias("occupancy_pct"),
        (F.col("revenue_cents") / 100).alias("total_revenue"),
        (F.col("revenue_cents") / (F.col("occupied_rooms") * 100)).alias("avg_daily_rate"),
    )

    def trailing(c: str, n: int) -> Column:
        return F.coalesce(trailing_mean(c, n, ["branch_id"], "occupancy_date"), F.col(c))

    return daily.withColumns({
        "revenue_7day_avg": trailing("total_revenue", 7),
        "occupancy_7day_avg": trailing("occupancy_pct", 7),
        "occupancy_30day_avg": trailing("occupancy_pct", 30),
    })


def branch_days(lake: Lake) -> DataFrame:
    """Order lines per (supplier nation, ship date) in whole cents; shared by the revenue and restaurant marts."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    slot = F.col("l_linenumber") % 3
    lines = lake.table("lineitem").join(lake.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.groupBy(F.col("s_nationkey").alias("branch_id"), F.col("l_shipdate").cast("date").alias("date")).agg(
        F.count("*").alias("total_orders"),
        F.sum(F.col("l_quantity").cast("long")).alias("items_sold"),
        F.sum(cents).alias("total_cents"),
        *[F.sum(F.when(slot == i, cents).otherwise(0)).alias(f"{m}_cents") for i, m in enumerate(C.MEALS)],
    )


def mart_revenue_daily(lake: Lake, days: DataFrame | None = None) -> DataFrame:
    room = F.col("lunch_cents") + F.col("dinner_cents")
    mart = (branch_days(lake) if days is None else days).select(
        "branch_id", "date", (F.col("total_cents") / 100).alias("total_revenue"), (room / 100).alias("room_revenue"),
        (F.col("breakfast_cents") / 100).alias("fb_revenue"),
        (F.col("total_cents") / (F.col("items_sold") * 100)).alias("avg_daily_rate"),
        (room / (100 * BRANCH_ROOMS)).alias("revpar"),
        clip(F.col("total_orders") / BRANCH_ROOMS * 100, high=F.lit(100.0)).alias("occupancy_pct"),
    )
    mean = trailing_mean("total_revenue", 7, ["branch_id"], "date")
    return mart.withColumn("revenue_7day_avg", F.coalesce(mean, F.col("total_revenue")))


def mart_restaurant_daily(lake: Lake, days: DataFrame | None = None) -> DataFrame:
    return (branch_days(lake) if days is None else days).select(
        "branch_id", "date", "total_orders", "items_sold", (F.col("total_cents") / 100).alias("total_revenue"),
        (F.col("total_cents") / (F.col("total_orders") * 100)).alias("avg_order_value"),
        (F.col("total_cents") / (F.col("items_sold") * 100)).alias("avg_item_value"),
        *[(F.col(f"{m}_cents") / 100).alias(f"{m}_revenue") for m in C.MEALS],
    )


def mart_staff_daily(lake: Lake) -> DataFrame:
    return (
        lake.table("events")
        .groupBy(
            (F.col("user_id") % 2 + 1).cast("int").alias("branch_id"), F.col("event_type").alias("department_name"),
            F.col("ts").cast("date").alias("date"),
        )
        .agg(F.count("*").alias("scheduled_employees"), F.count_if(F.col("value") >= 10).alias("present_employees"))
        .withColumn("attendance_rate_pct", F.col("present_employees") / F.col("scheduled_employees") * 100)
    )


def mart_occupancy_daily(daily: DataFrame) -> DataFrame:
    return daily.select(
        "branch_id", F.col("occupancy_date").alias("date"), "occupancy_pct", "occupancy_7day_avg",
        "occupancy_30day_avg", "total_rooms", "occupied_rooms",
    )


def guest_history(dim_guest: DataFrame, fact: DataFrame) -> DataFrame:
    """Guest dimension with completed-stay totals. The fact is summed per guest before the join, so a guest with
    very many bookings contributes one row to the join."""
    completed = (
        fact.where("is_completed")
        .groupBy("guest_key")
        .agg(
            F.count("*").alias("completed_bookings"), F.sum("nights").alias("total_nights"),
            F.sum("total_amount_cents").alias("cents"),
        )
    )
    return dim_guest.join(completed, "guest_key", "left").select(
        *dim_guest.columns, F.coalesce("completed_bookings", F.lit(0)).alias("completed_bookings"),
        F.coalesce("total_nights", F.lit(0)).alias("total_nights"),
        F.coalesce(F.col("cents") / (F.col("completed_bookings") * 100), F.lit(0.0)).alias("avg_spend_per_stay"),
    )


def _weekday_factor(day: str) -> Column:
    return F.when(is_weekend(F.col(day)), C.WEEKEND_FACTOR).otherwise(1.0)


def expected_meal_revenue(daily: DataFrame) -> DataFrame:
    """Meal revenue implied by occupied rooms and weekday (the noise-free relation)."""
    factor = _weekday_factor("occupancy_date")
    return daily.select(
        "branch_id", F.col("occupancy_date").alias("date"),
        *[
            F.round(F.lit(C.MEAL_REVENUE_PER_ROOM[m]) * F.col("occupied_rooms") * factor, 2).alias(f"{m}_revenue")
            for m in C.MEALS
        ],
    )


def expected_staff(daily: DataFrame) -> DataFrame:
    """Scheduled headcount per department implied by occupied rooms and weekday."""
    factor = _weekday_factor("occupancy_date")
    departments = F.array(*[
        F.struct(
            F.lit(i + 1).alias("department_id"), F.lit(name).alias("department_name"),
            F.ceil(F.lit(ratio) * F.col("occupied_rooms") * factor).alias("scheduled_employees"),
        )
        for i, (name, ratio) in enumerate(C.STAFF_RATIO.items())
    ])
    return daily.select("branch_id", F.col("occupancy_date").alias("date"), F.inline(departments))
