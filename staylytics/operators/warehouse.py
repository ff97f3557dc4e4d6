"""Star schema: dimensions, the booking fact, key checks and keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions import keys
from staylytics.functions.dates import is_weekend
from staylytics.operators.ordering import with_global_index
from staylytics.sources.bookings import HASH_COLUMNS
from staylytics.session import settle

FACT_ORDER = ["arrival_date", "hotel", "lead_time", "adr_cents", "row_hash"]


def check_out() -> Column:
    return F.date_add("arrival_date", keys.nights())


def dim_date(bookings: DataFrame) -> DataFrame:
    """One row per check-in or check-out date; both dates come from one scan and collapse map-side."""
    days = (
        bookings.select(F.explode(F.array("arrival_date", check_out())).alias("full_date"))
        .where(F.col("full_date").isNotNull())
        .distinct()
    )
    d = F.col("full_date")
    return days.select(
        keys.date_key(d).alias("date_key"), d, F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.day(d).alias("day"), F.weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"), F.quarter(d).alias("quarter"), is_weekend(d).alias("is_weekend"),
    )


def dim_hotel(bookings: DataFrame) -> DataFrame:
    name = F.col("hotel_name")
    return (
        bookings.where(F.col("hotel").isNotNull())
        .select(F.col("hotel").alias("hotel_name"))
        .distinct()
        .select(
            keys.hotel_key(name).alias("hotel_key"),
            F.when(name == "Resort Hotel", "RESORT").otherwise("CITY").alias("hotel_id"),
            name,
        )
        .orderBy("hotel_name")
    )


def room_codes(bookings: DataFrame) -> DataFrame:
    """Observed room letters per tier as a sorted, comma-joined list; letters are made distinct first."""
    code = F.upper(F.trim("assigned_room_type"))
    return (
        bookings.where(F.col("assigned_room_type").isNotNull())
        .select(code.alias("code"))
        .distinct()
        .groupBy(keys.room_tier(F.col("code")).alias("room_type_id"))
        .agg(F.concat_ws(", ", F.array_sort(F.collect_set("code"))).alias("source_code_examples"))
    )


def dim_room_type(bookings: DataFrame) -> DataFrame:
    """Seed tiers left-joined to observed letters, plus the unmapped tier when any unknown letter occurs."""
    spark = bookings.sparkSession
    seed = spark.createDataFrame(
        C.ROOM_TYPE_SEED, "room_type_id int, room_type_name string, base_price_multiplier double"
    )
    codes = room_codes(bookings)
    known = seed.join(codes, "room_type_id", "left")
    unmapped = codes.where(F.col("room_type_id") == C.UNMAPPED_TIER).select(
        "room_type_id", F.lit("Unmapped").alias("room_type_name"),
        F.lit(None).cast("double").alias("base_price_multiplier"), "source_code_examples",
    )
    return known.unionByName(unmapped).select(
        F.col("room_type_id").alias("room_type_key"), "room_type_id", "room_type_name", "base_price_multiplier",
        F.coalesce("source_code_examples", F.lit("")).alias("source_code_examples"),
    )


def dim_guest(bookings: DataFrame) -> DataFrame:
    """Profile clusters with lifetime counts; spend stays in whole cents so the sum is order-free."""
    return (
        bookings.select(
            keys.guest_key().alias("guest_key"), "country", "arrival_date",
            (keys.nights() * F.col("adr_cents")).alias("spend_cents"),
        )
        .groupBy("guest_key")
        .agg(
            F.min("country").alias("nationality"), F.count("*").alias("lifetime_bookings"),
            F.sum("spend_cents").alias("lifetime_spend_cents"), F.min("arrival_date").alias("first_stay_date"),
            F.max("arrival_date").alias("last_stay_date"),
        )
        .select(
            "guest_key", F.col("guest_key").alias("guest_id"), F.lit(None).cast("string").alias("full_name"),
            "nationality", "lifetime_bookings", (F.col("lifetime_spend_cents") / 100).alias("lifetime_spend"),
            "first_stay_date", "last_stay_date",
        )
    )


def status_flags(df: DataFrame) -> DataFrame:
    status = F.col("reservation_status")
    return df.withColumns(
        {"is_terminal": status.isin(C.TERMINAL), "is_completed": status == "Check-Out"}
    )


def fact_rows(bookings: DataFrame) -> DataFrame:
    """Fact columns without the surrogate key: a narrow projection, enough for marts and features."""
    rows = bookings.select(
        "*", keys.nights().alias("nights"), keys.guest_key().alias("guest_key"),
        keys.room_tier(F.col("assigned_room_type")).alias("room_key"),
        keys.hotel_key(F.col("hotel")).alias("branch_key"),
        keys.date_key(F.col("arrival_date")).alias("check_in_date_key"),
        keys.date_key(check_out()).alias("check_out_date_key"),
    )
    return status_flags(rows).withColumn("total_amount_cents", F.col("nights") * F.col("adr_cents"))


def resolvable(fact: DataFrame) -> DataFrame:
    """Rows whose date keys exist."""
    return fact.where(F.col("check_in_date_key").isNotNull() & F.col("check_out_date_key").isNotNull())


def fact_booking(bookings: DataFrame) -> DataFrame:
    """Booking fact; the key hashes all columns plus the row's position in a fixed total order.

    The content hash only orders the rows: it is half as long in bytes, which sort as its hex digits do, and no file holds it.
    """
    content = F.unhex(F.sha2(keys.joined(HASH_COLUMNS), 256))
    indexed = with_global_index(bookings.withColumn("row_hash", content), FACT_ORDER, drop=["row_hash"])
    keyed = indexed.withColumn("surrogate_key", keys.hash63(keys.joined([*HASH_COLUMNS, "row_index"])))
    fact = resolvable(fact_rows(keyed))
    return fact.select(
        "surrogate_key", F.col("surrogate_key").alias("reservation_id"), "reservation_status", "room_key",
        "branch_key", "guest_key", "check_in_date_key", "check_out_date_key", "nights", "adults", "children",
        (F.col("total_amount_cents") / 100).alias("total_amount"), (F.col("adr_cents") / 100).alias("avg_daily_rate"),
        "is_terminal", "is_completed", "is_adults_outlier",
    )


def key_check(name: str, table: DataFrame, pk: str, required: list[str]) -> DataFrame:
    """Row count, key uniqueness and NULLs in required columns, in one aggregate."""
    nulls = F.lit(0)
    for c in required:
        nulls = nulls + F.count_if(F.col(c).isNull())
    return table.agg(
        F.count("*").alias("row_count"), (F.count("*") == F.count_distinct(pk)).alias("pk_unique"),
        nulls.cast("long").alias("null_violations"),
    ).select(F.lit(name).alias("table_name"), "row_count", "pk_unique", "null_violations")


def foreign_key_check(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys missing from the parent: count and the five smallest."""
    wanted = child.select(F.col(child_key).alias("k")).where("k is not null").distinct()
    present = parent.select(F.col(parent_key).alias("k")).distinct()
    orphans = settle(wanted.join(present, "k", "left_anti"))
    sample = orphans.orderBy("k").limit(5).agg(F.concat_ws(",", F.sort_array(F.collect_list("k"))))
    return orphans.agg(F.count("*").alias("orphan_count")).select(
        F.lit(name).alias("fk_name"), "orphan_count", sample.scalar().alias("sample_orphans")
    )


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Insert-or-update by key: source rows win, untouched target rows stay. With no other columns nothing changes."""
    if set(source.columns) == set(key):
        return target.unionByName(source.join(target, key, "left_anti"))
    return target.join(source, key, "left_anti").unionByName(source)
