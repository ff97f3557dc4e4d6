"""Checks for keys, dimensions, fact, integrity checks and upsert."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.registry import query
from staylytics.checks.views import _HASHED, hash63, pipe, view
from staylytics.functions import keys
from staylytics.operators import cleaning, marts, sketches
from staylytics.operators import warehouse as ops
from staylytics.operators.ordering import with_global_index
from staylytics.session import scratch_path, settle
from staylytics.sources import io
from staylytics.sources.bookings import booking_parts, bookings, raw_bookings


@query("A2_dim_date", """
SELECT date_key, full_date::VARCHAR AS full_date, year(full_date)::INT AS year, month(full_date)::INT AS month,
  monthname(full_date) AS month_name, day(full_date)::INT AS day, (isodow(full_date) - 1)::INT AS day_of_week,
  weekofyear(full_date)::INT AS week_of_year, quarter(full_date)::INT AS quarter, isodow(full_date) >= 6 AS is_weekend
FROM dim_date""")
def _(lake):
    return ops.dim_date(bookings(lake))


@query("A3_dim_hotel", """
SELECT DISTINCT CASE hotel WHEN 'Resort Hotel' THEN 1 ELSE 2 END AS hotel_key,
  CASE hotel WHEN 'Resort Hotel' THEN 'RESORT' ELSE 'CITY' END AS hotel_id, hotel AS hotel_name FROM bookings ORDER BY 3""")
def _(lake):
    return ops.dim_hotel(bookings(lake))


@query("A4_sorted_code_sets", """
SELECT room_key AS room_type_id, string_agg(DISTINCT assigned_room_type, ', ' ORDER BY assigned_room_type) AS source_code_examples
FROM guest_rows GROUP BY 1""")
def _(lake):
    return ops.room_codes(bookings(lake))


@query("J16_dim_room_type", """
WITH codes AS (SELECT room_key, string_agg(DISTINCT assigned_room_type, ', ' ORDER BY assigned_room_type) AS ex
  FROM guest_rows GROUP BY 1),
seed(id, room_name, m) AS (VALUES (1, 'Standard', 1.0::DOUBLE), (2, 'Deluxe', 1.4::DOUBLE), (3, 'Suite', 2.0::DOUBLE))
SELECT id AS room_type_key, id AS room_type_id, room_name AS room_type_name, m AS base_price_multiplier,
  coalesce(ex, '') AS source_code_examples FROM seed LEFT JOIN codes ON id = room_key
UNION ALL SELECT 0, 0, 'Unmapped', NULL, ex FROM codes WHERE room_key = 0""")
def _(lake):
    return ops.dim_room_type(bookings(lake))


@query("A5_dim_guest", """
SELECT guest_key, guest_id, full_name, nationality, lifetime_bookings, lifetime_spend,
  first_stay_date::VARCHAR AS first_stay_date, last_stay_date::VARCHAR AS last_stay_date FROM dim_guest""")
def _(lake):
    return ops.dim_guest(bookings(lake))


@query("W5_stable_row_index", """
SELECT arrival_date::VARCHAR AS arrival_date, hotel, lead_time, adr_cents, row_hash, row_index FROM row_indexed""")
def _(lake):
    rows = bookings(lake).select(*ops.FACT_ORDER)
    return with_global_index(rows, ops.FACT_ORDER)


@query("D1_row_key_hash", f"""
SELECT {hash63(pipe([*_HASHED, 'row_index']))} AS reservation_id FROM row_indexed""")
def _(lake):
    return ops.fact_booking(bookings(lake)).select("reservation_id")


@query("A8_guest_cluster_stats", """
SELECT count(DISTINCT guest_key) AS distinct_guest_keys, count(*) AS total_rows,
  count(*) / count(DISTINCT guest_key) AS avg_rows_per_cluster FROM guest_rows""")
def _(lake):
    rows = bookings(lake).select(keys.guest_key().alias("guest_key"))
    return rows.agg(F.count_distinct("guest_key").alias("distinct_guest_keys"), F.count("*").alias("total_rows")).withColumn(
        "avg_rows_per_cluster", F.col("total_rows") / F.col("distinct_guest_keys")
    )


@query("J7_room_tier_lookup", """
SELECT assigned_room_type AS code, room_key AS room_type_id, count(*) AS row_count FROM guest_rows GROUP BY 1, 2""")
def _(lake):
    return bookings(lake).groupBy(
        F.col("assigned_room_type").alias("code"), keys.room_tier(F.col("assigned_room_type")).alias("room_type_id")
    ).agg(F.count("*").alias("row_count"))


@query("J8_strict_hotel_lookup", """
SELECT hotel, branch_key AS hotel_key, count(*) AS row_count FROM guest_rows GROUP BY 1, 2""")
def _(lake):
    return bookings(lake).groupBy("hotel", keys.hotel_key(F.col("hotel")).alias("hotel_key")).agg(
        F.count("*").alias("row_count")
    )


def _integrity_inputs(lake):
    """Fact of all bookings against dimensions of completed stays only, so orphans occur."""
    rows = settle(bookings(lake))
    done = rows.where(F.col("reservation_status") == "Check-Out")
    return ops.fact_rows(rows), done


_FK = """SELECT '{name}' AS fk_name, (SELECT count(*) FROM o{i}) AS orphan_count,
  (SELECT coalesce(string_agg(k::VARCHAR, ',' ORDER BY k), '') FROM (SELECT k FROM o{i} ORDER BY k LIMIT 5)) AS sample_orphans"""
_FKS = [
    ("room_key", "room_key", "SELECT unnest([1, 2, 3]) UNION SELECT room_key FROM done"),
    ("branch_key", "branch_key", "SELECT branch_key FROM done"),
    ("guest_key", "guest_key", "SELECT guest_key FROM done"),
    ("check_in_date_key", "check_in_date_key", "SELECT check_in_date_key FROM done UNION SELECT check_out_date_key FROM done"),
    ("check_out_date_key", "check_out_date_key", "SELECT check_in_date_key FROM done UNION SELECT check_out_date_key FROM done"),
]


@query("J9_foreign_key_orphans", "WITH done AS (SELECT * FROM guest_rows WHERE is_completed), " + ", ".join(
    f"o{i} AS (SELECT DISTINCT {c} AS k FROM guest_rows WHERE {c} NOT IN ({p}))" for i, (_, c, p) in enumerate(_FKS)
) + " " + " UNION ALL ".join(_FK.format(name=n, i=i) for i, (n, _, _) in enumerate(_FKS)))
def _(lake):
    fact, done = _integrity_inputs(lake)
    dates, rooms = ops.dim_date(done), ops.dim_room_type(done)
    checks = [
        ops.foreign_key_check("room_key", fact, "room_key", rooms, "room_type_key"),
        ops.foreign_key_check("branch_key", fact, "branch_key", ops.dim_hotel(done), "hotel_key"),
        ops.foreign_key_check("guest_key", fact, "guest_key", ops.dim_guest(done), "guest_key"),
        ops.foreign_key_check("check_in_date_key", fact, "check_in_date_key", dates, "date_key"),
        ops.foreign_key_check("check_out_date_key", fact, "check_out_date_key", dates, "date_key"),
    ]
    return reduce(DataFrame.unionByName, checks)


_FACT_KEYS = f"SELECT {hash63(pipe([*_HASHED, 'row_index']))} AS k FROM row_indexed"


@query("A13_key_uniqueness", f"""
SELECT 'dim_date' AS table_name, count(*) AS row_count, count(*) = count(DISTINCT date_key) AS pk_unique, 0::BIGINT AS null_violations FROM dim_date
UNION ALL SELECT 'dim_guest', count(*), count(*) = count(DISTINCT guest_key), 0 FROM dim_guest
UNION ALL SELECT 'dim_hotel', count(DISTINCT hotel), true, 0 FROM bookings
UNION ALL SELECT 'dim_room_type', count(DISTINCT room_key), true, 0 FROM guest_rows
UNION ALL SELECT 'fact_booking', count(*), count(*) = count(DISTINCT k), 0 FROM ({_FACT_KEYS})""")
def _(lake):
    rows = settle(bookings(lake).drop("row_hash"))  # five tables come from the one join
    required = ["surrogate_key", "room_key", "branch_key", "guest_key", "check_in_date_key"]
    checks = [
        ops.key_check("dim_date", ops.dim_date(rows), "date_key", []),
        ops.key_check("dim_guest", ops.dim_guest(rows), "guest_key", []),
        ops.key_check("dim_hotel", ops.dim_hotel(rows), "hotel_key", []),
        ops.key_check("dim_room_type", ops.dim_room_type(rows), "room_type_key", []),
        ops.key_check("fact_booking", ops.fact_booking(rows), "surrogate_key", required),
    ]
    return reduce(DataFrame.unionByName, checks)


@query("A24_stage_row_counts", """
SELECT 'raw' AS stage, count(*) AS row_count FROM raw_bookings UNION ALL SELECT 'clean', count(*) FROM cleaned
UNION ALL SELECT 'dim_date', count(*) FROM dim_date UNION ALL SELECT 'dim_guest', count(*) FROM dim_guest
UNION ALL SELECT 'fact_booking', count(*) FROM guest_rows""")
def _(lake):
    raw, rows = raw_bookings(lake), bookings(lake)
    stages = {
        "raw": raw, "clean": cleaning.drop_negative_rates(cleaning.dedupe_full_row(raw)),
        "dim_date": ops.dim_date(rows), "dim_guest": ops.dim_guest(rows),
        "fact_booking": ops.resolvable(ops.fact_rows(rows)),
    }
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("stage"), "row_count") for n, df in stages.items()
    ])


@query("J3_hotel_name_and_capacity", """
SELECT branch_key AS branch_id, hotel AS branch_name, CASE hotel WHEN 'Resort Hotel' THEN 200 ELSE 300 END AS total_rooms,
  count(*) AS row_count FROM guest_rows GROUP BY 1, 2, 3""")
def _(lake):
    rows = bookings(lake)
    hotels = ops.dim_hotel(rows).select(F.col("hotel_key").alias("branch_key"), "hotel_name")
    per_branch = ops.fact_rows(rows).groupBy("branch_key").agg(F.count("*").alias("row_count"))
    return per_branch.join(hotels, "branch_key").select(
        F.col("branch_key").alias("branch_id"), F.col("hotel_name").alias("branch_name"),
        F.element_at(keys.lookup(C.TOTAL_ROOMS), F.col("hotel_name")).alias("total_rooms"), "row_count",
    )


@query("J10_known_check_in_semi_join", """
SELECT hotel, count(*) AS row_count, sum(nights)::BIGINT AS nights FROM guest_rows
WHERE check_in_date_key IN (SELECT check_in_date_key FROM guest_rows WHERE is_completed
  UNION SELECT check_out_date_key FROM guest_rows WHERE is_completed) GROUP BY 1""")
def _(lake):
    fact, done = _integrity_inputs(lake)
    return marts.known_check_in(fact, ops.dim_date(done)).groupBy("hotel").agg(
        F.count("*").alias("row_count"), F.sum("nights").alias("nights")
    )


@query("J11_night_expansion", """
SELECT branch_key, hotel, stay_date::VARCHAR AS stay_date, adr_cents, count(*) AS rooms FROM room_nights GROUP BY ALL""")
def _(lake):
    return marts.rooms_by_rate(ops.fact_rows(bookings(lake)), booking_parts(lake))


_DIM_SPLIT = """SELECT guest_key, min(country) AS nationality, count(*) AS lifetime_bookings,
  max(arrival_date) AS last_stay_date FROM guest_rows WHERE {cond} GROUP BY 1"""


@query("S10_keyed_upsert", f"""
WITH t AS ({_DIM_SPLIT.format(cond="arrival_date < DATE '1997-01-01'")}),
s AS ({_DIM_SPLIT.format(cond="arrival_date >= DATE '1997-01-01'")})
SELECT guest_key, nationality, lifetime_bookings, last_stay_date::VARCHAR AS last_stay_date FROM s
UNION ALL SELECT guest_key, nationality, lifetime_bookings, last_stay_date::VARCHAR FROM t
WHERE guest_key NOT IN (SELECT guest_key FROM s)""")
def _(lake):
    rows = bookings(lake)
    old = F.col("arrival_date") < "1997-01-01"
    columns = ["guest_key", "nationality", "lifetime_bookings", "last_stay_date"]
    target = ops.dim_guest(rows.where(old)).select(*columns)
    source = ops.dim_guest(rows.where(~old)).select(*columns)
    return ops.upsert(target, source, ["guest_key"])


# The stored table is dealt over 32 folders; guests of four of them get one more booking, and the other folders stay untouched.
@query("S10_partial_rewrite", f"""
SELECT guest_key, nationality, lifetime_bookings + (guest_key % 97 = 0)::INT AS lifetime_bookings, true AS kept_files FROM ({_DIM_SPLIT.format(cond="true")})""")
def _(lake):
    path, parts = scratch_path(lake.spark, "guests"), 32
    guests = settle(ops.dim_guest(bookings(lake)).select("guest_key", "nationality", "lifetime_bookings"))
    io.write_keyed(guests, path, ["guest_key"], parts)
    before = _files(lake.spark, path)
    changed = guests.where("guest_key % 97 = 0").withColumn("lifetime_bookings", F.col("lifetime_bookings") + 1)
    rewritten = set()
    for part in range(4):  # four small upserts
        rewritten |= set(io.upsert_keyed(changed.where(F.pmod(F.xxhash64("guest_key"), F.lit(parts)) % 4 == part), path, ["guest_key"], parts))
    kept = {f: t for f, t in before.items() if int(f.split("_part=")[1].split("/")[0]) not in rewritten}
    after = _files(lake.spark, path)
    same = all(after.get(f) == t for f, t in kept.items())
    return io.read_keyed(lake.spark, path).withColumn("kept_files", F.lit(same))


def _files(spark, path):
    """File names below a table with their times, from the metadata of its rows."""
    rows = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()  # a file a folder
    return {r[0]: r[1] for r in rows}


# Sketches kept per day; distinct guests and the median rate of any range come from united sketches, within the stated error.
@query("A8_distinct_from_sketches", """
SELECT hotel, strftime(date_trunc('month', arrival_date), '%Y-%m') AS month, count(*) AS row_count, true AS guests_close, true AS median_close FROM guest_rows GROUP BY 1, 2""")
def _(lake):
    rows = settle(bookings(lake).select("hotel", "arrival_date", keys.guest_key().alias("guest_key"), "adr_cents"))
    path = scratch_path(lake.spark, "sketches")
    sketches.daily(rows, ["hotel"], "arrival_date", "guest_key", "adr_cents").write.parquet(path)
    month = F.date_format("day", "yyyy-MM")
    found = sketches.united(lake.spark.read.parquet(path).withColumn("month", month), ["hotel", "month"], 0.5)
    exact = rows.groupBy("hotel", F.date_format("arrival_date", "yyyy-MM").alias("month")).agg(
        F.count_distinct("guest_key").alias("guests"), F.percentile("adr_cents", F.array(F.lit(0.5 - sketches.RANK_ERROR), F.lit(0.5 + sketches.RANK_ERROR))).alias("band"))
    both = found.join(exact, ["hotel", "month"])
    near = F.abs(F.col("distinct_count") - F.col("guests")) <= F.greatest(F.lit(2.0), F.col("guests") * sketches.DISTINCT_ERROR)
    inside = F.col("quantile").between(F.col("band")[0] - 1, F.col("band")[1] + 1)
    return both.select("hotel", "month", F.col("n").alias("row_count"), near.alias("guests_close"), inside.alias("median_close"))
