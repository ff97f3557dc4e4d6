"""Booking records derived from the order tables: a raw (defective) view and a clean view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions import keys
from staylytics.operators.joins import parts_of
from staylytics.sources.lake import Lake

TASK_BOOKINGS = 500_000  # what a task of the join below holds

_ROOM_LETTERS = "ABCDEFGHIKLP"


def _letter(number: str) -> str:
    return f"substring('{_ROOM_LETTERS}', cast(({number}) % 12 as int) + 1, 1)"


# Column name -> expression over lineitem joined with orders, customer and nation.
_BOOKING_COLUMNS = {
    "hotel": "CASE WHEN l_suppkey % 2 = 1 THEN 'Resort Hotel' ELSE 'City Hotel' END",
    "is_canceled": "cast(l_returnflag = 'R' as bigint)",
    "lead_time": "cast(abs(datediff(l_shipdate, o_orderdate)) as bigint)",
    "arrival_date_year": "cast(year(l_shipdate) as bigint)",
    "arrival_date_month": f"CASE WHEN l_shipdate IS NOT NULL THEN element_at(array({', '.join(repr(m) for m in C.MONTH_DAYS)}), month(l_shipdate)) END",
    "arrival_date_week_number": "cast(weekofyear(l_shipdate) as bigint)",
    "arrival_date_day_of_month": "cast(day(l_shipdate) as bigint)",
    "stays_in_weekend_nights": "cast(l_linenumber % 3 as bigint)",
    "stays_in_week_nights": "cast(l_quantity as bigint) % 6",
    "adults": "cast(1 + l_linenumber % 3 as bigint)",
    "children": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE cast(l_linenumber % 2 as bigint) END",
    "babies": "cast(l_partkey % 50 = 0 as bigint)",
    "meal": "element_at(array('BB', 'HB', 'FB', 'SC'), cast(l_partkey % 4 as int) + 1)",
    "country": "n_name",
    "market_segment": "c_mktsegment",
    "distribution_channel": "element_at(array('Direct', 'Corporate', 'TA/TO'), cast(o_custkey % 3 as int) + 1)",
    "is_repeated_guest": "cast(o_orderstatus = 'F' as bigint)",
    "previous_cancellations": "cast(l_orderkey % 5 = 0 as bigint)",
    "previous_bookings_not_canceled": "l_orderkey % 3",
    "reserved_room_type": _letter("l_partkey"),
    "assigned_room_type": _letter("l_partkey + l_linenumber % 2"),
    "booking_changes": "cast(l_linenumber % 2 as bigint)",
    "deposit_type": "element_at(array('No Deposit', 'Refundable', 'Non Refund'), cast(l_orderkey % 3 as int) + 1)",
    "agent": "l_suppkey",
    "company": "CASE WHEN l_suppkey % 7 = 0 THEN l_suppkey % 50 END",
    "days_in_waiting_list": "l_orderkey % 4",
    "customer_type": "o_orderpriority",
    "adr_cents": "cast(floor(l_extendedprice / l_quantity * 10) as bigint)",
    "required_car_parking_spaces": "cast(l_linenumber % 2 as bigint)",
    "total_of_special_requests": "l_partkey % 3",
    "reservation_status": "CASE WHEN l_returnflag = 'R' THEN 'Canceled' "
    "WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'No-Show' ELSE 'Check-Out' END",
    "reservation_status_date": "cast(date_add(cast(l_shipdate as date), "
    "cast(l_linenumber % 3 + cast(l_quantity as bigint) % 6 as int)) as string)",
}

HASH_COLUMNS = [c if c != "adr" else "adr_cents" for c in C.RAW_COLUMNS]


def booking_parts(lake: Lake) -> int | None:
    """Parts of ``TASK_BOOKINGS``, where the width of a shuffle would give larger ones."""
    return parts_of(lake.spark, lake.rows("lineitem"), TASK_BOOKINGS)


def _joined(lake: Lake) -> DataFrame:
    # both tables are facts; joined by a shuffle, the derived columns are computed in all its partitions
    orders, lines, parts = lake.table("orders"), lake.table("lineitem"), booking_parts(lake)
    if parts is not None:
        orders, lines = orders.repartition(parts, "o_orderkey"), lines.repartition(parts, "l_orderkey")
    customers = lake.table("customer")
    nations = lake.table("nation")
    return (
        lines
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def bookings(lake: Lake) -> DataFrame:
    """Clean booking rows: the 32 source columns (rate in whole cents), arrival date, outlier flag, content hash."""
    columns = [F.expr(e).alias(n) for n, e in _BOOKING_COLUMNS.items()]
    return (
        _joined(lake)
        .select(*columns, F.col("l_shipdate").cast("date").alias("arrival_date"))
        .withColumn("is_adults_outlier", F.col("adults") > 10)
        .withColumn("row_hash", F.sha2(keys.joined(HASH_COLUMNS), 256))
    )


# Defects by part or order number: column -> replacement expression.
_DEFECTS = {
    "meal": "CASE WHEN l_partkey % 97 = 0 THEN 'Undefined' ELSE meal END",
    "market_segment": "CASE WHEN l_partkey % 91 = 0 THEN 'Undefined' ELSE market_segment END",
    "distribution_channel": "CASE WHEN l_partkey % 103 = 0 THEN 'Undefined' ELSE distribution_channel END",
    "country": "CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN 'CN' "
    "WHEN l_partkey % 79 = 0 THEN concat(' ', country, '\\t') ELSE country END",
    "adr_cents": "CASE WHEN l_partkey % 101 = 0 THEN -adr_cents ELSE adr_cents END",
    "adults": "CASE WHEN l_partkey % 107 = 0 THEN 55 ELSE adults END",
    "arrival_date_month": "CASE WHEN l_orderkey % 500 = 0 THEN 'April' ELSE arrival_date_month END",
    "arrival_date_day_of_month": "CASE WHEN l_orderkey % 500 = 0 THEN 31 ELSE arrival_date_day_of_month END",
    "is_canceled": "CASE WHEN l_partkey % 127 = 0 THEN 1 - is_canceled ELSE is_canceled END",
    "agent": "CASE WHEN l_partkey % 131 = 0 THEN 'n/a' ELSE cast(agent as string) END",
    "company": "cast(company as string)",
    "reservation_status_date": "CASE WHEN l_partkey % 137 = 0 THEN 'unknown' ELSE reservation_status_date END",
}


def raw_bookings(lake: Lake) -> DataFrame:
    """Booking rows with injected defects and exact copies, as a file from an operational system would hold them."""
    base = _joined(lake).select(
        *[F.expr(e).alias(n) for n, e in _BOOKING_COLUMNS.items()], "l_partkey", "l_orderkey"
    )
    dirty = base.select(
        "l_orderkey", *[F.expr(_DEFECTS.get(n, n)).alias(n) for n in _BOOKING_COLUMNS]
    )
    copies = F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1)
    # Each affected row is repeated by a narrow explode, so the join is read once.
    return dirty.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", "l_orderkey")
