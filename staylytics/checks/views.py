"""Shared DuckDB views (as CTEs) that oracle statements may refer to by name."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


_SOURCES = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+(?:\s*,\s*[a-z_0-9]+)*)")


def _referenced(sql: str) -> list[str]:
    """View names that occur in FROM or JOIN position, outside string literals."""
    bare = re.sub(r"'[^']*'", "''", sql)
    names = [n.strip() for group in _SOURCES.findall(bare) for n in group.split(",")]
    return [n for n in names if n in VIEWS]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it needs, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _referenced(text):
            if name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in ordered)
    body = sql.strip()
    if re.match(r"(?i)with\b", body):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


_LETTER = "substr('ABCDEFGHIKLP', (({n}) % 12)::INT + 1, 1)"

_HASHED = [
    "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_week_number",
    "arrival_date_day_of_month", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies",
    "meal", "country", "market_segment", "distribution_channel", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "reserved_room_type", "assigned_room_type", "booking_changes", "deposit_type",
    "agent", "company", "days_in_waiting_list", "customer_type", "adr_cents", "required_car_parking_spaces",
    "total_of_special_requests", "reservation_status", "reservation_status_date",
]


def pipe(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(({c})::VARCHAR, 'None')" for c in columns) + ")"


def hash63(text: str) -> str:
    return f"((('0x' || substr(sha256({text}), 1, 16))::UBIGINT) & 9223372036854775807::UBIGINT)::BIGINT"


GUEST_HASH = hash63(pipe(
    ["country", "market_segment", "distribution_channel", "customer_type", "is_repeated_guest", "agent", "company"]
))

view("booking_src", f"""
SELECT l_partkey, l_orderkey,
  CASE WHEN l_suppkey % 2 = 1 THEN 'Resort Hotel' ELSE 'City Hotel' END AS hotel,
  (l_returnflag = 'R')::BIGINT AS is_canceled,
  abs(date_diff('day', o_orderdate::DATE, l_shipdate::DATE))::BIGINT AS lead_time,
  year(l_shipdate)::BIGINT AS arrival_date_year, monthname(l_shipdate) AS arrival_date_month,
  weekofyear(l_shipdate)::BIGINT AS arrival_date_week_number, day(l_shipdate)::BIGINT AS arrival_date_day_of_month,
  (l_linenumber % 3)::BIGINT AS stays_in_weekend_nights, (l_quantity::BIGINT) % 6 AS stays_in_week_nights,
  (1 + l_linenumber % 3)::BIGINT AS adults,
  CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE (l_linenumber % 2)::BIGINT END AS children,
  (l_partkey % 50 = 0)::BIGINT AS babies,
  CASE l_partkey % 4 WHEN 0 THEN 'BB' WHEN 1 THEN 'HB' WHEN 2 THEN 'FB' ELSE 'SC' END AS meal,
  n_name AS country, c_mktsegment AS market_segment,
  CASE o_custkey % 3 WHEN 0 THEN 'Direct' WHEN 1 THEN 'Corporate' ELSE 'TA/TO' END AS distribution_channel,
  (o_orderstatus = 'F')::BIGINT AS is_repeated_guest, (l_orderkey % 5 = 0)::BIGINT AS previous_cancellations,
  l_orderkey % 3 AS previous_bookings_not_canceled,
  {_LETTER.format(n='l_partkey')} AS reserved_room_type,
  {_LETTER.format(n='l_partkey + l_linenumber % 2')} AS assigned_room_type,
  (l_linenumber % 2)::BIGINT AS booking_changes,
  CASE l_orderkey % 3 WHEN 0 THEN 'No Deposit' WHEN 1 THEN 'Refundable' ELSE 'Non Refund' END AS deposit_type,
  l_suppkey AS agent, CASE WHEN l_suppkey % 7 = 0 THEN l_suppkey % 50 END AS company,
  l_orderkey % 4 AS days_in_waiting_list, o_orderpriority AS customer_type,
  floor(l_extendedprice / l_quantity * 10)::BIGINT AS adr_cents,
  (l_linenumber % 2)::BIGINT AS required_car_parking_spaces, l_partkey % 3 AS total_of_special_requests,
  CASE WHEN l_returnflag = 'R' THEN 'Canceled' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'No-Show'
       ELSE 'Check-Out' END AS reservation_status,
  (l_shipdate::DATE + ((l_linenumber % 3) + (l_quantity::BIGINT) % 6)::INT)::VARCHAR AS reservation_status_date,
  l_shipdate::DATE AS arrival_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
""")

view("bookings", f"""
SELECT * EXCLUDE (l_partkey, l_orderkey), adults > 10 AS is_adults_outlier, sha256({pipe(_HASHED)}) AS row_hash
FROM booking_src
""")

view("raw_bookings", """
SELECT * EXCLUDE (l_partkey, l_orderkey, arrival_date) FROM (
  SELECT * REPLACE (
    CASE WHEN l_partkey % 97 = 0 THEN 'Undefined' ELSE meal END AS meal,
    CASE WHEN l_partkey % 91 = 0 THEN 'Undefined' ELSE market_segment END AS market_segment,
    CASE WHEN l_partkey % 103 = 0 THEN 'Undefined' ELSE distribution_channel END AS distribution_channel,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN l_partkey % 83 = 0 THEN 'CN'
         WHEN l_partkey % 79 = 0 THEN ' ' || country || chr(9) ELSE country END AS country,
    CASE WHEN l_partkey % 101 = 0 THEN -adr_cents ELSE adr_cents END AS adr_cents,
    CASE WHEN l_partkey % 107 = 0 THEN 55 ELSE adults END AS adults,
    CASE WHEN l_orderkey % 500 = 0 THEN 'April' ELSE arrival_date_month END AS arrival_date_month,
    CASE WHEN l_orderkey % 500 = 0 THEN 31 ELSE arrival_date_day_of_month END AS arrival_date_day_of_month,
    CASE WHEN l_partkey % 127 = 0 THEN 1 - is_canceled ELSE is_canceled END AS is_canceled,
    CASE WHEN l_partkey % 131 = 0 THEN 'n/a' ELSE agent::VARCHAR END AS agent,
    company::VARCHAR AS company,
    CASE WHEN l_partkey % 137 = 0 THEN 'unknown' ELSE reservation_status_date END AS reservation_status_date)
  FROM booking_src) s
CROSS JOIN (VALUES (1), (2)) copies(copy_no) WHERE copy_no = 1 OR l_orderkey % 50 = 0
""".replace("SELECT * EXCLUDE (l_partkey, l_orderkey, arrival_date)", "SELECT * EXCLUDE (l_partkey, l_orderkey, arrival_date, copy_no)"))

_TIER = ("CASE WHEN upper(trim(assigned_room_type)) IN ('A', 'B', 'C') THEN 1 WHEN upper(trim(assigned_room_type)) "
         "IN ('D', 'E', 'F', 'G') THEN 2 WHEN upper(trim(assigned_room_type)) IN ('H', 'L') THEN 3 ELSE 0 END")

view("guest_rows", f"""
SELECT *, {GUEST_HASH} AS guest_key, (stays_in_weekend_nights + stays_in_week_nights)::INT AS nights,
  {_TIER} AS room_key, CASE hotel WHEN 'Resort Hotel' THEN 1 WHEN 'City Hotel' THEN 2 END AS branch_key,
  strftime(arrival_date, '%Y%m%d')::INT AS check_in_date_key,
  strftime(arrival_date + (stays_in_weekend_nights + stays_in_week_nights)::INT, '%Y%m%d')::INT AS check_out_date_key,
  (stays_in_weekend_nights + stays_in_week_nights) * adr_cents AS total_amount_cents,
  reservation_status = 'Check-Out' AS is_completed
FROM bookings
""")

view("row_indexed", """
SELECT *, row_number() OVER (ORDER BY arrival_date, hotel, lead_time, adr_cents, row_hash) - 1 AS row_index FROM bookings
""")

view("dim_guest", """
SELECT guest_key, guest_key AS guest_id, NULL::VARCHAR AS full_name, min(country) AS nationality,
  count(*) AS lifetime_bookings, sum(total_amount_cents)::BIGINT / 100 AS lifetime_spend,
  min(arrival_date) AS first_stay_date, max(arrival_date) AS last_stay_date FROM guest_rows GROUP BY guest_key
""")

view("dim_date", """
SELECT DISTINCT d AS full_date, strftime(d, '%Y%m%d')::INT AS date_key FROM (
  SELECT arrival_date AS d FROM guest_rows UNION ALL SELECT arrival_date + nights FROM guest_rows)
""")

view("room_nights", """
SELECT branch_key, hotel, stay_date, adr_cents FROM (
  SELECT branch_key, hotel, adr_cents, arrival_date + unnest(range(nights))::INT AS stay_date FROM guest_rows
  WHERE reservation_status NOT IN ('Canceled', 'No-Show') AND nights > 0)
""")

view("daily_base", """
SELECT branch_key AS branch_id, hotel AS branch_name, stay_date AS occupancy_date, count(*) AS occupied_rooms,
  CASE hotel WHEN 'Resort Hotel' THEN 200 ELSE 300 END AS total_rooms,
  least(count(*) / (CASE hotel WHEN 'Resort Hotel' THEN 200 ELSE 300 END) * 100, 100.0::DOUBLE) AS occupancy_pct,
  sum(adr_cents)::BIGINT / 100 AS total_revenue, sum(adr_cents)::BIGINT / (count(*) * 100) AS avg_daily_rate
FROM room_nights GROUP BY 1, 2, 3
""")

view("daily_occ", """
SELECT *, coalesce(avg(total_revenue) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), total_revenue) AS revenue_7day_avg,
  coalesce(avg(occupancy_pct) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), occupancy_pct) AS occupancy_7day_avg,
  coalesce(avg(occupancy_pct) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), occupancy_pct) AS occupancy_30day_avg
FROM daily_base WINDOW w AS (PARTITION BY branch_id ORDER BY occupancy_date)
""")

view("branch_days", """
SELECT s_nationkey AS branch_id, l_shipdate::DATE AS date, count(*) AS total_orders, sum(l_quantity::BIGINT)::BIGINT AS items_sold,
  sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS total_cents,
  coalesce(sum(round(l_extendedprice * 100)::BIGINT) FILTER (WHERE l_linenumber % 3 = 0), 0)::BIGINT AS breakfast_cents,
  coalesce(sum(round(l_extendedprice * 100)::BIGINT) FILTER (WHERE l_linenumber % 3 = 1), 0)::BIGINT AS lunch_cents,
  coalesce(sum(round(l_extendedprice * 100)::BIGINT) FILTER (WHERE l_linenumber % 3 = 2), 0)::BIGINT AS dinner_cents
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
""")

view("mart_revenue", """
SELECT *, coalesce(avg(total_revenue) OVER (PARTITION BY branch_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  total_revenue) AS revenue_7day_avg FROM (
  SELECT branch_id, date, total_cents / 100 AS total_revenue, (lunch_cents + dinner_cents) / 100 AS room_revenue,
    breakfast_cents / 100 AS fb_revenue, total_cents / (items_sold * 100) AS avg_daily_rate,
    (lunch_cents + dinner_cents) / 2000 AS revpar, least(total_orders / 20 * 100, 100.0::DOUBLE) AS occupancy_pct
  FROM branch_days)
""")

view("mart_restaurant", """
SELECT branch_id, date, total_orders, items_sold, total_cents / 100 AS total_revenue,
  total_cents / (total_orders * 100) AS avg_order_value, total_cents / (items_sold * 100) AS avg_item_value,
  breakfast_cents / 100 AS breakfast_revenue, lunch_cents / 100 AS lunch_revenue, dinner_cents / 100 AS dinner_revenue
FROM branch_days
""")

view("mart_staff", """
SELECT (user_id % 2 + 1)::INT AS branch_id, event_type AS department_name, ts::DATE AS date,
  count(*) AS scheduled_employees, count(*) FILTER (WHERE value >= 10) AS present_employees,
  count(*) FILTER (WHERE value >= 10) / count(*) * 100 AS attendance_rate_pct FROM events GROUP BY 1, 2, 3
""")

view("calendar", """
SELECT DISTINCT l_shipdate::DATE AS date,
  (strftime(l_shipdate, '%m-%d') IN ('01-01', '05-01', '12-25', '12-26'))::INT AS is_public_holiday,
  (day(l_shipdate) = 15)::INT AS is_local_event,
  CASE strftime(l_shipdate, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '05-01' THEN 'Labour Day'
    WHEN '12-25' THEN 'Christmas' WHEN '12-26' THEN 'Second Christmas Day'
    ELSE CASE WHEN day(l_shipdate) = 15 THEN 'Local fair' END END AS event_name
FROM lineitem
""")


def calendar_columns(day: str) -> str:
    """Calendar feature columns for a frame ``f`` left-joined to ``calendar c``."""
    return f"""month({day})::INT AS month, quarter({day})::INT AS quarter, (isodow({day}) - 1)::INT AS day_of_week,
      (isodow({day}) >= 6)::INT AS is_weekend,
      CASE WHEN month({day}) IN (12, 1, 2) THEN 'winter' WHEN month({day}) <= 5 THEN 'spring'
           WHEN month({day}) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
      coalesce(c.is_public_holiday, 0) AS is_holiday, coalesce(c.is_local_event, 0) AS is_event,
      coalesce(c.event_name, '') AS event_name"""
