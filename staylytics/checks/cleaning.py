"""Checks for projections, filters and the booking cleaning steps."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.registry import query
from staylytics.checks.views import pipe, view
from staylytics.operators import cleaning as ops
from staylytics.operators import marts, warehouse
from staylytics.plans import jobs
from staylytics.session import scratch_path, settle
from staylytics.sources.bookings import booking_parts, bookings, raw_bookings

STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"

view("unique_raw", "SELECT DISTINCT * FROM raw_bookings")
view("rate_cap", "SELECT quantile_cont(adr_cents, 0.995) AS cap FROM unique_raw WHERE adr_cents >= 0")
_trim = ", ".join(
    f"{STRIP.format(c=c)} AS {c}" for c in C.CATEGORICAL_COLUMNS if c not in (*C.SENTINEL_COLUMNS, "country")
)
_sentinel = ", ".join(STRIP.format(c=f"nullif({c}, 'Undefined')") + f" AS {c}" for c in C.SENTINEL_COLUMNS)
view("cleaned", f"""
SELECT * REPLACE ({_trim}, {_sentinel},
    {STRIP.format(c="CASE WHEN country IS NULL THEN 'UNK' WHEN country = 'CN' THEN 'CHN' ELSE country END")} AS country,
    coalesce(children, 0) AS children, TRY_CAST(agent AS BIGINT) AS agent, TRY_CAST(company AS BIGINT) AS company,
    TRY_CAST(reservation_status_date AS DATE) AS reservation_status_date),
  (SELECT cap FROM rate_cap) AS winsor_cap, least(adr_cents::DOUBLE, (SELECT cap FROM rate_cap)) / 100 AS adr,
  adults > 10 AS is_adults_outlier,
  try_strptime(arrival_date_year || '-' || arrival_date_month || '-' || arrival_date_day_of_month, '%Y-%B-%d')::DATE
    AS arrival_date
FROM unique_raw WHERE adr_cents >= 0
""")


@query("P1_project_rename", """
SELECT o_orderpriority AS priority, o_orderkey AS order_id, o_custkey AS guest_no FROM orders""")
def _(lake):
    return (
        lake.table("orders")
        .withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "guest_no", "o_orderpriority": "priority"})
        .drop("o_orderstatus", "o_totalprice", "o_orderdate")
        .select("priority", "order_id", "guest_no")
    )


@query("A1_dedupe_full_row", "SELECT * FROM unique_raw")
def _(lake):
    return ops.dedupe_full_row(raw_bookings(lake))


@query("P2_sentinel_to_null", """
SELECT nullif(meal, 'Undefined') AS meal, nullif(market_segment, 'Undefined') AS market_segment,
  nullif(distribution_channel, 'Undefined') AS distribution_channel, count(*) AS row_count,
  count(*) FILTER (WHERE meal = 'Undefined') AS meal_changed,
  count(*) FILTER (WHERE market_segment = 'Undefined') AS segment_changed,
  count(*) FILTER (WHERE distribution_channel = 'Undefined') AS channel_changed
FROM raw_bookings GROUP BY 1, 2, 3""")
def _(lake):
    raw = raw_bookings(lake)
    marked = raw.withColumns({f"was_{c}": F.col(c) == "Undefined" for c in C.SENTINEL_COLUMNS})
    return ops.replace_undefined_with_null(marked).groupBy(*C.SENTINEL_COLUMNS).agg(
        F.count("*").alias("row_count"), F.count_if("was_meal").alias("meal_changed"),
        F.count_if("was_market_segment").alias("segment_changed"),
        F.count_if("was_distribution_channel").alias("channel_changed"),
    )


@query("P3_constant_imputation", """
SELECT coalesce(children, 0) AS children, coalesce(country, 'UNK') AS country, count(*) AS row_count
FROM raw_bookings GROUP BY 1, 2""")
def _(lake):
    return ops.impute_constants(raw_bookings(lake)).groupBy("children", "country").agg(
        F.count("*").alias("row_count")
    )


@query("P4_country_recode", """
SELECT CASE WHEN country = 'CN' THEN 'CHN' ELSE country END AS country, count(*) AS row_count,
  count(*) FILTER (WHERE country = 'CN') AS changed FROM raw_bookings GROUP BY 1""")
def _(lake):
    raw = raw_bookings(lake).withColumn("was_cn", F.col("country") == "CN")
    return ops.fix_country_code(raw).groupBy("country").agg(
        F.count("*").alias("row_count"), F.count_if("was_cn").alias("changed")
    )


@query("P5_non_negative_rate", """
SELECT hotel, count(*) AS row_count, min(adr_cents) AS min_cents, sum(adr_cents)::BIGINT AS sum_cents
FROM raw_bookings WHERE adr_cents >= 0 GROUP BY 1""")
def _(lake):
    return ops.drop_negative_rates(raw_bookings(lake)).groupBy("hotel").agg(
        F.count("*").alias("row_count"), F.min("adr_cents").alias("min_cents"), F.sum("adr_cents").alias("sum_cents")
    )


@query("P6_winsorize_rate", """
SELECT hotel, round(max(cap), 6) AS winsor_cap, count(*) FILTER (WHERE adr_cents > cap) AS capped,
  round(max(least(adr_cents::DOUBLE, cap) / 100), 6) AS max_adr,
  round(sum(least(adr_cents::DOUBLE, cap)) / 100, 2) AS sum_adr
FROM unique_raw, rate_cap WHERE adr_cents >= 0 GROUP BY 1""")
def _(lake):
    rows = settle(ops.drop_negative_rates(ops.dedupe_full_row(raw_bookings(lake))).select("hotel", "adr_cents"))
    return ops.winsorize_rates(rows).groupBy("hotel").agg(
        F.round(F.max("winsor_cap"), 6).alias("winsor_cap"),
        F.count_if(F.col("adr_cents") > F.col("winsor_cap")).alias("capped"),
        F.round(F.max("adr"), 6).alias("max_adr"),
        F.round(F.sum(F.least(F.col("adr_cents").cast("double"), F.col("winsor_cap"))) / 100, 2).alias("sum_adr"),
    )


@query("P7_adults_outlier_flag", """
SELECT adults, adults > 10 AS is_adults_outlier, count(*) AS row_count FROM raw_bookings GROUP BY 1, 2""")
def _(lake):
    return ops.flag_adults_outliers(raw_bookings(lake)).groupBy("adults", "is_adults_outlier").agg(
        F.count("*").alias("row_count")
    )


_RAW_HASH = "sha256(" + pipe([c if c != "adr" else "adr_cents" for c in C.RAW_COLUMNS]) + ")"


@query("P8_cancellation_consistency", f"""
WITH m AS (SELECT {_RAW_HASH} AS row_hash FROM unique_raw
  WHERE (reservation_status = 'Canceled') <> (is_canceled = 1))
SELECT (SELECT count(*) FROM unique_raw) AS rows_checked, (SELECT count(*) FROM m) AS mismatch_count,
  (SELECT string_agg(row_hash, ',' ORDER BY row_hash) FROM (SELECT row_hash FROM m ORDER BY 1 LIMIT 5)) AS sample""")
def _(lake):
    from staylytics.functions.keys import joined
    from staylytics.sources.bookings import HASH_COLUMNS

    rows = ops.dedupe_full_row(raw_bookings(lake)).select(
        ops.cancellation_mismatch().alias("bad"), F.sha2(joined(HASH_COLUMNS), 256).alias("row_hash")
    )
    sample = rows.where("bad").orderBy("row_hash").limit(5).agg(F.concat_ws(",", F.sort_array(F.collect_list("row_hash"))))
    return rows.agg(F.count("*").alias("rows_checked"), F.count_if("bad").alias("mismatch_count")).select(
        "*", sample.scalar().alias("sample")
    )


@query("P9_trim_categoricals", f"""
SELECT {STRIP.format(c='country')} AS country, {STRIP.format(c='hotel')} AS hotel, count(*) AS row_count,
  count(*) FILTER (WHERE country <> {STRIP.format(c='country')}) AS changed
FROM raw_bookings GROUP BY 1, 2""")
def _(lake):
    raw = raw_bookings(lake).withColumn("changed", F.col("country") != ops.strip(F.col("country")))
    return ops.normalize_categoricals(raw).groupBy("country", "hotel").agg(
        F.count("*").alias("row_count"), F.count_if("changed").alias("changed")
    )


@query("P10_arrival_date", """
SELECT arrival_date_year, arrival_date_month, arrival_date_day_of_month,
  try_strptime(arrival_date_year || '-' || arrival_date_month || '-' || arrival_date_day_of_month, '%Y-%B-%d')::DATE::VARCHAR
    AS arrival_date, count(*) AS row_count
FROM raw_bookings GROUP BY ALL""")
def _(lake):
    return ops.build_arrival_date(raw_bookings(lake)).groupBy(
        "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month", "arrival_date"
    ).agg(F.count("*").alias("row_count"))


@query("P11_coercing_types", """
SELECT TRY_CAST(agent AS BIGINT) AS agent, TRY_CAST(reservation_status_date AS DATE)::VARCHAR AS status_date,
  count(*) AS row_count, sum(TRY_CAST(company AS BIGINT))::BIGINT AS company_sum
FROM raw_bookings GROUP BY 1, 2""")
def _(lake):
    return ops.convert_types(raw_bookings(lake)).groupBy(
        "agent", F.col("reservation_status_date").alias("status_date")
    ).agg(F.count("*").alias("row_count"), F.sum("company").alias("company_sum"))


@query("P12_occupying_filter", """
SELECT hotel, reservation_status, stays_in_weekend_nights + stays_in_week_nights AS nights, count(*) AS row_count
FROM bookings WHERE coalesce(reservation_status NOT IN ('Canceled', 'No-Show'), true)
  AND stays_in_weekend_nights + stays_in_week_nights > 0 GROUP BY ALL""")
def _(lake):
    return marts.occupying(warehouse.fact_rows(bookings(lake))).groupBy(
        "hotel", "reservation_status", F.col("nights").cast("long").alias("nights")
    ).agg(F.count("*").alias("row_count"))


@query("P13_status_flags", """
SELECT reservation_status, reservation_status IN ('Canceled', 'Check-Out', 'No-Show') AS is_terminal,
  reservation_status = 'Check-Out' AS is_completed, count(*) AS row_count FROM bookings GROUP BY ALL""")
def _(lake):
    return warehouse.status_flags(bookings(lake)).groupBy(
        "reservation_status", "is_terminal", "is_completed"
    ).agg(F.count("*").alias("row_count"))


@query("P15_drop_required_nulls", """
SELECT market_segment, count(*) AS row_count FROM raw_bookings
WHERE country IS NOT NULL AND children IS NOT NULL GROUP BY 1""")
def _(lake):
    return raw_bookings(lake).na.drop(subset=["country", "children"]).groupBy("market_segment").agg(
        F.count("*").alias("row_count")
    )


@query("P16_clip", """
SELECT l_returnflag AS flag, count(*) AS row_count,
  sum(CASE WHEN c > 5000000 THEN 5000000 WHEN c < 1000000 THEN 1000000 ELSE c END)::BIGINT AS clipped_cents
FROM (SELECT l_returnflag, round(l_extendedprice * 100)::BIGINT AS c FROM lineitem) GROUP BY 1""")
def _(lake):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return lake.table("lineitem").select(
        F.col("l_returnflag").alias("flag"), marts.clip(cents, F.lit(1000000), F.lit(5000000)).alias("c")
    ).groupBy("flag").agg(F.count("*").alias("row_count"), F.sum("c").alias("clipped_cents"))


@query("P17_unresolvable_dates", """
SELECT count(*) AS rows_before, count(arrival_date) AS rows_after, count(*) - count(arrival_date) AS excluded
FROM cleaned""")
def _(lake):
    fact = warehouse.fact_rows(ops.clean(raw_bookings(lake), parts=booking_parts(lake)))
    bad = F.col("check_in_date_key").isNull() | F.col("check_out_date_key").isNull()
    return fact.agg(
        F.count("*").alias("rows_before"), F.count_if(~bad).alias("rows_after"), F.count_if(bad).alias("excluded")
    )


_changes = " + ".join(
    f"count(*) FILTER (WHERE {c} <> {STRIP.format(c=c)})" for c in C.CATEGORICAL_COLUMNS
)


@query("P18_step_audit", f"""
WITH r AS (SELECT count(*) AS n FROM raw_bookings), u AS (SELECT count(*) AS n FROM unique_raw),
s AS (SELECT count(*) FILTER (WHERE meal = 'Undefined') + count(*) FILTER (WHERE market_segment = 'Undefined')
   + count(*) FILTER (WHERE distribution_channel = 'Undefined') AS undefined,
   count(*) FILTER (WHERE children IS NULL) AS children, count(*) FILTER (WHERE country IS NULL) AS country,
   count(*) FILTER (WHERE country = 'CN') AS cn FROM unique_raw),
k AS (SELECT count(*) AS n, count(*) FILTER (WHERE adr_cents > (SELECT cap FROM rate_cap)) AS capped,
   count(*) FILTER (WHERE adults > 10) AS outliers,
   count(*) FILTER (WHERE (reservation_status = 'Canceled') <> (is_canceled = 1)) AS mismatch,
   {_changes} AS trimmed FROM unique_raw WHERE adr_cents >= 0),
d AS (SELECT count(*) FILTER (WHERE arrival_date IS NULL) AS unparseable FROM cleaned)
SELECT step_no, step, rows_before, rows_after, values_changed::BIGINT AS values_changed, extra FROM (
 SELECT 1 AS step_no, 'dedupe_full_row' AS step, r.n AS rows_before, u.n AS rows_after, r.n - u.n AS values_changed, NULL::BIGINT AS extra FROM r, u
 UNION ALL SELECT 2, 'replace_undefined_with_null', u.n, u.n, undefined, NULL FROM u, s
 UNION ALL SELECT 3, 'impute_missing_children', u.n, u.n, children, NULL FROM u, s
 UNION ALL SELECT 4, 'impute_missing_country', u.n, u.n, country, NULL FROM u, s
 UNION ALL SELECT 5, 'fix_country_code_cn', u.n, u.n, cn, NULL FROM u, s
 UNION ALL SELECT 6, 'clean_adr', u.n, k.n, capped, u.n - k.n FROM u, k
 UNION ALL SELECT 7, 'flag_adults_outliers', k.n, k.n, outliers, NULL FROM k
 UNION ALL SELECT 8, 'check_cancellation_consistency', k.n, k.n, 0, mismatch FROM k
 UNION ALL SELECT 9, 'normalize_categoricals', k.n, k.n, trimmed, NULL FROM k
 UNION ALL SELECT 10, 'build_arrival_date', k.n, k.n, k.n, unparseable FROM k, d
 UNION ALL SELECT 11, 'convert_dtypes', k.n, k.n, 3, NULL FROM k)""")
def _(lake):
    _, audit = jobs.audited_clean_job(lake, scratch_path(lake.spark, "clean"))
    return audit


@query("P20_anchored_snapshot", f"""
WITH g AS (SELECT guest_key, max(arrival_date) AS last_stay FROM guest_rows GROUP BY 1)
SELECT guest_key, date_diff('day', last_stay, (SELECT max(last_stay) + 1 FROM g))::INT AS recency_days FROM g""")
def _(lake):
    guests = warehouse.dim_guest(bookings(lake))
    anchor = guests.agg(F.date_add(F.max("last_stay_date"), 1)).scalar()
    return guests.select("guest_key", F.datediff(anchor, F.col("last_stay_date")).alias("recency_days"))
