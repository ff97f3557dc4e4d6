"""Checks for the scalar function families."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.registry import query
from staylytics.checks.views import GUEST_HASH
from staylytics.functions import dates, keys
from staylytics.operators import features
from staylytics.operators.reviews import keyword_tokens
from staylytics.sources.bookings import bookings
from staylytics.sources.reviews import reviews


@query("F1_date_parts", """
SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, monthname(o_orderdate) AS mn, day(o_orderdate)::INT AS d,
  (isodow(o_orderdate) - 1)::INT AS wd, weekofyear(o_orderdate)::INT AS wk, quarter(o_orderdate)::INT AS q, isodow(o_orderdate) >= 6 AS weekend FROM orders""")
def _(lake):
    d = F.col("o_orderdate")
    return lake.table("orders").select(
        "o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.date_format(d, "MMMM").alias("mn"), F.day(d).alias("d"),
        F.weekday(d).alias("wd"), F.weekofyear(d).alias("wk"), F.quarter(d).alias("q"), dates.is_weekend(d).alias("weekend"),
    )


@query("F2_date_arithmetic", """
SELECT o_orderkey, (o_orderdate::DATE + (o_orderkey % 6)::INT)::VARCHAR AS check_out,
  date_diff('day', o_orderdate::DATE, DATE '2000-01-01')::INT AS recency FROM orders""")
def _(lake):
    return lake.table("orders").select(
        "o_orderkey", F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 6).cast("int")).alias("check_out"),
        F.datediff(F.lit("2000-01-01").cast("date"), "o_orderdate").alias("recency"),
    )


@query("F3_integer_date_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS date_key FROM orders")
def _(lake):
    return lake.table("orders").select("o_orderkey", keys.date_key(F.col("o_orderdate")).alias("date_key"))


@query("F4_period_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS daily, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || '/' ||
  strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS weekly, strftime(o_orderdate, '%Y-%m') AS monthly FROM orders""")
def _(lake):
    d = F.col("o_orderdate")
    return lake.table("orders").select("o_orderkey", *[dates.period_label(d, g).alias(g) for g in ("daily", "weekly", "monthly")])


@query("F5_date_ranges", """
SELECT user_id, unnest(generate_series(last_day, last_day + INTERVAL 6 DAY, INTERVAL 1 DAY))::DATE::VARCHAR AS day
FROM (SELECT user_id, max(ts)::DATE + INTERVAL 1 DAY AS last_day FROM events GROUP BY 1)""")
def _(lake):
    last = lake.table("events").groupBy("user_id").agg(F.date_add(F.max("ts").cast("date"), 1).alias("d"))
    return last.select("user_id", F.explode(F.sequence("d", F.date_add("d", 6))).alias("day"))


@query("F6_strings", """
SELECT doc_id, lower(text) = text AS is_lower, contains(lower(text), 'the') AS has_the, length(regexp_replace(text, '[ \\t]+', ' ', 'g')) AS squeezed,
  len(regexp_extract_all(lower(text), '[a-z]+')) AS n_words, substr(text, 1, 20) AS head, right(text, 20) AS tail,
  upper(trim(lang)) || ':' || source AS label, len(string_split(text, '. ')) AS n_sentences FROM documents""")
def _(lake):
    t = F.col("text")
    return lake.table("documents").select(
        "doc_id", (F.lower(t) == t).alias("is_lower"), F.contains(F.lower(t), F.lit("the")).alias("has_the"),
        F.length(F.regexp_replace(t, r"[ \t]+", " ")).alias("squeezed"),
        F.size(F.regexp_extract_all(F.lower(t), F.lit("[a-z]+"), F.lit(0))).alias("n_words"),
        F.substring(t, 1, 20).alias("head"), F.right(t, F.lit(20)).alias("tail"),
        F.concat_ws(":", F.upper(F.trim("lang")), "source").alias("label"),
        F.size(F.split(t, r"\. ")).alias("n_sentences"),
    )


@query("F7_hashes", f"""
SELECT {GUEST_HASH} AS guest_key, count(*) AS row_count, min(sha256('minilm:' || country)) AS cache_key FROM bookings GROUP BY 1""")
def _(lake):
    return bookings(lake).groupBy(keys.guest_key().alias("guest_key")).agg(
        F.count("*").alias("row_count"), F.min(F.sha2(F.concat(F.lit("minilm:"), "country"), 256)).alias("cache_key")
    )


@query("F8_safe_math", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(ln(1 + l_extendedprice) / 10, 6) AS log_part, round(sqrt(abs(l_discount - l_tax)), 6) AS root,
  ceil(l_quantity * 0.03::DOUBLE)::BIGINT AS up, coalesce(l_tax / nullif(l_discount, 0), 1.0) AS ratio FROM lineitem""")
def _(lake):
    return lake.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.log1p("l_extendedprice") / 10, 6).alias("log_part"),
        F.round(F.sqrt(F.abs(F.col("l_discount") - F.col("l_tax"))), 6).alias("root"), F.ceil(F.col("l_quantity") * 0.03).alias("up"),
        features.safe_ratio(F.col("l_tax"), F.col("l_discount"), 1.0).alias("ratio"),
    )


@query("F9_bucketing", """
SELECT CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) <= 5 THEN 'spring' WHEN month(ts) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
  CASE WHEN value / 100 < 0.3 THEN 'Low' WHEN value / 100 < 0.6 THEN 'Medium' ELSE 'High' END AS risk, count(*) AS row_count FROM events GROUP BY 1, 2""")
def _(lake):
    from staylytics.plans.scoring import risk_level

    return lake.table("events").groupBy(
        dates.season(F.col("ts")).alias("season"), risk_level(F.col("value") / 100).alias("risk")
    ).agg(F.count("*").alias("row_count"))


@query("F10_word_arrays", f"""
SELECT doc_id, len(list_distinct(w)) AS n_distinct, len(list_filter(list_distinct(w), lambda x: x NOT IN ({', '.join(repr(w) for w in C.COMPLAINT_STOPWORDS)}))) AS n_kept
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents)""")
def _(lake):
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))
    stop = F.array(*[F.lit(w) for w in C.COMPLAINT_STOPWORDS])
    return lake.table("documents").select("doc_id", words.alias("w")).select(
        "doc_id", F.size("w").alias("n_distinct"), F.size(F.array_except("w", stop)).alias("n_kept")
    )


@query("F11_map_merge", """
SELECT conv_id, turn, role || '/' || turn AS merged_label, 2 AS n_keys FROM conversations""")
def _(lake):
    base = F.create_map(F.lit("role"), F.col("role"))
    merged = F.map_concat(base, F.create_map(F.lit("chunk_index"), F.col("turn").cast("string")))
    return lake.table("conversations").select("conv_id", "turn", merged.alias("m")).select(
        "conv_id", "turn", F.concat_ws("/", F.element_at("m", "role"), F.element_at("m", "chunk_index")).alias("merged_label"),
        F.size(F.map_keys("m")).alias("n_keys"),
    )


@query("F12_json", """
SELECT event_id, (props->>'$.k')::INT AS k, '{"event_type":"' || event_type || '","k":' || (props->>'$.k') || '}' AS encoded FROM events""")
def _(lake):
    k = F.from_json("props", "k int")["k"]
    return lake.table("events").select("event_id", "event_type", k.alias("k")).select(
        "event_id", "k", F.to_json(F.struct("event_type", "k")).alias("encoded")
    )


@query("F13_nights_and_amount", """
SELECT nights, count(*) AS row_count, sum(total_amount_cents)::BIGINT AS amount_cents FROM guest_rows GROUP BY 1""")
def _(lake):
    return bookings(lake).groupBy(keys.nights().alias("nights")).agg(
        F.count("*").alias("row_count"), F.sum(keys.nights() * F.col("adr_cents")).alias("amount_cents")
    )


@query("F14_numeric_json_fields", """
SELECT event_type, count(TRY_CAST(props->>'$.k' AS DOUBLE)) AS numeric_k, count(TRY_CAST(event_type AS DOUBLE)) AS numeric_type FROM events GROUP BY 1""")
def _(lake):
    from staylytics.operators.monitoring import json_number

    return lake.table("events").groupBy("event_type").agg(
        F.count(json_number(F.get_json_object("props", "$.k"))).alias("numeric_k"),
        F.count(json_number(F.col("event_type"))).alias("numeric_type"),
    )


@query("F15_interval_confidence", """
SELECT branch_id, date::VARCHAR AS date, round(greatest(0, 1 - ((occupancy_pct + sd) - (occupancy_pct - sd)) / 100), 6) AS confidence FROM (
  SELECT branch_id, date, occupancy_pct, coalesce(stddev_pop(occupancy_pct) OVER (PARTITION BY branch_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0) AS sd FROM mart_revenue)""")
def _(lake):
    from staylytics.operators.marts import mart_revenue_daily
    from staylytics.operators.windows import ordered
    from staylytics.plans.scoring import confidence

    w = ordered(["branch_id"], "date").rowsBetween(-30, -1)
    banded = mart_revenue_daily(lake).withColumn("sd", F.coalesce(F.stddev_pop("occupancy_pct").over(w), F.lit(0.0)))
    low, high = F.col("occupancy_pct") - F.col("sd"), F.col("occupancy_pct") + F.col("sd")
    return banded.select("branch_id", "date", F.round(confidence(low, high), 6).alias("confidence"))
