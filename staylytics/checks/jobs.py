"""Checks for the composed batch jobs."""

from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks import features
from staylytics.checks import insights as ins
from staylytics.checks import monitoring as mon
from staylytics.checks import retrieval as ret
from staylytics.checks.models import SIZES
from staylytics.checks.registry import ORACLES, query
from staylytics.checks.reviews import topic_facts
from staylytics.operators import insights, inverted
from staylytics.operators import retrieval as ops
from staylytics.operators.chunking import chunk_rows, chunk_text
from staylytics.plans import index, jobs, review_report
from staylytics.session import scratch_path
from staylytics.sources.reviews import reviews

_CLEAN_COLUMNS = [
    "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month", "adults",
    "children", "meal", "country", "market_segment", "distribution_channel", "agent", "company", "adr_cents",
    "reservation_status", "is_adults_outlier",
]


@query("Z1_clean_job", f"""
SELECT {', '.join(_CLEAN_COLUMNS)}, round(adr, 6) AS adr, arrival_date::VARCHAR AS arrival_date, reservation_status_date::VARCHAR AS reservation_status_date FROM cleaned""")
def _(lake):
    return jobs.clean_job(lake, scratch_path(lake.spark, "clean")).select(
        *_CLEAN_COLUMNS, F.round("adr", 6).alias("adr"), "arrival_date", "reservation_status_date"
    )


@query("Z2_warehouse_job", """
SELECT 'table' AS kind, 'dim_date' AS name, count(*) AS rows_or_orphans, true AS ok FROM dim_date
UNION ALL SELECT 'table', 'dim_hotel', count(DISTINCT hotel), true FROM bookings UNION ALL SELECT 'table', 'dim_room_type', count(DISTINCT room_key), true FROM guest_rows
UNION ALL SELECT 'table', 'dim_guest', count(*), true FROM dim_guest UNION ALL SELECT 'table', 'fact_booking', count(*), true FROM guest_rows
UNION ALL SELECT 'foreign_key', k, 0, true FROM (VALUES ('room_key'), ('branch_key'), ('guest_key'), ('check_in_date_key'), ('check_out_date_key')) v(k)""")
def _(lake):
    return jobs.warehouse_job(lake, scratch_path(lake.spark, "warehouse"))


_REPORTED = features._CORR_COLUMNS


@query("Z3_feature_job", f"""
SELECT 'occupancy' AS domain, 'rows' AS name, count(*)::DOUBLE AS value FROM daily_base
UNION ALL SELECT 'pricing', 'rows', (count(*) * (3 + (SELECT (count(*) > 0)::INT FROM guest_rows WHERE room_key = 0)))::DOUBLE FROM daily_base
UNION ALL SELECT 'restaurant', 'rows', count(*)::DOUBLE FROM branch_days UNION ALL SELECT 'staff', 'rows', count(*)::DOUBLE FROM mart_staff
UNION ALL SELECT 'churn', 'rows', count(*)::DOUBLE FROM dim_guest
UNION ALL {' UNION ALL '.join(f"SELECT 'occupancy', 'mean of {c}', round(avg({c}), 3) FROM occ_features" for c in _REPORTED)}
UNION ALL SELECT 'occupancy', feature_a || ' with ' || feature_b, abs_corr FROM ({ORACLES['A12_top_correlations']})""")
def _(lake):
    return jobs.feature_job(lake, scratch_path(lake.spark, "features"), _REPORTED)


@query("Z4_train_and_leaderboard", """
SELECT task, true AS own_model, true AS in_range FROM (VALUES ('occupancy'), ('pricing'), ('restaurant'), ('staffing'), ('churn')) v(task)""")
def _(lake):
    path = scratch_path(lake.spark, "train")
    best = jobs.leaderboard(jobs.train_domains(lake, ["occupancy", "pricing", "restaurant", "staffing", "churn"], SIZES, path))
    churn = F.col("task") == "churn"
    in_range = (F.col("value") >= 0) & F.when(churn, F.col("value") <= 1).otherwise(True)
    return best.select("task", F.col("best_model").startswith(F.col("task")).alias("own_model"), in_range.alias("in_range"))


@query("Z5_review_job", "SELECT hotel_id, period, csat, trend FROM csat_monthly JOIN csat_trends USING (hotel_id)")
def _(lake):
    path = scratch_path(lake.spark, "reviews")
    review_report.analyze(reviews(lake), path)
    return review_report.get_trends(lake.spark, path, "monthly")


@query("Z5_review_topics", "SELECT unnest(range(5))::INT AS topic_id, 6 AS words, 6 AS known, 5 AS different")
def _(lake):
    path = scratch_path(lake.spark, "reviews")
    review_report.analyze(reviews(lake), path)
    return topic_facts(review_report.get_topics(lake.spark, path), lake)


@query("Z6_index_and_answer", "SELECT query_id, true AS asks, true AS shaped, true AS answered FROM asked")
def _(lake):
    """Chunk the stored documents, retrieve per question over the chunks, and assemble the prompts."""
    docs = ret.store(lake).withColumn("metadata", F.create_map(F.lit("source"), F.col("doc_type"), F.lit("branch_id"), F.col("branch_id")))
    path, keywords = scratch_path(lake.spark, "chunks"), scratch_path(lake.spark, "keywords")
    pieces = chunk_rows(chunk_text(docs, "text"), "doc_id").withColumn("chunk_id", F.xxhash64("doc_id", "chunk_index"))
    pieces.select("chunk_id", "doc_id", "text", F.element_at("metadata", "source").alias("doc_type"), F.element_at("metadata", "branch_id").alias("branch_id")).write.parquet(path)
    chunks = lake.spark.read.parquet(path)
    dates = docs.select(F.col("doc_id").alias("_doc"), "date")
    store = chunks.join(dates, F.col("doc_id") == F.col("_doc")).select(F.col("chunk_id").alias("doc_id"), "text", "doc_type", "branch_id", "date")
    vectors = chunks.select("chunk_id", "doc_id").join(ret.vectors(lake), "doc_id").select(F.col("chunk_id").alias("doc_id"), "embedding")
    inverted.build(store.select("doc_id", "text"), keywords)
    context = ops.compress_context(ops.hybrid(store, vectors, inverted.load(lake.spark, keywords), ret.asked(lake)))
    texts = ret.asked(lake).join(context, "query_id", "left").select(
        "query_id", "query_text", ops.prompt(F.col("query_text"), F.col("context"), F.lit(None).cast("string")).alias("prompt"),
        ops.fallback_answer(F.col("query_text"), F.col("context")).alias("answer"),
    )
    return texts.select(
        "query_id", F.endswith("prompt", F.concat(F.lit(C.QUESTION_HEAD), F.col("query_text"))).alias("asks"),
        F.startswith("prompt", F.lit(C.CONTEXT_HEAD)).alias("shaped"),
        F.startswith("answer", F.concat(F.lit(C.FALLBACK_HEAD), F.col("query_text"))).alias("answered"),
    )


@query("Z7_insight_job", """
SELECT category, title, severity, priority_score, '[' || upper(severity) || '] ' || title AS headline FROM scored_findings ORDER BY priority_score DESC, category, title""")
def _(lake):
    ranked = insights.rank(insights.recommend(ins.all_findings(lake)))
    return ranked.select("category", "title", "severity", "priority_score", F.regexp_extract("recommendation", r"^(\[[A-Z]+\] .*?)(?: \(delta: |\. Review )", 1).alias("headline"))


@query("Z8_nightly_decision", f"""
WITH r AS ({mon._RETRAIN})
SELECT r.model_name, drift_breached, accuracy_breached, CASE WHEN s.staging_version IS NOT NULL THEN coalesce(CASE WHEN s.lower_is_better
  THEN s.staging_metric < s.production_metric ELSE s.staging_metric > s.production_metric END, true) END AS beats_production
FROM r JOIN stage_rows s USING (model_name) WHERE retrain""")
def _(lake):
    return jobs.retrain_decision(lake)
