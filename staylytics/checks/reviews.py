"""Checks for review mining."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics import constants as C
from staylytics.checks.registry import query
from staylytics.checks.views import view
from staylytics.operators import reviews as ops
from staylytics.sources.reviews import PHRASES, reviews
from staylytics.session import scratch_path


def _lit(text):
    return "'" + text.replace("'", "''") + "'"


def _list(words):
    return "[" + ", ".join(_lit(w) for w in words) + "]"


def _count(words):
    return " + ".join(f"contains(low, {_lit(w)})::INT" for w in words)


def _any(words):
    return "(" + " OR ".join(f"contains(low, {_lit(w)})" for w in words) + ")"


view("reviews", f"""
SELECT doc_id, {_list(PHRASES)}[(doc_id % 40 + 1)::INT] || ' ' || {_list(PHRASES)}[((doc_id * 7 + 3) % 40 + 1)::INT] || ' ' || text AS review,
  doc_id * 7 % 5 + 1 AS rating, DATE '2024-01-01' + (doc_id % 365)::INT AS date, source AS hotel_id, lang AS language FROM documents""")
view("annotated", f"""
SELECT *, CASE WHEN sentiment = 'negative' THEN CASE WHEN {_any(C.ANGRY_WORDS)} THEN 'angry' ELSE 'frustrated' END
    WHEN sentiment = 'positive' THEN CASE WHEN {_any(C.EXCITED_WORDS)} THEN 'excited' ELSE 'happy' END ELSE 'satisfied' END AS emotion
FROM (SELECT *, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS sentiment
  FROM (SELECT *, {_count(C.POSITIVE_WORDS)} AS pos, {_count(C.NEGATIVE_WORDS)} AS neg FROM (SELECT *, lower(review) AS low FROM reviews)))""")
_CASES = ", ".join(
    f"CASE WHEN list_has_any(words, {_list(words)}) THEN {_lit(name)} END" for name, words in C.COMPLAINT_WORDS.items())
view("complaints", f"""
SELECT doc_id, list_filter([{_CASES}], lambda x: x IS NOT NULL) AS complaints
FROM (SELECT doc_id, regexp_extract_all(lower(review), '[a-z]+') AS words FROM reviews)""")
view("complaint_totals", "SELECT category, count(*) AS n FROM (SELECT unnest(complaints) AS category FROM complaints) GROUP BY 1")
_CSAT = "round_even((avg(rating) - 1) / 4 * 100, 2)"
view("csat_hotel", f"SELECT hotel_id, {_CSAT} AS csat FROM reviews GROUP BY 1")
_PERIODS = {
    "daily": "strftime(date, '%Y-%m-%d')", "monthly": "strftime(date, '%Y-%m')",
    "weekly": "strftime(date_trunc('week', date), '%Y-%m-%d') || '/' || strftime(date_trunc('week', date) + INTERVAL 6 DAY, '%Y-%m-%d')",
}
for _g, _p in _PERIODS.items():
    view(f"csat_{_g}", f"SELECT hotel_id, {_p} AS period, {_CSAT} AS csat FROM reviews GROUP BY 1, 2")
view("csat_trends", """
SELECT hotel_id, CASE WHEN n < 6 THEN 'stable' WHEN recent - prior > 2.0 THEN 'improving' WHEN recent - prior < -2.0 THEN 'declining' ELSE 'stable' END AS trend
FROM (SELECT hotel_id, count(*) AS n, avg(csat) FILTER (WHERE r <= 3) AS recent, avg(csat) FILTER (WHERE r BETWEEN 4 AND 6) AS prior
  FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY period DESC) AS r FROM csat_weekly) WHERE r <= 6 GROUP BY 1)""")


@query("X1_lexicon_sentiment", "SELECT doc_id, pos AS pos_hits, neg AS neg_hits, sentiment FROM annotated")
def _(lake):
    return ops.with_sentiment(reviews(lake)).select("doc_id", "pos_hits", "neg_hits", "sentiment")


@query("X2_emotion", "SELECT doc_id, emotion FROM annotated")
def _(lake):
    return ops.with_emotion(ops.with_sentiment(reviews(lake))).select("doc_id", "emotion")


@query("X3_complaint_categories", "SELECT doc_id, array_to_string(complaints, ',') AS complaints FROM complaints")
def _(lake):
    return ops.with_complaints(reviews(lake)).select("doc_id", F.concat_ws(",", "complaints").alias("complaints"))


@query("D2_text_callables_native", """
SELECT sentiment, emotion, array_to_string(c.complaints, ',') AS complaints, count(*) AS row_count
FROM annotated a JOIN complaints c USING (doc_id) GROUP BY ALL""")
def _(lake):
    return ops.annotate(reviews(lake)).groupBy(
        "sentiment", "emotion", F.concat_ws(",", "complaints").alias("complaints")
    ).agg(F.count("*").alias("row_count"))


@query("A15_complaint_counts", "SELECT category, n AS count FROM complaint_totals ORDER BY n DESC, category")
def _(lake):
    return ops.complaint_counts(ops.with_complaints(reviews(lake)))


@query("A14_csat", "SELECT 'hotel' AS grain, hotel_id, '' AS period, csat FROM csat_hotel" + "".join(
    f" UNION ALL SELECT '{g}', hotel_id, period, csat FROM csat_{g}" for g in _PERIODS))
def _(lake):
    rows = reviews(lake)
    out = ops.csat_by_hotel(rows).select(F.lit("hotel").alias("grain"), "hotel_id", F.lit("").alias("period"), "csat")
    for g in _PERIODS:
        out = out.unionByName(ops.csat_by_period(rows, g).select(F.lit(g).alias("grain"), "hotel_id", "period", "csat"))
    return out


@query("D3_grouped_aggregate_callable", "SELECT hotel_id, csat FROM csat_hotel")
def _(lake):
    return ops.csat_by_function(reviews(lake))


@query("D3_window_aggregate_callable", """
SELECT hotel_id, period, round_even((sum(total) OVER w / sum(n) OVER w - 1) / 4 * 100, 2) AS csat
FROM (SELECT hotel_id, strftime(date_trunc('week', date), '%Y-%m-%d') || '/' || strftime(date_trunc('week', date) + INTERVAL 6 DAY, '%Y-%m-%d') AS period,
  sum(rating) AS total, count(*) AS n FROM reviews GROUP BY 1, 2)
WINDOW w AS (PARTITION BY hotel_id ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(lake):
    return ops.csat_rolling(reviews(lake))


@query("W10_csat_trend", "SELECT * FROM csat_trends")
def _(lake):
    return ops.csat_trend(ops.csat_by_period(reviews(lake), "weekly"))


_PCT = "round_even({s} * 100.0::DOUBLE / n, 0)::INT"


@query("A16_sentiment_summary", f"""
SELECT 'Analyzed ' || n || ' reviews: ' || p || ' positive (' || {_PCT.format(s='p')} || '%), ' || u || ' neutral (' || {_PCT.format(s='u')}
  || '%), ' || g || ' negative (' || {_PCT.format(s='g')} || '%).' AS summary
FROM (SELECT count(*) FILTER (WHERE language = 'en') AS n, count(*) FILTER (WHERE sentiment = 'positive') AS p,
  count(*) FILTER (WHERE sentiment = 'neutral') AS u, count(*) FILTER (WHERE sentiment = 'negative') AS g FROM annotated)""")
def _(lake):
    return ops.summary(ops.with_sentiment(reviews(lake)))


view("tokens_en", f"""
SELECT doc_id, list_filter(regexp_extract_all(lower(review), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({', '.join(_lit(w) for w in C.KEYWORD_STOPWORDS)})) AS t
FROM reviews WHERE language = 'en'""")
view("terms_en", """
SELECT doc_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM tokens_en""")
view("tf_en", "SELECT doc_id, term, count(*) AS tf FROM terms_en GROUP BY 1, 2")
view("vocab_en", "SELECT term, sum(tf) AS total, count(*) AS df FROM tf_en GROUP BY 1")
view("weights_en", """
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
  SELECT doc_id, term, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM tokens_en)) / (1.0::DOUBLE + df)) + 1) AS w FROM tf_en JOIN vocab_en USING (term))""")


@query("X4_tfidf_weights", "SELECT doc_id, term, round(weight, 6) AS weight FROM weights_en")
def _(lake):
    docs = ops.english(reviews(lake))
    return ops.term_weights(docs, "doc_id", "review").select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("K4_top_keywords", "SELECT term, round(sum(weight), 6) AS score FROM weights_en GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def _(lake):
    return ops.top_keywords(ops.english(reviews(lake)), "doc_id", "review", 15)


# Every topic has six different words, all of which occur in the English reviews, and no two topics have the same six.
@query("X5_lda_topics", "SELECT unnest(range(5))::INT AS topic_id, 6 AS words, 6 AS known, 5 AS different")
def _(lake):
    return topic_facts(ops.topics(ops.english(reviews(lake)), "review"), lake)


def topic_facts(found, lake):
    known = ops.topic_tokens(ops.english(reviews(lake)), "review").select(F.explode("tokens").alias("word")).distinct()
    words = found.select("topic_id", F.explode("keywords").alias("word")).distinct()
    different = found.agg(F.count_distinct(F.array_sort("keywords")).cast("int")).scalar()
    return words.join(known.withColumn("is_known", F.lit(True)), "word", "left").groupBy("topic_id").agg(
        F.count("*").cast("int").alias("words"), F.count_if("is_known").cast("int").alias("known")
    ).withColumn("different", different)


@query("X8_english_subset", "SELECT hotel_id, count(*) AS row_count, sum(length(review))::BIGINT AS chars FROM reviews WHERE language = 'en' GROUP BY 1")
def _(lake):
    return ops.english(reviews(lake)).groupBy("hotel_id").agg(
        F.count("*").alias("row_count"), F.sum(F.length("review")).alias("chars")
    )


@query("X6_review_report", """
SELECT 'complaint' AS part, category AS name, n::DOUBLE AS value, '' AS label FROM complaint_totals
UNION ALL SELECT 'csat', hotel_id, csat, '' FROM csat_hotel UNION ALL SELECT 'trend', hotel_id, NULL, trend FROM csat_trends
UNION ALL (SELECT 'keyword', term, round(sum(weight), 6) AS s, '' FROM weights_en GROUP BY 2 ORDER BY s DESC, term LIMIT 15)
UNION ALL SELECT 'topic', unnest(range(5))::VARCHAR, 6.0, ''""")
def _(lake):
    from staylytics.plans.review_report import review_report

    return review_report(reviews(lake)).table()


@query("X7_persisted_review_results", "SELECT hotel_id, period, csat, trend FROM csat_weekly JOIN csat_trends USING (hotel_id)")
def _(lake):
    from staylytics.plans import review_report as report

    path = scratch_path(lake.spark, "reviews")
    report.analyze(reviews(lake), path)
    return report.get_trends(lake.spark, path, "weekly")


@query("X7_persisted_annotations", """
SELECT doc_id, sentiment, emotion, array_to_string(c.complaints, ',') AS complaints FROM annotated JOIN complaints c USING (doc_id)""")
def _(lake):
    from staylytics.plans import review_report as report

    path = scratch_path(lake.spark, "reviews")
    report.write_annotated(reviews(lake), path)
    return report.get_annotated(lake.spark, path).select("doc_id", "sentiment", "emotion", F.concat_ws(",", "complaints").alias("complaints"))
