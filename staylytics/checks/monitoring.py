"""Checks for metrics, drift, fingerprints and model records."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics.checks.marts import daily
from staylytics.checks.registry import query
from staylytics.checks.views import hash63, pipe, view
from staylytics.operators import monitoring as ops
from staylytics.operators import reviews as rv
from staylytics.operators import windows
from staylytics.sources import models as src
from staylytics.sources.reviews import reviews

_HEAD = """'{"domain":"' || event_type || '","value":' || value::VARCHAR || ',"k":' || (props->>'$.k') || ',"cached":false'"""
view("log_lines", f"""
SELECT CASE WHEN event_id % 97 = 0 THEN '{{"domain":"' || event_type WHEN event_id % 101 = 0 THEN ''
  WHEN event_id % 103 = 0 THEN {_HEAD} || '}}'
  ELSE {_HEAD} || ',"_logged_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}}' END AS line FROM events""")
view("log_rows", """
SELECT line->>'$.domain' AS domain, (line->>'$._logged_at')::TIMESTAMP AS logged_at, (line->>'$.value')::DOUBLE AS value,
  (line->>'$.k')::DOUBLE AS k, (line->>'$.cached') AS cached
FROM (SELECT CASE WHEN json_valid(line) THEN line END AS line FROM log_lines) WHERE line->>'$._logged_at' IS NOT NULL""")
view("log_windows", """
SELECT l.*, CASE WHEN logged_at > now - INTERVAL 7 DAY THEN 'recent' WHEN logged_at > now - INTERVAL 14 DAY THEN 'prior' END AS win
FROM log_rows l JOIN (SELECT domain, max(logged_at) AS now FROM log_rows GROUP BY 1) USING (domain)""")
view("log_numbers", """
SELECT domain, win, 'value' AS field, value AS number FROM log_windows WHERE win IS NOT NULL
UNION ALL SELECT domain, win, 'k', k FROM log_windows WHERE win IS NOT NULL""")


@query("S8_tolerant_log_scan", """
SELECT domain, strftime(logged_at, '%Y-%m-%d %H:%M:%S.%f') AS logged_at, value, k, cached FROM log_rows""")
def _(lake):
    log = ops.parse_log(src.prediction_log(lake))
    field = lambda n: F.element_at("fields", n)
    return log.select("domain", "logged_at", ops.json_number(field("value")).alias("value"),
                      ops.json_number(field("k")).alias("k"), field("cached").alias("cached"))


@query("U4_fields_in_both_windows", """
SELECT domain, field FROM log_numbers WHERE win = 'recent' INTERSECT SELECT domain, field FROM log_numbers WHERE win = 'prior'""")
def _(lake):
    return ops.shared_fields(ops.windowed_log(ops.parse_log(src.prediction_log(lake))))


_DRIFT = """
WITH s AS (SELECT domain, field, avg(number) FILTER (WHERE win = 'recent') AS rm, stddev_pop(number) FILTER (WHERE win = 'recent') AS rs,
  avg(number) FILTER (WHERE win = 'prior') AS pm, stddev_pop(number) FILTER (WHERE win = 'prior') AS ps,
  count(*) FILTER (WHERE win = 'recent') AS nr, count(*) FILTER (WHERE win = 'prior') AS np FROM log_numbers GROUP BY 1, 2)
SELECT domain, field, round(rm, 6) AS recent_mean, round(rs, 6) AS recent_std, round(pm, 6) AS prior_mean, round(ps, 6) AS prior_std,
  nr AS recent_count, np AS prior_count, abs(rm - pm) <= greatest(ps * 0.5, abs(pm) * 0.2, 1e-9) AS stable FROM s WHERE nr >= 2 AND np >= 2"""


def drift_rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("recent_mean", "recent_std", "prior_mean", "prior_std")})


@query("A19_prediction_drift", _DRIFT)
def _(lake):
    return drift_rounded(ops.prediction_drift(ops.parse_log(src.prediction_log(lake))))


# Reference and current parts of the event table, one row per (column, value).
view("drift_values", """
SELECT 'value' AS column_name, event_type AS domain, ts >= TIMESTAMP '2024-01-16' AS cur, value AS v FROM events
UNION ALL SELECT 'k', event_type, ts >= TIMESTAMP '2024-01-16', (props->>'$.k')::DOUBLE FROM events
UNION ALL SELECT 'hour', event_type, ts >= TIMESTAMP '2024-01-16', hour(ts)::DOUBLE FROM events
UNION ALL SELECT 'day', event_type, ts >= TIMESTAMP '2024-01-16', day(ts)::DOUBLE FROM events""")


def _ks(keys, where="true"):
    k = ", ".join(keys)
    return f"""SELECT {k}, nr AS n_ref, nc AS n_cur, max(abs(rc / nr - cc / nc)) AS ks,
      max(abs(rc / nr - cc / nc)) > 1.3581 * sqrt((nr + nc) / (nr * nc)) AS drifted FROM (
      SELECT {k}, sum(r) OVER (PARTITION BY {k} ORDER BY v) AS rc, sum(c) OVER (PARTITION BY {k} ORDER BY v) AS cc,
        sum(r) OVER (PARTITION BY {k})::BIGINT AS nr, sum(c) OVER (PARTITION BY {k})::BIGINT AS nc
      FROM (SELECT {k}, v, count(*) FILTER (WHERE NOT cur) AS r, count(*) FILTER (WHERE cur) AS c FROM drift_values WHERE {where} GROUP BY {k}, v))
    GROUP BY {k}, nr, nc"""


def drift_values(lake):
    ts = F.col("ts")
    cols = {"value": F.col("value"), "k": F.get_json_object("props", "$.k").cast("double"),
            "hour": F.hour(ts).cast("double"), "day": F.day(ts).cast("double")}
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), c.alias("v")) for n, c in cols.items()])
    return lake.table("events").select(
        F.col("event_type").alias("domain"), (ts >= F.lit("2024-01-16").cast("timestamp_ntz")).alias("is_current"), F.inline(pairs)
    )


@query("A20_column_drift", f"SELECT column_name, n_ref, n_cur, round(ks, 6) AS ks, drifted FROM ({_ks(['column_name'])})")
def _(lake):
    return ops.ks_drift(drift_values(lake), ["column_name"]).withColumn("ks", F.round("ks", 6))


view("drift_texts", """
SELECT 'event_type' AS column_name, ts >= TIMESTAMP '2024-01-16' AS cur, event_type AS v FROM events
UNION ALL SELECT 'props', ts >= TIMESTAMP '2024-01-16', props FROM events
UNION ALL SELECT 'weekday', ts >= TIMESTAMP '2024-01-16', strftime(ts, '%A') FROM events
UNION ALL SELECT 'week_half', ts >= TIMESTAMP '2024-01-16', CASE WHEN day(ts) < 10 THEN 'early' WHEN day(ts) < 20 THEN 'mid' ELSE 'late' END FROM events""")
_TEXT_DRIFT = """
SELECT column_name, n_ref, n_cur, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS distance
FROM (SELECT column_name, n_ref, n_cur, sum(r) / n_ref AS p, sum(c) / n_cur AS q FROM (
  SELECT *, sum(r) OVER (PARTITION BY column_name) AS n_ref, sum(c) OVER (PARTITION BY column_name) AS n_cur FROM (
    SELECT column_name, v, (count(*) FILTER (WHERE NOT cur))::BIGINT AS r, (count(*) FILTER (WHERE cur))::BIGINT AS c FROM drift_texts WHERE v IS NOT NULL GROUP BY 1, 2))
  GROUP BY column_name, n_ref, n_cur, CASE WHEN r + c >= (n_ref + n_cur) * 0.005::DOUBLE THEN v END) GROUP BY 1, 2, 3"""


def events_with_texts(lake):
    ts = F.col("ts")
    part = F.when(F.day(ts) < 10, "early").when(F.day(ts) < 20, "mid").otherwise("late")
    return lake.table("events").withColumns({
        "weekday": F.date_format(ts, "EEEE"), "week_half": part, "k": F.get_json_object("props", "$.k").cast("double"),
        "hour": F.hour(ts).cast("double"), "day": F.day(ts).cast("double"),
    })


_IS_CURRENT = "ts >= timestamp_ntz'2024-01-16'"


@query("A20_text_column_drift", f"SELECT column_name, n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur, round(distance, 6) AS distance, distance > 0.1 AS drifted FROM ({_TEXT_DRIFT})")
def _(lake):
    found = ops.column_drift(events_with_texts(lake), F.expr(_IS_CURRENT), ["event_type", "props", "weekday", "week_half"])
    return found.drop("test").withColumn("distance", F.round("distance", 6))


@query("A20_drift_share", f"""
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted, count(*) FILTER (WHERE drifted) / count(*) AS drift_score
FROM (SELECT drifted FROM ({_ks(['column_name'])}) UNION ALL SELECT distance > 0.1 FROM ({_TEXT_DRIFT}))""")
def _(lake):
    columns = ["value", "k", "hour", "day", "event_type", "props", "weekday", "week_half"]
    return ops.drift_share(ops.column_drift(events_with_texts(lake), F.expr(_IS_CURRENT), columns))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]


def _print(table, columns, keys="", where="true"):
    k = f"{keys}, " if keys else ""
    g = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {k}count(*) AS row_count, {len(columns)} AS feature_count, sha256(concat_ws(':', count(*)::VARCHAR, sum(h)::VARCHAR, bit_xor(h)::VARCHAR)) AS content_hash
      FROM (SELECT {k}{hash63(pipe(columns))} AS h FROM {table} WHERE {where}) {g}"""


@query("A21_dataset_fingerprint", f"""
WITH o AS ({_print('orders', _ORDER_COLUMNS)}), p AS ({_print('orders', _ORDER_COLUMNS, where="o_orderdate < TIMESTAMP '1998-01-01'")}), c AS ({_print('customer', _CUSTOMER_COLUMNS)})
SELECT 'orders' AS source, o.*, o.content_hash <> p.content_hash AS changed FROM o, p UNION ALL SELECT 'customer', c.*, true FROM c""")
def _(lake):
    orders = lake.table("orders")
    older = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    previous = ops.fingerprint(older, _ORDER_COLUMNS).select("content_hash").scalar()
    now = ops.fingerprint(orders, _ORDER_COLUMNS).withColumn("changed", F.col("content_hash") != previous)
    # A source without an earlier version counts as changed.
    first = ops.fingerprint(lake.table("customer"), _CUSTOMER_COLUMNS).withColumn("changed", F.lit(True))
    return now.select(F.lit("orders").alias("source"), "*").unionByName(first.select(F.lit("customer").alias("source"), "*"))


@query("A22_counts_by_namespace", "SELECT source AS namespace, count(*) AS entries FROM documents GROUP BY 1")
def _(lake):
    return lake.table("documents").groupBy(F.col("source").alias("namespace")).agg(F.count("*").alias("entries"))


@query("A23_latency_panel", """
SELECT event_type AS domain, 'v' || (user_id % 3) AS model_version, count(*) AS predictions,
  count(*) FILTER (WHERE (props->>'$.k')::INT < 5) AS errors, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1, 2""")
def _(lake):
    served = lake.table("events").select(
        F.col("event_type").alias("domain"), F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        (F.get_json_object("props", "$.k").cast("int") < 5).alias("is_error"), F.col("value").alias("latency"),
    )
    return ops.latency_panel(served).withColumn("p95", F.round("p95", 6))


_PROFILED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("A25_table_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, (count(*) - count({c})) * 100 / count(*) AS missing_pct, count(DISTINCT {c}) AS distinct_values, "
    f"min(TRY_CAST({c} AS DOUBLE)) AS min, max(TRY_CAST({c} AS DOUBLE)) AS max FROM orders" for c in _PROFILED))
def _(lake):
    return ops.profile(lake.table("orders"), _PROFILED)


view("naive", """
SELECT branch_id, model_name, occupancy_date, occupancy_pct AS y, yhat, rn > floor(n * 0.8::DOUBLE) AS is_test FROM (
  SELECT branch_id, occupancy_date, occupancy_pct, lag(occupancy_pct, 1) OVER w AS l1, lag(occupancy_pct, 7) OVER w AS l7, row_number() OVER w AS rn,
    count(*) OVER (PARTITION BY branch_id) AS n FROM daily_base WINDOW w AS (PARTITION BY branch_id ORDER BY occupancy_date)) d
CROSS JOIN LATERAL (VALUES ('naive_lag_1', d.l1), ('naive_lag_7', d.l7)) v(model_name, yhat) WHERE yhat IS NOT NULL""")
_REG = """SELECT model_name, round(avg(abs(y - yhat)), 6) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
  round(avg(abs((y - yhat) / y)) FILTER (WHERE y <> 0) * 100, 6) AS mape, count(*) AS n FROM naive {where} GROUP BY 1"""


def naive_scores(lake):
    """Occupancy against two naive predictors, with the chronological test mark."""
    df = windows.add_lags(daily(lake), "occupancy_pct", [1, 7], ["branch_id"], "occupancy_date")
    df = windows.chronological_split(df, ["branch_id"], "occupancy_date")
    pairs = F.array(*[
        F.struct(F.lit(f"naive_lag_{n}").alias("model_name"), F.col(f"occupancy_pct_lag_{n}").alias("yhat")) for n in (1, 7)
    ])
    return df.select("branch_id", "occupancy_date", F.col("occupancy_pct").alias("y"), "split", F.inline(pairs)).where("yhat is not null")


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("A17_regression_metrics", _REG.format(where=""))
def _(lake):
    return _rounded(ops.regression_metrics(naive_scores(lake), "y", "yhat", ["model_name"]), "mae", "rmse", "mape")


@query("G6_reevaluate_on_test_split", _REG.format(where="WHERE is_test"))
def _(lake):
    test = naive_scores(lake).where("split = 'test'")
    return _rounded(ops.regression_metrics(test, "y", "yhat", ["model_name"]), "mae", "rmse", "mape")


view("labelled", """
SELECT source, quality AS y, n_chars AS score, (n_chars >= 500)::INT AS yhat
FROM labels JOIN documents USING (doc_id)""")


def labelled(lake):
    score = F.col("n_chars")
    return lake.table("labels").join(lake.table("documents").select("doc_id", "source", "n_chars"), "doc_id").select(
        "source", F.col("quality").alias("y"), score.alias("score"), (score >= 500).cast("int").alias("yhat")
    )


@query("A18_classification_metrics", """
SELECT source, round(coalesce(sum((y = yhat)::INT) / count(*), 0), 6) AS accuracy,
  round(coalesce(tp / nullif(pp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(p, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(p + pp, 0), 0), 6) AS f1
FROM (SELECT *, sum((y = 1 AND yhat = 1)::INT) OVER s AS tp, sum((yhat = 1)::INT) OVER s AS pp, sum((y = 1)::INT) OVER s AS p FROM labelled
  WINDOW s AS (PARTITION BY source)) GROUP BY source, tp, pp, p""")
def _(lake):
    return _rounded(ops.classification_metrics(labelled(lake), "y", "yhat", ["source"]), "accuracy", "precision", "recall", "f1")


@query("A18_roc_auc", """
WITH r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rnk FROM labelled)
SELECT round((sum(rnk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2)
  / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS roc_auc FROM r""")
def _(lake):
    return _rounded(ops.roc_auc(labelled(lake), "y", "score"), "roc_auc")


# ---- model records ----

view("model_records", """
SELECT o_orderkey AS record_id, 'model_' || o_custkey AS model_name,
  ['occupancy', 'pricing', 'restaurant', 'staffing', 'churn'][(o_custkey % 5 + 1)::INT] AS task, o_custkey % 5 <> 4 AS lower_is_better,
  CASE o_orderstatus WHEN 'P' THEN 'Production' WHEN 'F' THEN 'Archived' ELSE 'Staging' END AS stage,
  CASE WHEN o_orderkey % 41 <> 0 THEN o_totalprice / 1000 END AS mae, (o_orderkey % 1000) / 1000 AS roc_auc,
  CASE WHEN o_custkey % 5 = 4 THEN (o_orderkey % 1000) / 1000 WHEN o_orderkey % 41 <> 0 THEN o_totalprice / 1000 END AS metric,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM orders""")
view("latest_metric", """
SELECT model_name, task, lower_is_better, metric FROM model_records QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1""")


def _newest(stage):
    return f"""(SELECT model_name, version AS v, metric AS m FROM model_records WHERE {stage}
      QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1)"""


view("stage_rows", f"""
SELECT b.model_name, b.lower_is_better, p.v AS production_version, p.m AS production_metric, s.v AS staging_version, s.m AS staging_metric,
  l.v AS latest_version, l.m AS latest_metric, a.v AS rollback_version
FROM (SELECT DISTINCT model_name, lower_is_better FROM model_records) b LEFT JOIN {_newest("stage = 'Production'")} p ON p.model_name = b.model_name
LEFT JOIN {_newest("stage = 'Staging'")} s ON s.model_name = b.model_name LEFT JOIN {_newest("true")} l ON l.model_name = b.model_name
LEFT JOIN {_newest("stage = 'Archived'")} a ON a.model_name = b.model_name""")


def summary(lake):
    return ops.stage_summary(src.model_records(lake))


@query("J15_production_vs_latest", """
SELECT model_name, production_version, round(production_metric, 6) AS production_metric, latest_version, round(latest_metric, 6) AS latest_metric
FROM stage_rows WHERE production_version IS NOT NULL""")
def _(lake):
    return _rounded(summary(lake).where("production_version is not null").select(
        "model_name", "production_version", "production_metric", "latest_version", "latest_metric"
    ), "production_metric", "latest_metric")


view("drift_latest", """
SELECT 'model_' || user_id AS model_name, CASE WHEN (props->>'$.k')::INT % 17 <> 0 THEN (props->>'$.k')::INT / 100 END AS drift_score FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")


@query("S14_latest_snapshot", "SELECT model_name AS module, drift_score FROM drift_latest")
def _(lake):
    return ops.latest_drift(src.drift_reports(lake))


_RETRAIN = """
SELECT *, drift_breached OR accuracy_breached AS retrain FROM (
SELECT model_name, drift_score, coalesce(drift_score > 0.30, false) AS drift_breached,
  coalesce(production_version IS NOT NULL AND latest_version <> production_version AND production_metric <> 0 AND
   (CASE WHEN lower_is_better THEN latest_metric - production_metric ELSE production_metric - latest_metric END) / abs(nullif(production_metric, 0)) > 0.10, false) AS accuracy_breached
FROM stage_rows LEFT JOIN drift_latest USING (model_name))"""


@query("G1_retrain_signal", _RETRAIN)
def _(lake):
    return ops.retrain_signals(src.model_records(lake), src.drift_reports(lake))


@query("G2_beats_production", """
SELECT model_name, staging_version, production_version, coalesce(CASE WHEN lower_is_better THEN staging_metric < production_metric
  ELSE staging_metric > production_metric END, true) AS beats_production FROM stage_rows WHERE staging_version IS NOT NULL""")
def _(lake):
    return ops.beats_production(summary(lake))


@query("G3_stage_transition", """
SELECT r.model_name, r.version, CASE WHEN r.version = s.staging_version THEN 'Production' WHEN s.staging_version IS NOT NULL AND stage = 'Production'
  THEN 'Archived' ELSE stage END AS stage FROM model_records r LEFT JOIN stage_rows s USING (model_name)""")
def _(lake):
    records = src.model_records(lake)
    targets = ops.stage_summary(records).where("staging_version is not null").select("model_name", F.col("staging_version").alias("target_version"))
    return ops.promote(records, targets).select("model_name", "version", "stage")


@query("G3_rollback", """
SELECT r.model_name, r.version, CASE WHEN r.version = s.rollback_version THEN 'Production' WHEN s.rollback_version IS NOT NULL AND stage = 'Production'
  THEN 'Archived' ELSE stage END AS stage FROM model_records r LEFT JOIN stage_rows s USING (model_name)""")
def _(lake):
    records = src.model_records(lake)
    targets = ops.stage_summary(records).where("rollback_version is not null").select("model_name", F.col("rollback_version").alias("target_version"))
    return ops.promote(records, targets).select("model_name", "version", "stage")


_NO_METRICS = ", ".join(f"NULL::DOUBLE AS {m}" for m in ("mape", "accuracy", "precision", "recall", "f1"))


@query("G4_evaluation_dashboard", f"""
SELECT model_name, version, mae, mae * 1.25::DOUBLE AS rmse, roc_auc, {_NO_METRICS} FROM model_records""")
def _(lake):
    return ops.evaluation_dashboard(src.model_records(lake))


@query("G5_comparison_matrix", f"""
SELECT task, model_name, mae, mae * 1.25::DOUBLE AS rmse, roc_auc, {_NO_METRICS} FROM model_records
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1""")
def _(lake):
    return ops.comparison_matrix(src.model_records(lake))


_VALIDATION = f"""
WITH f AS ({_print('events', _EVENT_COLUMNS, 'event_type')}), o AS ({_print('events', _EVENT_COLUMNS, 'event_type', "ts < TIMESTAMP '2024-01-16'")}),
k AS ({_ks(['domain'], "column_name = 'value'")})
SELECT f.event_type AS domain, f.row_count, f.content_hash, f.content_hash IS DISTINCT FROM o.content_hash AS changed, round(k.ks, 6) AS ks, k.drifted
FROM f LEFT JOIN o ON o.event_type = f.event_type LEFT JOIN k ON k.domain = f.event_type"""


@query("G7_nightly_domain_validation", _VALIDATION)
def _(lake):
    from staylytics.plans.validation import validate_domains

    events = lake.table("events").withColumn("domain", F.col("event_type"))
    old = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return validate_domains(events.where(old), events, ~old, "value", _EVENT_COLUMNS).withColumn("ks", F.round("ks", 6))


_ENTRIES = sorted({*rv.C.POSITIVE_WORDS, *rv.C.NEGATIVE_WORDS})


@query("G8_lexicon_snapshot", f"""
WITH e(entry) AS (VALUES {', '.join(f"('{w}')" for w in _ENTRIES)}),
seen AS (SELECT DISTINCT hotel_id, entry FROM reviews JOIN e ON contains(lower(review), entry))
SELECT hotel_id, count(*) AS vocab_size, sha256(string_agg(entry, ',' ORDER BY entry)) AS content_hash FROM seen GROUP BY 1""")
def _(lake):
    from staylytics.plans.validation import lexicon_snapshot

    return lexicon_snapshot(reviews(lake), _ENTRIES)
