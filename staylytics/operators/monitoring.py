"""Quality metrics, drift, fingerprints, and the model record table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.keys import hash63, joined
from staylytics.operators.joins import null_safe_join
from staylytics.operators.ordering import exact_quantile, with_running_totals
from staylytics.session import settle

# ---- prediction logs -------------------------------------------------------------------------------------------


def json_number(c: Column) -> Column:
    """Numeric value of a JSON field; booleans, text and NULL give NULL."""
    return c.try_cast("double")


def parse_log(lines: DataFrame) -> DataFrame:
    """Schema-on-read of log lines: blank, malformed and undated lines are skipped."""
    fields = F.from_json(F.trim("value"), "map<string,string>")
    parsed = lines.select(fields.alias("fields"))
    stamp = F.try_to_timestamp(F.element_at("fields", "_logged_at"))
    return parsed.select(
        F.element_at("fields", "domain").alias("domain"), stamp.alias("logged_at"),
        F.map_filter("fields", lambda k, _: ~k.isin("_logged_at", "domain")).alias("fields"),
    ).where(F.col("logged_at").isNotNull())


def window_label(t: Column, now: Column, window_days: int) -> Column:
    """'recent' in the window that ends at ``now``, 'prior' in the one before it, else NULL."""
    span = F.expr(f"INTERVAL {int(window_days)} DAYS")
    return F.when(t > now - span, "recent").when(t > now - span - span, "prior")


def windowed_log(log: DataFrame, window_days: int = 7) -> DataFrame:
    """Records of the two newest windows per domain, labelled; the anchor is the domain's newest record."""
    anchors = log.groupBy("domain").agg(F.max("logged_at").alias("now"))
    label = window_label(F.col("logged_at"), F.col("now"), window_days)
    return null_safe_join(log, anchors, ["domain"]).withColumn("window", label).where(F.col("window").isNotNull()).drop("now")


def log_fields(log: DataFrame, *keep: str) -> DataFrame:
    """One row per numeric field of each record, with its domain and the columns to keep."""
    entries = log.select("domain", *keep, F.explode_outer("fields").alias("field", "text"))
    return entries.withColumn("number", json_number(F.col("text"))).where("number is not null").drop("text")


def with_marker(log: DataFrame) -> DataFrame:
    """A numeric field ``_records`` on every record, so that records are counted in the same aggregate as fields."""
    return log.withColumn("fields", F.map_concat("fields", F.create_map(F.lit("_records"), F.lit("1"))))


def shared_fields(log: DataFrame) -> DataFrame:
    """Numeric fields that occur in both windows of a domain."""
    fields = log_fields(log, "window")
    seen = [fields.where(F.col("window") == w).select("domain", "field") for w in ("recent", "prior")]
    return seen[0].intersect(seen[1])


def prediction_drift(log: DataFrame, window_days: int = 7) -> DataFrame:
    """Mean and population deviation per domain and field in the recent and prior window, with a verdict.

    Domains with fewer than two records in either window, and such fields, are left out.
    """
    recent, prior, n = F.col("window") == "recent", F.col("window") == "prior", F.col("number")
    return drift_verdict(log_fields(with_marker(windowed_log(log, window_days)), "window").groupBy("domain", "field").agg(
        F.count_if(recent).alias("n_recent"), F.count_if(prior).alias("n_prior"),
        F.avg(F.when(recent, n)).alias("recent_mean"), F.stddev_pop(F.when(recent, n)).alias("recent_std"),
        F.avg(F.when(prior, n)).alias("prior_mean"), F.stddev_pop(F.when(prior, n)).alias("prior_std"),
    ))


def drift_verdict(stats: DataFrame) -> DataFrame:
    """Fields with two records in both windows, and whether they are stable, from one row per domain and field.

    The marker field carries the numbers of records.
    """
    per_domain, records = Window.partitionBy("domain"), F.col("field") == "_records"
    stats = stats.withColumns({
        "recent_count": F.max(F.when(records, F.col("n_recent"))).over(per_domain),
        "prior_count": F.max(F.when(records, F.col("n_prior"))).over(per_domain),
    }).where(~records & F.expr("recent_count >= 2 AND prior_count >= 2 AND n_recent >= 2 AND n_prior >= 2"))
    limit = F.greatest(F.col("prior_std") * 0.5, F.abs("prior_mean") * 0.2, F.lit(1e-9))
    stable = F.abs(F.col("recent_mean") - F.col("prior_mean")) <= limit
    return stats.withColumn("stable", stable).drop("n_recent", "n_prior")


# ---- data drift and fingerprints -------------------------------------------------------------------------------


def ks_drift(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per key between rows with ``is_current`` false and true.

    ``drifted`` uses the 5 % asymptotic bound. Equal values collapse map-side into a histogram first.
    """
    keys = list(keys)
    cur = F.col("is_current")
    hist = values.where("v is not null").groupBy(*keys, "v").agg(
        F.count_if(~cur).alias("ref"), F.count_if(cur).alias("cur")
    )
    running = with_running_totals(hist, keys, ["v"], {"ref_cum": F.col("ref"), "cur_cum": F.col("cur")})
    sizes = hist.groupBy(*keys).agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    gap = F.abs(F.col("ref_cum") / F.col("n_ref") - F.col("cur_cum") / F.col("n_cur"))
    found = null_safe_join(running, sizes.where("n_ref > 0 AND n_cur > 0"), keys).groupBy(*keys, "n_ref", "n_cur").agg(
        F.max(gap).alias("ks")
    )
    bound = F.sqrt((F.col("n_ref") + F.col("n_cur")) / (F.col("n_ref") * F.col("n_cur"))) * 1.3581
    return found.withColumn("drifted", F.col("ks") > bound)


TEXT_DRIFT = 0.1  # Jensen-Shannon distance from which a text column has drifted
RARE_SHARE = 0.005  # values with a smaller share of all rows count as one


def text_drift(values: DataFrame, keys: Sequence[str], bound: float = TEXT_DRIFT, rare: float = RARE_SHARE) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) per key between the value histograms of rows with ``is_current`` false and
    true. NULLs are left out; rare values are pooled, so that ids and free texts do not count as drift by themselves."""
    keys = list(keys)
    cur = F.col("is_current")
    hist = settle(values.where("v IS NOT NULL").groupBy(*keys, "v").agg(F.count_if(~cur).alias("ref"), F.count_if(cur).alias("cur")))
    sizes = hist.groupBy(*keys).agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur")).where("n_ref > 0 AND n_cur > 0")
    placed = null_safe_join(hist, sizes, keys)
    name = F.when(F.col("ref") + F.col("cur") >= (F.col("n_ref") + F.col("n_cur")) * rare, F.struct("v"))
    pooled = placed.groupBy(*keys, "n_ref", "n_cur", name.alias("_name")).agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    p, q = F.col("ref") / F.col("n_ref"), F.col("cur") / F.col("n_cur")

    def towards_middle(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / ((p + q) / 2))).otherwise(0.0)

    distance = F.sqrt(F.greatest(F.sum(towards_middle(p) + towards_middle(q)) / 2, F.lit(0.0)))
    return pooled.groupBy(*keys, "n_ref", "n_cur").agg(distance.alias("distance")).withColumn("drifted", F.col("distance") > bound)


def column_drift(df: DataFrame, is_current: Column, columns: Sequence[str]) -> DataFrame:
    """(column_name, test, n_ref, n_cur, distance, drifted) of columns of any simple type: text and boolean columns by
    ``text_drift``, numbers by ``ks_drift``."""
    kinds = {c: t for c, t in df.dtypes if c in columns}
    text = [c for c in columns if kinds[c] in ("string", "boolean")]

    def entries(names: Sequence[str], kind: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("v")) for c in names])
        return df.select(is_current.alias("is_current"), F.inline(pairs))

    parts = []
    if text:
        parts.append(text_drift(entries(text, "string"), ["column_name"]).withColumn("test", F.lit("jensen_shannon")))
    if len(text) < len(columns):
        numeric = ks_drift(entries([c for c in columns if c not in text], "double"), ["column_name"]).withColumnRenamed("ks", "distance")
        parts.append(numeric.withColumn("test", F.lit("kolmogorov_smirnov")))
    return reduce(DataFrame.unionByName, parts).select("column_name", "test", "n_ref", "n_cur", "distance", "drifted")


def drift_share(columns: DataFrame) -> DataFrame:
    return columns.agg(
        F.count("*").alias("n_columns"), F.count_if("drifted").alias("n_drifted"),
        (F.count_if("drifted") / F.count("*")).alias("drift_score"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Row count, column count and an order-free content hash (sum and xor of row hashes)."""
    rows = df.select(*keys, hash63(joined(columns)).alias("h"))
    agg = rows.groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")
    )
    text = F.concat_ws(":", F.col("row_count").cast("string"), F.col("s").cast("string"), F.col("x").cast("string"))
    return agg.select(
        *keys, "row_count", F.lit(len(columns)).alias("feature_count"), F.sha2(text, 256).alias("content_hash")
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing share, distinct values and numeric range per column, from one (column, value) histogram."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column_name", "v")
    hist = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    number = json_number(F.col("v"))
    return hist.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        (F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)) * 100 / F.sum("n")).alias("missing_pct"),
        F.count("v").alias("distinct_values"), F.min(number).alias("min"), F.max(number).alias("max"),
    )


# ---- evaluation ------------------------------------------------------------------------------------------------


def regression_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE; MAPE skips y = 0 and is NULL when nothing is left."""
    a, p = F.col(y), F.col(yhat)
    err = a - p
    return df.groupBy(*keys).agg(
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.when(a != 0, F.abs(err / F.when(a != 0, a)))) * 100).alias("mape"), F.count("*").alias("n"),
    )


def classification_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 with 0 for empty denominators."""
    t, p = F.col(y) == 1, F.col(yhat) == 1
    cells = df.groupBy(*keys).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"),
        F.count_if(t == p).alias("hits"), F.count("*").alias("n"),
    )

    def share(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.select(
        *keys, share(F.col("hits"), F.col("n")).alias("accuracy"), share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Tie-averaged area under the ROC curve from a per-score histogram; NULL for a single class."""
    keys = list(keys)
    hist = df.groupBy(*keys, F.col(score).alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    running = with_running_totals(hist, keys, ["s"], {"neg_upto": F.col("neg")})
    wins = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    return running.groupBy(*keys).agg(
        F.try_divide(F.sum(wins), (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc")
    )


def latency_panel(df: DataFrame) -> DataFrame:
    """Predictions, errors and exact p95 latency per domain and version."""
    keys = ["domain", "model_version"]
    counts = df.groupBy(*keys).agg(F.count("*").alias("predictions"), F.count_if("is_error").alias("errors"))
    return null_safe_join(counts, exact_quantile(df, "latency", 0.95, keys, "p95"), keys, "left")


# ---- model records ---------------------------------------------------------------------------------------------


def with_primary_metric(records: DataFrame) -> DataFrame:
    """Churn models are judged by ROC-AUC (higher is better), all others by MAE (lower is better)."""
    churn = F.col("task") == "churn"
    return records.withColumns({
        "lower_is_better": ~churn,
        "metric": F.when(churn, F.element_at("metrics", "roc_auc")).otherwise(F.element_at("metrics", "mae")),
    })


def latest_metrics(records: DataFrame) -> DataFrame:
    return with_primary_metric(records).groupBy("model_name", "task", "lower_is_better").agg(
        F.max_by("metric", "version").alias("metric")
    )


def best_per_task(latest: DataFrame) -> DataFrame:
    signed = F.when(F.col("lower_is_better"), -F.col("metric")).otherwise(F.col("metric"))
    scored = latest.where("metric is not null").withColumn("signed", signed)
    return scored.groupBy("task").agg(
        F.max_by("model_name", F.struct("signed", "model_name")).alias("best_model"),
        F.round(F.max("signed"), 6).alias("signed_metric"),
    )


def stage_summary(records: DataFrame) -> DataFrame:
    """Per model: newest production, newest staging and newest version with their primary metric, in one aggregate."""
    rows = with_primary_metric(records)

    def newest(stage: str) -> Column:
        return F.max_by(F.struct("version", "metric"), F.when(F.col("stage") == stage, F.col("version")))

    return rows.groupBy("model_name", "lower_is_better").agg(
        newest("Production").alias("p"), newest("Staging").alias("s"),
        F.max_by(F.struct("version", "metric"), "version").alias("l"),
        F.max(F.when(F.col("stage") == "Archived", F.col("version"))).alias("rollback_version"),
    ).select(
        "model_name", "lower_is_better", F.col("p.version").alias("production_version"),
        F.col("p.metric").alias("production_metric"), F.col("s.version").alias("staging_version"),
        F.col("s.metric").alias("staging_metric"), F.col("l.version").alias("latest_version"),
        F.col("l.metric").alias("latest_metric"), "rollback_version",
    )


def latest_drift(reports: DataFrame) -> DataFrame:
    """Score of the newest report per module (NULL when that report has none)."""
    return reports.groupBy("module").agg(
        F.max_by("drift_score", F.struct("generated_at", "event_id")).alias("drift_score")
    )


def retrain_signals(records: DataFrame, reports: DataFrame) -> DataFrame:
    """Retrain when the drift score or the relative quality drop of the newest version exceeds its limit."""
    s = stage_summary(records)
    gain = F.col("latest_metric") - F.col("production_metric")
    drop = F.try_divide(F.when(F.col("lower_is_better"), gain).otherwise(-gain), F.abs("production_metric"))
    newer = F.col("latest_version") != F.col("production_version")
    drift = latest_drift(reports).withColumnRenamed("module", "model_name")
    return s.join(drift, "model_name", "left").select(
        "model_name", "drift_score",
        F.coalesce(F.col("drift_score") > C.DRIFT_SCORE_LIMIT, F.lit(False)).alias("drift_breached"),
        F.coalesce(newer & (drop > C.QUALITY_DROP_LIMIT), F.lit(False)).alias("accuracy_breached"),
    ).withColumn("retrain", F.col("drift_breached") | F.col("accuracy_breached"))


def beats_production(summary: DataFrame) -> DataFrame:
    """Verdict on the newest staging version; without production or with a metric missing it passes."""
    new, old = F.col("staging_metric"), F.col("production_metric")
    better = F.when(F.col("lower_is_better"), new < old).otherwise(new > old)
    return summary.where("staging_version is not null").select(
        "model_name", "staging_version", "production_version",
        F.coalesce(better, F.lit(True)).alias("beats_production"),
    )


def promote(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Rewrite stages: each model's target version becomes Production, its other Production versions Archived."""
    joined_rows = records.join(targets.select("model_name", "target_version"), "model_name", "left")
    t = F.col("target_version")
    stage = F.when(F.col("version") == t, "Production").when(
        t.isNotNull() & (F.col("stage") == "Production"), "Archived"
    ).otherwise(F.col("stage"))
    return joined_rows.withColumn("stage", stage).drop("target_version")


METRIC_COLUMNS = ["mae", "rmse", "mape", "accuracy", "precision", "recall", "f1", "roc_auc"]


def metric_rows(records: DataFrame) -> DataFrame:
    return records.select("task", "model_name", "version", F.explode("metrics").alias("metric", "value"))


def evaluation_dashboard(records: DataFrame) -> DataFrame:
    """One wide row per model version; metrics it does not have are NULL."""
    return metric_rows(records).groupBy("model_name", "version").pivot("metric", METRIC_COLUMNS).agg(F.max("value"))


def comparison_matrix(records: DataFrame) -> DataFrame:
    """Newest metrics per task and model, one column per metric name."""
    newest = records.groupBy("task", "model_name").agg(F.max_by("metrics", "version").alias("metrics"))
    rows = newest.select("task", "model_name", F.explode("metrics").alias("metric", "value"))
    return rows.groupBy("task", "model_name").pivot("metric", METRIC_COLUMNS).agg(F.max("value"))
