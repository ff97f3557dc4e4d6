"""Insight thresholds, metrics, drift, features, files and streams on small frames."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from staylytics.operators import features, insights, monitoring, windows
from staylytics.plans import review_report, scoring
from staylytics.session import scratch_path
from staylytics.sources import io
from staylytics.sources.lake import Lake
from staylytics.sources.marts import get_mart
from staylytics.streaming import jobs


def _mart(spark, column, series, extra=""):
    rows = [(1, f"2024-01-{i + 1:02d}", float(v)) for i, v in enumerate(series)]
    return spark.createDataFrame(rows, f"branch_id int, date string, {column} double").withColumn("date", F.to_date("date"))


@pytest.mark.parametrize("latest,expected", [(80.0, [("high", -20.0)]), (90.0, [("medium", -10.0)]), (95.0, []), (115.0, [("low", 15.0)])])
def test_revenue_rule(spark, latest, expected):
    mart = _mart(spark, "total_revenue", [100, latest]).withColumn("revenue_7day_avg", F.lit(100.0))
    assert values(insights.revenue(mart), "severity", "metric_delta") == expected


@pytest.mark.parametrize("series,titles", [([30] * 3, 1), ([20] * 8, 1), ([96] * 8, 1), ([60] * 8, 0), ([60] * 7 + [80], 1), ([90] * 7 + [35], 2)])
def test_occupancy_rule(spark, series, titles):
    assert insights.occupancy(_mart(spark, "occupancy_pct", series)).count() == titles


def test_staff_rule_reads_zero_attendance_as_missing(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01", 4, 0, 0.0), (1, "b", "2024-01-01", 10, 7, 70.0)],
                               "branch_id int, department_name string, date string, scheduled_employees long, present_employees long, attendance_rate_pct double")
    assert values(insights.staff(df), "metric", "severity") == [("attendance_rate_pct", "medium"), ("staffing_gap", "high"), ("staffing_gap", "medium")]


def test_anomaly_needs_ten_values_and_spread(spark):
    assert insights.anomaly(_mart(spark, "v", [1, 2] * 4 + [50]), "v").count() == 0
    assert insights.anomaly(_mart(spark, "v", [1] * 11 + [50]), "v").count() == 0
    assert values(insights.anomaly(_mart(spark, "v", [1, 2] * 5 + [50]), "v"), "severity") == [("high",)]


def test_recommendation_and_summary_text(spark):
    df = spark.createDataFrame([("c", "t", "m", 0.0009, "high", "x"), ("c", "u", "m", None, "low", "x"), ("c", "v", "m", 5.0, "low", "x")], "category string, title string, metric string, metric_delta double, severity string, citation string")
    texts = [r["recommendation"] for r in insights.recommend(df).collect()]
    assert "(delta: 0.0009)" in texts[0] and "delta" not in texts[1] and "(delta: 5.0)" in texts[2]
    assert insights.executive_summary(df, 1).first()[0] == "Top findings requiring attention:\n- [HIGH] t"
    assert insights.executive_summary(df.limit(0)).first()[0] == "No significant findings at this time."


def test_auc_with_ties_and_single_class(spark):
    rows = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    brute = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert monitoring.roc_auc(df, "y", "s").first()[0] == pytest.approx(brute)
    assert monitoring.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_mape_skips_zeros(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 9.0)], "y double, p double")
    assert monitoring.regression_metrics(df, "y", "p").first()["mape"] == pytest.approx(10.0)
    assert monitoring.regression_metrics(df.where("y = 0"), "y", "p").first()["mape"] is None


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def _entry(v, day):
    return f'{{"domain":"d","value":{v},"ok":true,"_logged_at":"2024-01-{day:02d}T00:00:00"}}'


def test_drift_report_cases(spark):
    stable = [_entry(10 + d % 2, d) for d in range(1, 15)]
    moved = [_entry(1 + d % 2, d) for d in range(1, 8)] + [_entry(500, d) for d in range(8, 15)]
    noise = ["", "not json", '{"domain":"d","value":1}', '{"domain":"d","value":1,"_logged_at":"never"}']
    for rows, verdict in ((stable, True), (moved, False)):
        report = monitoring.prediction_drift(monitoring.parse_log(_lines(spark, rows + noise)))
        assert values(report, "field", "stable") == [("value", verdict)]
    assert monitoring.prediction_drift(monitoring.parse_log(_lines(spark, stable[:1]))).count() == 0


def test_fingerprint_ignores_order_but_not_content(spark):
    a = spark.range(50).withColumn("x", F.col("id") * 2)
    hashes = [monitoring.fingerprint(d, ["id", "x"]).first()["content_hash"] for d in (a, a.orderBy(F.desc("id")).repartition(5), a.where("id <> 3"), a.union(a.limit(1)))]
    assert hashes[0] == hashes[1] and len(set(hashes)) == 3


def test_promotion_archives_the_previous_production(spark):
    df = spark.createDataFrame([("m", 1, "Production"), ("m", 2, "Archived"), ("m", 3, "Staging"), ("n", 1, "Production")], "model_name string, version int, stage string")
    target = spark.createDataFrame([("m", 3)], "model_name string, target_version int")
    assert values(monitoring.promote(df, target), "model_name", "version", "stage") == [("m", 1, "Archived"), ("m", 2, "Archived"), ("m", 3, "Production"), ("n", 1, "Production")]


def test_features(spark):
    df = spark.createDataFrame([(1, 1, 4.0), (1, 2, None), (1, 3, 8.0), (2, 1, None)], "g int, t int, v double")
    assert values(windows.fill_forward_then_back(df, ["v"], ["g"], "t"), "g", "t", "v")[:3] == [(1, 1, 4.0), (1, 2, 4.0), (1, 3, 8.0)]
    assert values(features.fill_with_medians(df, ["v"]), "v") == [(4.0,), (6.0,), (6.0,), (8.0,)]
    assert values(df.select(features.safe_ratio(F.col("v"), F.lit(0.0), 1.0).alias("r"))) == [(1.0,)] * 4
    codes = features.fit_categories(spark.createDataFrame([("b",), ("a",)], "c string"), "c")
    seen = features.apply_categories(spark.createDataFrame([("a",), ("b",), ("z",)], "c string"), "c", codes)
    assert values(seen, "c", "c_code") == [("a", 0.0), ("b", 1.0), ("z", -1.0)]


def test_risk_levels(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (0.6,), (None,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_level(F.col("p"))).collect()] == ["Low", "Medium", "High", None]


def test_file_contracts(spark):
    path = scratch_path(spark, "bad-csv")
    spark.createDataFrame([(1,)], "hotel int").write.option("header", True).csv(path)
    with pytest.raises(io.SchemaMismatch, match="missing columns"):
        io.read_raw_bookings(spark, path)
    with pytest.raises(ValueError, match="unknown mart"):
        get_mart(Lake(spark, "/nowhere"), "mart_unknown")
    with pytest.raises(io.MissingTable):
        io.require_table(spark, "no_such_table")
    with pytest.raises(review_report.NotAnalyzedError):
        review_report.get_summary(spark, scratch_path(spark, "none"))
    with pytest.raises(ValueError, match="unknown grain"):
        review_report.get_trends(spark, path, "yearly")


def test_sessions_join_across_midnight_and_split_on_gaps(spark):
    stamps = ["2024-01-01 23:50:00", "2024-01-02 00:10:00", "2024-01-02 00:40:00", "2024-01-02 01:10:01"]
    df = spark.createDataFrame([(1, t) for t in stamps], "user_id long, t string").withColumn("ts", F.to_timestamp("t"))
    assert [n for _, n in values(jobs.batch_sessions(df), "session_start", "n")] == [3, 1]
    assert values(jobs.batch_sessions(df), "n") == values(jobs.sessions(df), "n")


def test_late_rows_do_not_change_closed_windows(spark):
    events = Lake(spark, "/root/testdata/sf0.001").table("events")
    edge = F.lit("2024-01-20").cast("timestamp_ntz")
    recent, late = events.where(F.col("ts") >= edge), events.where(F.col("ts") < edge)
    rows = jobs.late_data(recent, late).collect()
    assert rows[0]["dropped_total"] > 0 and sum(r["counted"] for r in rows) <= recent.count()
