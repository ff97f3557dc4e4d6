"""Jobs that read the joined bookings several times get them from one stored table."""

from staylytics.checks import insights as checks
from staylytics.checks import load_all
from staylytics.checks.registry import QUERIES
from staylytics.sources import io
from staylytics.sources.lake import Lake

ROOT = "/root/testdata/sf0.001"


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_what_is_written_twice_is_joined_once(spark, monkeypatch):
    seen, write = [], io.write_result
    monkeypatch.setattr(io, "write_result", lambda df, *rest: (seen.append(joins(df)), write(df, *rest)))
    load_all()
    rows = {r["part"]: r["row_count"] for r in QUERIES["S15_history_and_latest_sink"](spark, ROOT).collect()}
    assert seen == [0, 0] and rows["history"] == 2 * rows["latest"] > 0


def test_rules_share_the_bookings(spark, monkeypatch):
    seen = {}
    for rule in ("occupancy", "churn"):
        run = getattr(checks.ops, rule)
        monkeypatch.setattr(checks.ops, rule, lambda df, rule=rule, run=run: (seen.update({rule: joins(df)}), run(df))[1])
    assert checks.all_findings(Lake(spark, ROOT), ["occupancy", "churn"]).count() > 0
    assert seen == {"occupancy": 0, "churn": 1}  # a guest's totals
