"""Streams with state: conversation memory, drift per batch, late rows, documents seen."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from staylytics.operators import monitoring
from staylytics.session import scratch_path
from staylytics.streaming import drift, jobs, memory, sinks

START = 1_704_067_200


def arrivals(spark, rows, schema, parts):
    """Folder that gets one part after another; yields after each."""
    folder = scratch_path(spark, "arrivals")
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/part={k}")
        yield spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def test_memory_over_batches_and_restarts(spark):
    rng = random.Random(1)
    schema = "session_id long, turn long, role string, text string, said_at long"
    rows = [(s, t, "user", f"{s}/{t}", START + 300 * t + 7 * s) for s in range(6) for t in range(rng.choice([2, 5, 30]))]
    rows += [(99, 0, "user", "first", START), (99, 1, None, None, START + 9000), (None, 0, "user", "nobody", START + 100)]
    rows.sort(key=lambda r: r[4])
    cuts = [rows[:20], rows[20:21], rows[21:70], rows[70:]]
    sink = scratch_path(spark, "memory")
    with sinks.disk_state(spark):
        for stream in arrivals(spark, rows, schema, [c for c in cuts if c]):
            jobs.drain(memory.remembered(stream, max_turns=4), sink)
    states = spark.read.schema(memory.MEMORY).parquet(f"{sink}/data")
    got = {}
    for r in memory.last_memory(states.where("session_id IS NOT NULL")).collect():
        got.setdefault(r["session_id"], []).append((r["recency"], r["turn"], r["text"], r["expired"]))
    last, final = {}, max(r[4] for r in rows)
    for r in rows:
        if r[0] is not None:
            last.setdefault(r[0], []).append(r)
    for session, turns in last.items():
        newest = max(t[4] for t in turns)
        live = sorted((t for t in turns if t[4] >= newest + 60 - 1800), key=lambda t: -t[4])[:4]
        expired = newest + 1800 < final - 600
        assert sorted(got[session]) == [(k, t[1], t[3], expired) for k, t in enumerate(live, 1)], session
    assert states.where("session_id IS NULL").count() > 0
    assert {s for s in got if got[s][0][3]} and {s for s in got if not got[s][0][3]}


def test_drift_survives_replays_and_restarts(spark):
    rng = random.Random(2)
    lines = []
    for i in range(600):
        day, second = rng.randint(1, 28), rng.randint(0, 86399)
        stamp = f"2024-01-{day:02d}T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.{rng.randint(0, 999999):06d}"
        lines.append('{"domain":"d%d","value":%s,"flag":true,"_logged_at":"%s"}' % (i % 3, rng.choice(["null", str(rng.gauss(day, 5))]), stamp))
    lines += ["", "broken", '{"domain":"d1","value":5}', '{"domain":"lonely","value":1,"_logged_at":"2024-01-02T00:00:00"}', '{"value":3,"_logged_at":"2024-01-02T00:00:00"}']
    folder, path = scratch_path(spark, "lines"), scratch_path(spark, "drift")
    write = drift.drift_sink(path)
    for k in range(4):
        spark.createDataFrame([(x,) for x in lines[k::4]], "value string").write.mode("append").text(folder)
        sinks.each_batch(spark.readStream.option("maxFilesPerTrigger", 2).text(folder), path, write)
    want = sorted(monitoring.prediction_drift(monitoring.parse_log(spark.read.text(folder))).collect(), key=repr)

    def report():
        return sorted(drift.drift_report(spark, path).select(*want[0].__fields__).collect(), key=repr)

    def close(a, b):
        return all(x == pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(x, float) else x == y for x, y in zip(a, b))

    assert want and len(report()) == len(want) and all(close(a, b) for a, b in zip(report(), want))
    # the last batch is handed over once more: its commit is lost, so the restarted stream repeats it
    commits = sorted((p for p in Path(f"{path}/checkpoint/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    for extra in Path(f"{path}/checkpoint/commits").glob(f".{commits[-1].name}.crc"):
        extra.unlink()
    sinks.each_batch(spark.readStream.option("maxFilesPerTrigger", 2).text(folder), path, write)
    assert all(close(a, b) for a, b in zip(report(), want)) and len(report()) == len(want)


def test_drift_report_without_batches(spark):
    assert drift.drift_report(spark, scratch_path(spark, "none")).collect() == []


def test_late_rows_are_counted_over_batches(spark):
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def at(minutes):
        rows = [(i, m, 1, "a" if i % 2 else "b", 1.0) for i, m in enumerate(minutes)]
        df = spark.createDataFrame(rows, "event_id long, m long, user_id long, event_type string, value double")
        return df.withColumn("ts", base + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"))).select("event_id", "ts", "user_id", "event_type", "value")

    # the watermark stands at 110 after the first arrival and at 290 after the second
    got = jobs.late_data(at([*range(60), 120]), at([1, 2, 3, 111, 300, 104, 106]), at([120, 280, 284, 286, 299, 400])).collect()
    assert {r["dropped_total"] for r in got} == {5 + 4}
    assert sum(r["counted"] for r in got) == 61 + 2 + 1  # windows that the last watermark, at 390, has closed


def test_seen_documents_by_batches(spark):
    path = scratch_path(spark, "seen")
    write = jobs.dedupe_sink(path)
    docs = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string")
    write(docs("a", "b", "a", None), 0)
    write(docs("b", "c", None), 1)
    write(docs("b", "c", None), 1)  # replayed
    write(docs("a", "b", "a", None), 0)
    got = sinks.batches(spark, path, "hash string, batch int").collect()
    assert len(got) == 4 and len({r["hash"] for r in got}) == 4
    assert sorted(r["batch"] for r in got) == [0, 0, 0, 1]


def test_options_are_put_back(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with sinks.disk_state(spark):
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == sinks.DISK_STATE
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
