"""Checks for streaming jobs. Streams run over the whole table; SQL twins keep the windows the watermark has closed."""

from pyspark.sql import functions as F

from staylytics.checks.monitoring import _DRIFT, drift_rounded
from staylytics.checks.registry import query
from staylytics.checks.views import view
from staylytics.operators import monitoring
from staylytics.session import scratch_path
from staylytics.sources.models import prediction_log
from staylytics.streaming import drift, jobs, memory
from staylytics.streaming.sinks import disk_state, each_batch

_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)"
_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


@query("T1_log_ingestion", "SELECT event_type AS domain, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY 1")
def _(lake):
    stream = jobs.with_event_time(jobs.file_stream(lake.spark, lake.root, "events.parquet"))
    return jobs.drained(stream, "ingest").groupBy("domain").agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")
    )


view("rate_windows", """
SELECT w AS window_start, event_type AS domain, count(*) AS n FROM (SELECT event_type, date_trunc('minute', ts) - to_minutes(unnest(range(5))) AS w FROM events) GROUP BY 1, 2""")


@query("T2_event_rate_stream", f"""
SELECT {_TS.format(c='window_start')} AS window_start, domain, n, n / 300 AS per_second FROM rate_windows WHERE window_start + INTERVAL 5 MINUTE <= {_CLOSED}""")
def _(lake):
    return jobs.drained(jobs.event_rate(jobs.event_stream(lake.spark, lake.root)), "rate")


@query("T2_event_rate_batch", f"SELECT {_TS.format(c='window_start')} AS window_start, domain, n, n / 300 AS per_second FROM rate_windows")
def _(lake):
    return jobs.event_rate(jobs.with_event_time(lake.table("events")))


_P95 = f"""SELECT {_TS.format(c='w')} AS window_start, domain, quantile_disc(value, 0.95) AS p95, count(*) AS n FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, event_type AS domain, value FROM events) {{where}} GROUP BY w, domain"""


@query("T3_latency_p95_stream", _P95.format(where=f"WHERE w + INTERVAL 5 MINUTE <= {_CLOSED}"))
def _(lake):
    return jobs.histogram_p95(jobs.drained(jobs.latency_histogram(jobs.event_stream(lake.spark, lake.root)), "p95"))


_SESSIONS = f"""
SELECT user_id, {_TS.format(c='min(ts)')} AS session_start, {_TS.format(c='max(ts) + INTERVAL 30 MINUTE')} AS session_end, count(*) AS n FROM (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM (
    SELECT user_id, ts, coalesce((ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE)::INT, 0) AS opens FROM events))
GROUP BY user_id, s"""


@query("T4_session_stream", _SESSIONS + f" HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}")
def _(lake):
    with jobs.merged_sessions(lake.spark):
        return jobs.drained(jobs.sessions(jobs.event_stream(lake.spark, lake.root)), "sessions")


@query("T4_session_batch", _SESSIONS)
def _(lake):
    return jobs.batch_sessions(jobs.with_event_time(lake.table("events")))


@query("T5_document_dedupe_stream", "SELECT DISTINCT sha256(text) AS hash FROM documents")
def _(lake):
    return jobs.distinct_documents(jobs.file_stream(lake.spark, lake.root, "documents.parquet"))


# Turns arrive in order of time, four turns of all conversations in a batch; a session is idle 30 minutes after its last.
@query("T4_conversation_memory", """
SELECT session_id, r.turn, recency, max(r.said_at) OVER (PARTITION BY session_id) + 1800 < (SELECT max(said_at) FROM turns) - 600 AS expired
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY said_at DESC, turn DESC) AS recency FROM turns WHERE said_at >= now - 1800) r WHERE recency <= 8""")
def _(lake):
    spark, folder, sink = lake.spark, scratch_path(lake.spark, "turns"), scratch_path(lake.spark, "memory")
    rows = lake.table("conversations").select(F.col("conv_id").alias("session_id"), "turn", "role", "text", (F.lit(1_704_067_200) + F.col("turn") * 300).alias("said_at"))
    rows.withColumn("part", F.floor(F.col("turn") / 4)).repartition("part").write.partitionBy("part").parquet(f"{folder}/all")
    parts = [r["part"] for r in spark.read.parquet(f"{folder}/all").select("part").distinct().orderBy("part").collect()]  # a few numbers
    schema = rows.schema
    with disk_state(spark):
        for part in parts:  # each arrival is worked off from the checkpoint of the one before
            spark.read.schema(schema).parquet(f"{folder}/all/part={part}").write.parquet(f"{folder}/arrived/part={part}")
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/arrived")
            jobs.drain(memory.remembered(stream), sink)
    states = spark.read.schema(memory.MEMORY).parquet(f"{sink}/data")
    return memory.last_memory(states).select("session_id", "turn", "recency", "expired")


@query("T6_drift_per_batch", _DRIFT)
def _(lake):
    """Log lines in three arrivals, one file a batch; each arrival restarts the stream from its checkpoint."""
    spark, lines, path = lake.spark, scratch_path(lake.spark, "lines"), scratch_path(lake.spark, "drift")
    log = prediction_log(lake)
    for arrival in range(3):
        log.where(F.pmod(F.xxhash64("value"), F.lit(3)) == arrival).write.mode("append").text(lines)
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(lines)
        each_batch(stream, path, drift.drift_sink(path))
    return drift_rounded(drift.drift_report(spark, path))


@query("T6_drift_after_ingestion", _DRIFT)
def _(lake):
    spark = lake.spark
    lines, landed = scratch_path(spark, "lines"), scratch_path(spark, "landed")
    prediction_log(lake).write.text(lines)
    jobs.drain(spark.readStream.text(lines), landed)
    return drift_rounded(monitoring.prediction_drift(monitoring.parse_log(spark.read.schema("value string").parquet(f"{landed}/data"))))


_SEEN = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events WHERE ts >= TIMESTAMP '2024-01-11')"


@query("T7_late_rows_dropped", f"""
SELECT event_type AS domain, count(*) AS counted, count(DISTINCT w) AS windows,
  (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-11' AND time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= {_SEEN}) AS dropped_total
FROM (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS w FROM events WHERE ts >= TIMESTAMP '2024-01-11') WHERE w + INTERVAL 5 MINUTE <= {_SEEN} GROUP BY 1""")
def _(lake):
    events = lake.table("events")
    edge = F.lit("2024-01-11").cast("timestamp_ntz")
    late = events.where(F.col("ts") < edge)
    return jobs.late_data(events.where(F.col("ts") >= edge), late.where("event_id % 2 = 0"), late.where("event_id % 2 = 1"))
