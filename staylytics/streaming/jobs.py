"""Structured Streaming jobs over files: ingestion, windowed panels, sessions, deduplication, late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from staylytics.operators.joins import null_safe_join
from staylytics.operators.ordering import with_running_totals
from staylytics.session import scratch_path, settle
from staylytics.streaming.sinks import batches, counting_late_rows, disk_state, each_batch, options, write_batch

DELAY = "10 minutes"
SESSION_GAP = "30 minutes"
FILES_A_BATCH = 256  # a backlog is worked off in batches of so many files
_MERGED = {"spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition": "true"}


def file_stream(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Stream of the parquet tables in a folder that match a name pattern, each a file or a folder of files; the schema comes
    from those files."""
    tables = f"{folder}/{pattern}"
    schema = spark.read.parquet(tables).schema
    found = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", FILES_A_BATCH)
    return found.parquet(tables)


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    """Events with a zoned event time and the watermark set."""
    raw = file_stream(spark, folder, pattern)
    return with_event_time(raw).withWatermark("ts", DELAY)


def with_event_time(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", F.col("event_type").alias("domain"), "value"
    )


def drain(df: DataFrame, path: str) -> StreamingQuery:
    """Process everything available into parquet below ``path`` and stop; a later call continues from there."""
    query = (
        df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/data").start()
    )
    query.awaitTermination()
    return query


def drained(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    drain(df, path)
    return spark.read.schema(df.schema).parquet(f"{path}/data")


# Each shape below works on a stream and on a batch frame alike.


def event_rate(events: DataFrame) -> DataFrame:
    """Events per second and domain over five-minute windows that slide by one minute."""
    span = F.window("ts", "5 minutes", "1 minute")
    return events.groupBy(span, "domain").agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("window_start"), "domain", "n", (F.col("n") / 300).alias("per_second")
    )


def latency_histogram(events: DataFrame) -> DataFrame:
    """Count of each distinct value per domain and five-minute window; histograms of a window can be added up."""
    counts = events.groupBy(F.window("ts", "5 minutes"), "domain", "value").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "domain", "value", "n")


def histogram_p95(histogram: DataFrame) -> DataFrame:
    """The exact 95th percentile per window and domain: the smallest value that 95 % of the rows do not exceed."""
    keys = ["window_start", "domain"]
    running = with_running_totals(histogram.where("value IS NOT NULL"), keys, ["value"], {"upto": F.col("n")})
    sizes = histogram.groupBy(*keys).agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("valued"))
    reached = F.when(F.col("upto") >= F.ceil(F.col("valued") * 0.95), F.col("value"))
    return null_safe_join(sizes, running, keys, "left").groupBy(*keys, F.col("rows").alias("n")).agg(F.min(reached).alias("p95"))


def sessions(events: DataFrame) -> DataFrame:
    """Activity sessions per user: closed after 30 minutes without an event. Sessions are merged before the shuffle, so a
    very active user sends few rows, if the query runs with ``merged_sessions``."""
    return events.groupBy(F.session_window("ts", SESSION_GAP), "user_id").agg(F.count("*").alias("n")).select(
        "user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n"
    )


def merged_sessions(spark: SparkSession):
    """Options under which a stream of ``sessions`` merges before its shuffle."""
    return options(spark, **_MERGED)


def _gap_ids(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col(start) > reach + F.expr(f"INTERVAL {SESSION_GAP}")).cast("int")
    return df.withColumn("_s", F.sum(F.coalesce(opens, F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def batch_sessions(events: DataFrame) -> DataFrame:
    """The same sessions in batch, balanced for very active users.

    Rows are placed by (user, time), so a user's events spread over many slices, and sessionized inside each. Only the
    first and the last session of a user in a slice can go on in another one; these, at most two for each slice
    that a user reaches into, are joined across the borders.
    """
    placed = settle(events.select("user_id", "ts").repartitionByRange("user_id", "ts").withColumn("_slice", F.spark_partition_id()))
    keys = ["_slice", "user_id"]
    partial = _gap_ids(placed, keys, "ts", "ts").groupBy(*keys, "_s").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n")
    )
    newest = F.max("_s").over(Window.partitionBy(*keys))
    partial = settle(partial.withColumn("edge", (F.col("_s") == 0) | (F.col("_s") == newest)).drop("_s"))
    whole = _gap_ids(partial.where("edge"), ["user_id"], "first", "last").groupBy("user_id", "_s").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")
    )
    both = whole.select("user_id", "first", "last", "n").union(partial.where("NOT edge").select("user_id", "first", "last", "n"))
    return both.select(
        "user_id", F.col("first").alias("session_start"), (F.col("last") + F.expr(f"INTERVAL {SESSION_GAP}")).alias("session_end"), "n"
    )


_SEEN = "hash string"


def dedupe_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writer of micro-batches of documents (text): adds the content hashes that no earlier batch has, each once.

    The hashes seen are a table, not operator state, so they neither age nor fill executors. A replay of a batch compares with
    earlier batches only and writes the same rows again.
    """

    def write(docs: DataFrame, batch_id: int) -> None:
        arrived = docs.select(F.sha2("text", 256).alias("hash")).distinct()
        before = batches(docs.sparkSession, path, _SEEN + ", batch int").where(F.col("batch") < batch_id)
        write_batch(arrived.join(before, arrived["hash"].eqNullSafe(before["hash"]), "left_anti"), path, batch_id)

    return write


def distinct_documents(docs: DataFrame, label: str = "dedupe") -> DataFrame:
    """First arrival per content hash of everything that a stream of documents has."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, label)
    each_batch(docs, path, dedupe_sink(f"{path}/seen"))
    return batches(spark, f"{path}/seen", _SEEN).select("hash")


def late_data(*arrivals: DataFrame) -> DataFrame:
    """Feed events to one checkpointed count, one arrival after another; late rows change nothing but a counter.

    A row is late if the watermark had closed its window when it came. Rows pass a per-row state with their place in the
    input as key, which holds a window's rows until the window closes; there Spark counts each late row by itself (behind an
    aggregate it would count groups), and ``sinks.LateRows`` adds the counts up.
    """
    spark = arrivals[0].sparkSession
    folder, sink = scratch_path(spark, "arrivals"), scratch_path(spark, "counts")
    columns = ["event_id", "ts", "user_id", "event_type", "value"]

    def counts(schema) -> DataFrame:
        raw = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
        place = F.struct("_metadata.file_path", "_metadata.row_index").alias("place")
        timed = raw.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("domain"), place).withWatermark("ts", DELAY)
        once = timed.withColumn("window", F.window("ts", "5 minutes")).dropDuplicates(["window", "place"])
        return once.groupBy("window", "domain").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "domain", "n")

    with disk_state(spark), counting_late_rows(spark) as late:
        for k, arrival in enumerate(arrivals):
            arrival.select(*columns).write.parquet(f"{folder}/arrival={k}")
            drain(counts(spark.read.parquet(f"{folder}/arrival=0").schema), sink)
    result = spark.read.schema("window_start timestamp, domain string, n long").parquet(f"{sink}/data")
    return result.groupBy("domain").agg(F.sum("n").alias("counted"), F.count("*").alias("windows")).withColumn("dropped_total", F.lit(late.dropped).cast("long"))
