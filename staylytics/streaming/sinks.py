"""Sinks that survive replays: what a micro-batch writes lies under its own number, so writing it again replaces it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from staylytics.session import options

DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def disk_state(spark: SparkSession):
    """Keyed state lives on the executors' disks, not in their heaps."""
    return options(spark, spark__sql__streaming__stateStore__providerClass=DISK_STATE)


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Write one micro-batch below ``folder``; a replay of the batch replaces what an earlier try left."""
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def batches(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All batches written below ``folder``, with their number as ``batch``; none yet gives an empty table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def each_batch(stream: DataFrame, path: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Hand everything available to ``write`` batch by batch and stop; a later call goes on from the checkpoint."""
    query = (
        stream.writeStream.foreachBatch(write).outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", f"{path}/checkpoint").start()
    )
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Adds up the rows that stateful operators dropped as late, over all batches and restarts of the queries that run."""

    def __init__(self) -> None:
        self.dropped = 0
        self.ended = Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        self.dropped += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


@contextmanager
def counting_late_rows(spark: SparkSession) -> Iterator[LateRows]:
    """Count late rows of the streams run inside; progress reaches the listener a little after a query has ended."""
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
        listener.ended.wait(60)
    finally:
        spark.streams.removeListener(listener)
