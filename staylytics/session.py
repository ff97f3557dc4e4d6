"""Session construction and the shared scratch location used for lineage cuts and sinks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def get_session(app: str = "staylytics", cores: str | int | None = None) -> SparkSession:
    """Session with UTC time, AQE and a shuffle width taken from the environment.

    On a cluster the master, memory and shuffle width come from spark-submit; nothing here overrides them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if cores is not None:
        builder = builder.master(f"local[{cores}]").config("spark.ui.enabled", "false")
        # small inputs are cut in as many splits as there are cores
        builder = builder.config("spark.sql.files.minPartitionNum", str(cores))
        builder = builder.config("spark.sql.shuffle.partitions", os.environ.get("STAY_SHUFFLE_PARTITIONS", str(cores)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine find the package where the driver found it; a cluster gets it by --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    return spark


_local_scratch: dict[str, str] = {}
_made: dict[str, list[str]] = {}  # paths handed out, by application


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temp folder only for local masters."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = folder = tempfile.mkdtemp(prefix="staylytics-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete every scratch path of this application; call it when the results of a job have been written or read."""
    context = spark.sparkContext
    for name in _made.pop(context.applicationId, []):
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_lock = threading.Lock()
_writing: dict[str, tuple[int, str | None]] = {}  # writes under way, and the option as it was before, by application
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; they would stay until the driver's next collection of garbage.

    A write plans its frame anew, so nothing reads them again. Jobs side by side share the session: the last one out puts it back.
    """
    name = spark.sparkContext.applicationId
    with _lock:
        running, before = _writing.get(name) or (0, spark.conf.get(_FREED, None))
        _writing[name] = running + 1, before
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writing[name]
            if running > 1:
                _writing[name] = running - 1, before
            else:
                del _writing[name]
                spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def store(writer: DataFrameWriter, path: str) -> None:
    """Write parquet at ``path``; the shuffle files of the write go with it."""
    with freed(writer._spark):
        writer.parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage so that later readers agree on row placement after executor loss, and lets each of them read only the
    columns it needs. Unlike a checkpoint the plan is evaluated once, not twice.
    """
    path = scratch_path(df.sparkSession, "settled")
    store(df.write, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def discard(settled: DataFrame) -> None:
    """Delete the files of a frame from ``settle`` that nothing reads any more, before the job ends."""
    context, name = settled.sparkSession.sparkContext, settled._settled_at
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    if name in _made.get(context.applicationId, []):
        _made[context.applicationId].remove(name)


@contextmanager
def options(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session options for queries started inside, put back afterwards; a stream keeps those it was started with."""
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
