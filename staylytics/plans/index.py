"""Document index as tables: full build, incremental refresh, and rendering of rows as documents."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.operators.chunking import chunk_rows, chunk_text
from staylytics.operators.retrieval import manifest_diff


def row_text(columns: list[str]) -> Column:
    """``col=value`` pairs of one row."""
    return F.concat_ws(", ", *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in columns
    ])


# Sentence template per mart: pieces alternate between text and column names.
MART_SENTENCES = {
    "mart_occupancy_daily": ("Branch ", "branch_id", " occupancy on ", "date", " was ", "occupancy_pct", "% (",
                             "occupied_rooms", "/", "total_rooms", " rooms occupied)."),
    "mart_revenue_daily": ("Branch ", "branch_id", " total revenue on ", "date", " was ", "total_revenue", " (RevPAR ",
                           "revpar", ", ADR ", "avg_daily_rate", ")."),
    "mart_restaurant_daily": ("Branch ", "branch_id", " restaurant revenue on ", "date", " was ", "total_revenue",
                              " across ", "total_orders", " orders (avg order value ", "avg_order_value", ")."),
    "mart_staff_daily": ("Branch ", "branch_id", " ", "department_name", " on ", "date", " had ", "present_employees", "/",
                         "scheduled_employees", " staff present (", "attendance_rate_pct", "% attendance)."),
}


def mart_sentence(name: str) -> Column:
    pieces = MART_SENTENCES[name]
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.col(p).cast("string") for i, p in enumerate(pieces)])


def mart_documents(mart: DataFrame, name: str, max_rows: int | None = None) -> DataFrame:
    """The rows of a mart as sentences with metadata; with ``max_rows`` only the newest."""
    tie = [c for c in ("branch_id", "department_name") if c in mart.columns]
    newest = mart if max_rows is None else mart.orderBy(F.desc("date"), *tie).limit(max_rows)
    metadata = F.create_map(
        F.lit("source"), F.lit(name), F.lit("doc_type"), F.lit("warehouse"), F.lit("branch_id"),
        F.col("branch_id").cast("string"), F.lit("date"), F.col("date").cast("string"),
    )
    path = F.concat_ws("/", F.lit(name), F.col("date").cast("string"), *[F.col(c).cast("string") for c in tie])
    return newest.select(path.alias("path"), mart_sentence(name).alias("text"), metadata.alias("metadata"))


def forecast_documents(forecast: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit("Occupancy forecast for branch "), F.col("branch_id").cast("string"), F.lit(" on "),
        F.col("occupancy_date").cast("string"), F.lit(": "), F.col("predicted_occupancy_pct").cast("string"),
        F.lit("% (range "), F.col("ci_lower").cast("string"), F.lit("-"), F.col("ci_upper").cast("string"),
        F.lit("%, model "), F.col("model_used"), F.lit(")."),
    )
    metadata = F.create_map(
        F.lit("source"), F.lit("predict_occupancy"), F.lit("doc_type"), F.lit("prediction"), F.lit("branch_id"),
        F.col("branch_id").cast("string"),
    )
    path = F.concat_ws("/", F.lit("forecast"), F.col("branch_id").cast("string"), F.col("occupancy_date").cast("string"))
    return forecast.select(path.alias("path"), text.alias("text"), metadata.alias("metadata"))


def documents(table: DataFrame) -> DataFrame:
    metadata = F.create_map(F.lit("source"), F.col("source"), F.lit("doc_type"), F.lit("txt"), F.lit("branch_id"), F.col("lang"))
    return table.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"), "text", metadata.alias("metadata"))


def write_text_files(docs: DataFrame, folder: str) -> None:
    """Every row (file, text) as a text file of its own below ``folder``, ended by a newline; a null text has no file.

    Tasks write to a folder that all of them can open by themselves; elsewhere Spark's writer makes a folder per file.
    """
    docs = docs.where("text IS NOT NULL").select("file", F.col("text").cast("binary").alias("text"))
    place = local_folder(docs.sparkSession, folder)
    if place is None:
        texts = docs.select("file", F.col("text").cast("string").alias("text")).repartition("file")
        return texts.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2).partitionBy("file").text(folder)
    os.makedirs(place, exist_ok=True)
    folders = max(1, docs.count() // FILES_READ)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # a task that runs again finds the same folders and replaces the same files
                parent = f"{place}/{zlib.crc32(name.encode()) % folders}"
                target, part = f"{parent}/file={name}.txt", f"{parent}/.{uuid.uuid4().hex}"
                try:
                    out = open(part, "wb")
                except FileNotFoundError:
                    os.makedirs(parent, exist_ok=True)
                    out = open(part, "wb")
                with out:
                    out.write(text.as_py())
                    out.write(b"\n")
                os.replace(part, target)
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["files"])

    docs.mapInArrow(write, "files long").agg(F.sum("files")).first()


def local_folder(spark: SparkSession, folder: str) -> str | None:
    """Where tasks can open ``folder`` without Hadoop; none for stores that only Spark reaches, and for patterns."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" and not re.search(r"[*?\[{,]", folder) else None


_ESCAPED = re.compile(r'[\x00-\x20"#%<>?\[\]\\^`{|}\x7f]')  # what Spark escapes in the path of a file


def _shown(name: str) -> bool:
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _read_files(suffix: str, most: int = 16_000_000):
    """(folder, part, parts): the files of a part of a folder as (path, text), empty ones left out; about ``most`` bytes are held."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, part, parts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                paths, texts, held = [], [], 0
                with os.scandir(folder) as entries:
                    names = [e.name for e in entries if e.name.endswith(suffix) and _shown(e.name) and zlib.crc32(os.fsencode(e.name)) % parts == part and e.is_file()]
                for name in names:
                    with open(f"{folder}/{name}", "rb") as file:
                        text = file.read()
                    if not text:
                        continue
                    paths.append("file:" + _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", f"{folder}/{name}"))
                    texts.append(text)
                    held += len(text)
                    if held >= most or len(texts) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.binary())], names=["path", "text"])
                        paths, texts, held = [], [], 0
                if texts:
                    yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(texts, pa.binary())], names=["path", "text"])

    return read


FILES_READ = 1000  # files of one folder that a task reads at once


def scan_text_files(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """Whole text files below a folder with their content hash. Where tasks can open the folder themselves the driver only counts the
    files of each folder in it, and tasks list and read them."""
    place = local_folder(spark, folder)
    if place is None or not os.path.isdir(place):
        files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}").select("value", F.col("_metadata.file_path").alias("path"))
    else:
        rows = []
        for parent, folders, names in os.walk(place, followlinks=True):
            folders[:] = [f for f in folders if _shown(f)]
            parts = -(-sum(n.endswith(suffix) for n in names) // FILES_READ)
            rows.extend((parent, i, parts) for i in range(parts))
        width = min(max(len(rows), 1), max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(rows) // 20))
        dealt = spark.sparkContext.parallelize(rows, width).toDF("folder string, part int, parts int")
        found = dealt.mapInArrow(_read_files(suffix), "path string, text binary")
        files = found.select("path", F.col("text").cast("string").alias("value"))
    metadata = F.create_map(F.lit("source"), F.col("path"), F.lit("doc_type"), F.lit(suffix.lstrip(".")))
    return files.select("path", F.col("value").alias("text"), metadata.alias("metadata"), F.sha2("value", 256).alias("hash"))


def manifest(docs: DataFrame) -> DataFrame:
    return docs.select("path", F.sha2("text", 256).alias("hash"))


def chunks(docs: DataFrame) -> DataFrame:
    return chunk_rows(chunk_text(docs, "text"), "path")


def build(path: str, static: DataFrame, snapshots: list[DataFrame]) -> None:
    """Write the chunk table and the manifest. Snapshot documents are always regenerated and not in the manifest."""
    everything = reduce(DataFrame.unionByName, [static, *snapshots])
    chunks(everything).write.mode("overwrite").parquet(f"{path}/chunks")
    manifest(static).write.mode("overwrite").parquet(f"{path}/manifest")


def refresh(old: str, new: str, static: DataFrame, snapshots: list[DataFrame]) -> DataFrame:
    """Write a new index version: chunks of unchanged documents are kept, new and changed ones are recomputed, removed
    ones dropped, snapshots replaced. Returns the status of every document."""
    spark = static.sparkSession
    status = manifest_diff(spark.read.parquet(f"{old}/manifest"), manifest(static))
    kept = spark.read.parquet(f"{old}/chunks").join(status.where("status = 'same'").select("path"), "path", "left_semi")
    todo = static.join(status.where("status IN ('new', 'changed')").select("path"), "path", "left_semi")
    fresh = chunks(reduce(DataFrame.unionByName, [todo, *snapshots]))
    kept.unionByName(fresh).write.mode("overwrite").parquet(f"{new}/chunks")
    manifest(static).write.mode("overwrite").parquet(f"{new}/manifest")
    return status
