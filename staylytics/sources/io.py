"""File sources and sinks: strict CSV, logs, reports, paired and versioned outputs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics import constants as C
from staylytics.session import settle, store

_TEXT = {*C.CATEGORICAL_COLUMNS, "arrival_date_month", "agent", "company", "reservation_status_date"}


def _raw_type(column: str) -> T.DataType:
    if column in _TEXT:
        return T.StringType()
    return T.DoubleType() if column == "adr" else T.LongType()


class SchemaMismatch(ValueError):
    """The file's columns differ from the contract."""


def read_raw_bookings(spark: SparkSession, path: str) -> DataFrame:
    """Booking CSV with exactly the contracted columns, in any order; only the header is read for the check."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in C.RAW_COLUMNS if c not in header]
    extra = [c for c in header if c not in C.RAW_COLUMNS]
    if missing or extra:
        raise SchemaMismatch(f"missing columns: {missing}; unexpected columns: {extra}")
    schema = T.StructType([T.StructField(c, _raw_type(c)) for c in header])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*C.RAW_COLUMNS)


def write_csv(df: DataFrame, path: str) -> None:
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def save_both(df: DataFrame, path: str) -> None:
    """Parquet for engines, CSV for people; the rows are computed once and the CSV is written from the parquet."""
    store(df.write.mode("overwrite"), f"{path}/parquet")
    write_csv(df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet"), f"{path}/csv")


def append_log(df: DataFrame, path: str) -> None:
    """Append records as JSON lines, stamped with the write time, one folder per domain."""
    df.withColumn("_logged_at", F.current_timestamp()).write.mode("append").partitionBy("domain").json(path)


def write_result(df: DataFrame, path: str, module: str) -> None:
    """Append to the module's history and replace its latest result."""
    stamped = df.withColumn("generated_at", F.current_timestamp())
    stamped.write.mode("append").json(f"{path}/history/{module}")
    stamped.write.mode("overwrite").json(f"{path}/latest_{module}.json")


def read_latest_reports(spark: SparkSession, path: str) -> DataFrame:
    """All latest results; the module comes from the file name."""
    module = F.regexp_extract(F.col("_metadata.file_path"), r"latest_([A-Za-z_]+)\.json", 1)
    return spark.read.json(f"{path}/latest_*.json").withColumn("module", module)


def ensure(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once; an existing output is reused."""
    build().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def _part(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def write_keyed(df: DataFrame, path: str, key: list[str], parts: int) -> None:
    """Write a table dealt over ``parts`` folders by a hash of its key, as ``upsert_keyed`` expects it."""
    dealt = df.withColumn("_part", _part(key, parts))
    dealt.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_part")


def upsert_keyed(source: DataFrame, path: str, key: list[str], parts: int) -> list[int]:
    """Insert-or-update ``source`` into a table of ``write_keyed``; returns the folders that were rewritten.

    Only folders that hold a key of ``source`` are read and replaced. Their new content is written aside first; then the
    folders are swapped by a dynamic partition overwrite, so a failure before that leaves the table as it was. Keys are unique
    in ``source``; null is a key like any other.
    """
    spark = source.sparkSession
    stored = spark.read.parquet(path)
    arrived = settle(source.select(*[c for c in stored.columns if c != "_part"]).withColumn("_part", _part(key, parts)))
    touched = sorted(r["_part"] for r in arrived.select("_part").distinct().collect())  # ``parts`` numbers at most
    old = stored.where(F.col("_part").isin(touched))
    same = reduce(and_, [old[c].eqNullSafe(arrived[c]) for c in ("_part", *key)])
    staged = settle(old.join(arrived, same, "left_anti").unionByName(arrived))
    staged.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)
    return touched


class MissingTable(RuntimeError):
    """A write or read names a table that does not exist."""


def require_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"table {name} does not exist")
    return spark.table(name)
