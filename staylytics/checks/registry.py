"""Registry of named queries and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylytics.sources.lake import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so both engines return the same Python values."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(key: str, sql: str | None = None):
    """Register ``fn(lake) -> DataFrame`` under ``key``; ``sql`` may use the shared views by name."""

    def wrap(fn: Callable[[Lake], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = lambda spark, root: portable(fn(Lake(spark, root)))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap
