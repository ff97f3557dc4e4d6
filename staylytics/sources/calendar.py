"""Holiday and event calendar over the booking dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.sources.lake import Lake

HOLIDAYS = {(1, 1): "New Year", (5, 1): "Labour Day", (12, 25): "Christmas", (12, 26): "Second Christmas Day"}
LOCAL_EVENT_DAY = 15


SCHEMA = "date date, is_public_holiday int, is_local_event int, event_name string"


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar dimension from CSV with a header; dates are ISO and a malformed line fails the read."""
    options = {"header": True, "enforceSchema": False, "dateFormat": "yyyy-MM-dd", "mode": "FAILFAST"}
    return spark.read.schema(SCHEMA).options(**options).csv(path)


def calendar(lake: Lake) -> DataFrame:
    """One row per ship date with holiday and local-event flags."""
    day = F.col("date")
    days = lake.table("lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    name = F.lit(None).cast("string")
    for (month, dom), label in HOLIDAYS.items():
        name = F.when((F.month(day) == month) & (F.day(day) == dom), label).otherwise(name)
    event = F.day(day) == LOCAL_EVENT_DAY
    return days.select(
        day, name.isNotNull().cast("int").alias("is_public_holiday"), event.cast("int").alias("is_local_event"),
        F.coalesce(name, F.when(event, "Local fair")).alias("event_name"),
    )
