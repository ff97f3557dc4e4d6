"""Mart catalogue: one logical name per mart, resolved to a builder, a stored table or a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylytics.operators import marts, warehouse
from staylytics.sources.bookings import bookings
from staylytics.sources.lake import Lake

_BUILDERS = {
    "mart_revenue_daily": marts.mart_revenue_daily,
    "mart_occupancy_daily": lambda lake: marts.mart_occupancy_daily(
        marts.daily_occupancy(warehouse.fact_rows(bookings(lake)))
    ),
    "mart_restaurant_daily": marts.mart_restaurant_daily,
    "mart_staff_daily": marts.mart_staff_daily,
}


def list_marts() -> list[str]:
    return sorted(_BUILDERS)


def _known(name: str) -> str:
    if name not in _BUILDERS:
        raise ValueError(f"unknown mart {name}; expected one of {list_marts()}")
    return name


def get_mart(lake: Lake, name: str) -> DataFrame:
    return _BUILDERS[_known(name)](lake)


def stored_mart(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """The mart as a catalogue table or view."""
    df = spark.table(_known(name))
    return df if limit is None else df.limit(limit)


def jdbc_mart(spark: SparkSession, name: str, url: str, limit: int | None = None, **options: str) -> DataFrame:
    """The mart from a database; give partitionColumn, lowerBound, upperBound and numPartitions to read in parallel."""
    df = spark.read.format("jdbc").options(url=url, dbtable=_known(name), **options).load()
    return df if limit is None else df.limit(limit)
