"""Row-positional window expressions. Meant for day-grain frames, where a partition is bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order)


def trailing_mean(c: str, n: int, keys: list[str], order: str) -> Column:
    """Mean of the n rows before the current one (at least one observation)."""
    return F.avg(c).over(ordered(keys, order).rowsBetween(-n, -1))


def add_lags(df: DataFrame, c: str, lags: list[int], keys: list[str], order: str) -> DataFrame:
    w = ordered(keys, order)
    return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for n in lags})


def add_trailing_means(df: DataFrame, c: str, sizes: list[int], keys: list[str], order: str) -> DataFrame:
    return df.withColumns({f"{c}_rolling_mean_{n}": trailing_mean(c, n, keys, order) for n in sizes})


def fill_forward_then_back(df: DataFrame, columns: list[str], keys: list[str], order: str) -> DataFrame:
    w = ordered(keys, order)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.first(c, ignorenulls=True).over(after))
        for c in columns
    })


def chronological_split(df: DataFrame, keys: list[str], order: str, test_share: float = 0.2) -> DataFrame:
    """Mark the first (1 - test_share) of each group's rows, by position, as the training part."""
    w = ordered(keys, order)
    size = F.count("*").over(Window.partitionBy(*keys))
    train = F.row_number().over(w) <= F.floor(size * F.lit(1 - test_share))
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def latest_rows(df: DataFrame, keys: list[str], order: str, n: int = 1) -> DataFrame:
    """The last n rows per group with ``recency`` 1..n; the rank limit is applied map-side before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)
