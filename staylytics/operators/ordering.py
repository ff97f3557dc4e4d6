"""Positions, running totals and exact quantiles over orders too large for one window partition.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. These helpers range-partition on
(key, order) instead, so a key holding a third of the rows is spread over a third of the tasks, and carry
per-slice totals across slices. The placed rows are written to the shared folder first because both passes must see them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylytics.operators.joins import null_safe_join
from staylytics.session import settle

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position within its partition in the low 33 bits


def with_global_index(df: DataFrame, order: Sequence[str], name: str = "row_index", drop: Sequence[str] = ()) -> DataFrame:
    """Zero-based position of every row in the total order ``order``; one range shuffle, no single-task window. Columns to ``drop``
    serve the order only and are not stored."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ordered.withColumn("_id", F.monotonically_increasing_id()).drop(*drop))
    placed = placed.withColumn("_slice", F.shiftright("_id", _ROW_BITS)).withColumn(
        "_pos", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition, so the unpartitioned window and the broadcast are bounded by the shuffle width.
    offsets = (
        placed.groupBy("_slice")
        .agg((F.max("_pos") + 1).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, (F.col("_pos") + F.col("_offset")).cast("long"))
        .drop("_id", "_slice", "_pos", "_offset")
    )


def with_running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column], parts: int | None = None
) -> DataFrame:
    """Inclusive running sums per key in ``order``, a total order within a key; NULL is a key like any other. ``parts`` slices, or as
    many as the session shuffles into.

    Placed by range, a key can reach over a slice border; only then do rows need a carry. Each slice has at most one
    such key, so the carries are at most as many as the slices and are broadcast.
    """
    keys = list(keys)
    by = [*keys, *order] if parts is None else [parts, *keys, *order]
    placed = settle(df.repartitionByRange(*by).withColumn("_slice", F.spark_partition_id()))
    upto = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(c).over(upto).alias(n) for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per (slice, key): the carry window sees no more rows per key than there are slices.
    carried = (
        placed.groupBy("_slice", *keys)
        .agg(*[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()])
        .select("_slice", *keys, F.row_number().over(Window.partitionBy(*keys).orderBy("_slice")).alias("_part"),
                *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in totals])
        .where("_part > 1").drop("_part")
    )
    out = null_safe_join(local, F.broadcast(carried), ["_slice", *keys], "left")
    return out.select(*df.columns, *[(F.col(n) + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in totals])


def exact_quantile(df: DataFrame, value: str, q: float, keys: Sequence[str] = (), name: str = "quantile") -> DataFrame:
    """Exact linearly interpolated quantile per key, from a distinct-value histogram.

    Unlike ``percentile`` the histogram is never merged into one task: equal values collapse map-side and the
    cumulative counts come from range-partitioned running totals.
    """
    keys = list(keys)
    hist = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    ranked = with_running_totals(hist, keys, ["_v"], {"_cum": F.col("_n")})
    size = ranked.groupBy(*keys).agg(F.max("_cum").alias("_size"))
    ranked = null_safe_join(ranked, size, keys) if keys else ranked.withColumn("_size", size.scalar())
    place = (F.col("_size") - 1) * F.lit(float(q))
    return (
        ranked.withColumn("_place", place)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("_cum") > F.floor("_place"), F.col("_v"))).alias("_lo"),
            F.min(F.when(F.col("_cum") > F.ceil("_place"), F.col("_v"))).alias("_hi"),
            F.max(F.col("_place") - F.floor("_place")).alias("_frac"),
        )
        .select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias(name))
    )
