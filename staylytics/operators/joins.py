"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylytics.session import settle

HOT_SHARE = 1000  # a key is hot above 1/1000 of the rows, so at most 1000 keys can be hot


def parts_of(spark: SparkSession, amount: int | None, each: int) -> int | None:
    """Parts of ``each``, where the width of a shuffle would give larger ones."""
    needed = -(-(amount or 0) // each)
    return needed if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def placed(df: DataFrame, parts: int | None, *columns: str) -> DataFrame:
    """Rows dealt over ``parts`` by the columns, or over as many as the session shuffles into."""
    return df.repartition(*columns) if parts is None else df.repartition(parts, *columns)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which NULL keys are equal; the result has the columns of both sides, keys once (from ``left``)."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys]
    return left.join(named, same, how).drop(*[f"_right_{k}" for k in keys])


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``left`` to a ``right`` that is unique on ``key``.

    Rows of hot keys meet a broadcast of at most ``HOT_SHARE`` right rows and never shuffle; the rest is an ordinary
    shuffle join. Rows with a NULL key match nothing and are not shuffled either. ``left`` is written once and read per
    part.
    """
    left = settle(left)
    counts = left.groupBy(key).agg(F.count("*").alias("_n"))
    total = left.agg(F.count("*")).scalar()
    hot = counts.where(F.col("_n") * HOT_SHARE > total).select(key, F.lit(True).alias("_hot"))
    marked = left.join(F.broadcast(hot), key, "left")
    few = right.join(F.broadcast(hot.select(key)), key, "left_semi")
    busy = marked.where("_hot").drop("_hot").join(F.broadcast(few), key, how)
    calm = marked.where(F.col("_hot").isNull() & F.col(key).isNotNull()).drop("_hot").join(right, key, how)
    if how != "left":
        return busy.unionByName(calm)
    return busy.unionByName(calm).unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: str, salts: int = 16) -> DataFrame:
    """Inner equi-join with the left rows of one key spread over ``salts`` tasks; the right side is repeated per salt."""
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")
