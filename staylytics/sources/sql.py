"""Parameterised SQL text over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_query(spark: SparkSession, text: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters (bound, never formatted in) and ``{name}`` DataFrame references."""
    return spark.sql(text, args=params or {}, **frames)


def run_query_file(spark: SparkSession, path: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """The same for a file in any store that Spark reads."""
    return run_query(spark, spark.read.text(path, wholetext=True).first()[0], params, **frames)
