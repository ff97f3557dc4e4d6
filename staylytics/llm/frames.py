"""Expressions over all columns of a frame, whatever their names and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; columns that hold maps, which Spark neither hashes nor compares, count as their JSON."""
    mapped = [any(word in kind for word in ("map<", "variant")) for _, kind in df.dtypes]
    return F.xxhash64(*[F.to_json(F.struct(c.alias("c"))) if m else c for c, m in zip(all_columns(df), mapped, strict=True)])
