"""Exploding computed arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """One row per non-null element, beside the ``keep`` columns.

    ``explode`` makes the optimizer add a ``size(array) > 0`` filter below it, which evaluates an expensive array
    expression a second time (or more, when its inputs get inlined). The outer form with a filter on the element does
    not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
