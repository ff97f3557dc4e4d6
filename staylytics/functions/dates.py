"""Calendar expressions (weeks start on Monday, Monday is day 0)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.functions.keys import lookup


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def season(day: Column) -> Column:
    return F.element_at(lookup(C.SEASONS), F.month(day))


def period_label(day: Column, grain: str) -> Column:
    """Period text: ISO day, Monday/Sunday pair, or year-month."""
    if grain == "daily":
        return F.date_format(day, "yyyy-MM-dd")
    if grain == "weekly":
        monday = F.date_trunc("week", day).cast("date")
        return F.concat_ws("/", F.date_format(monday, "yyyy-MM-dd"), F.date_format(F.date_add(monday, 6), "yyyy-MM-dd"))
    if grain == "monthly":
        return F.date_format(day, "yyyy-MM")
    raise ValueError(f"unknown grain: {grain}")
