"""Column arithmetic around model outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def risk_level(p: Column) -> Column:
    return F.when(p < 0.3, "Low").when(p < 0.6, "Medium").when(p.isNotNull(), "High")


def confidence(low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - (high - low) / 100)


def price_outputs(df: DataFrame, predicted: str) -> DataFrame:
    """Price floored at zero and the revenue it implies at the given occupancy."""
    price = F.greatest(F.lit(0.0), F.col(predicted))
    return df.withColumns({
        "recommended_price": F.bround(price, 2),
        "expected_revenue": F.bround(price * F.col("occupancy_pct") / 100 * F.col("total_rooms"), 2),
    })


def meal_outputs(df: DataFrame, predicted: str, item_value: str) -> DataFrame:
    """Revenue and the quantity it implies (0 without an item value)."""
    quantity = F.coalesce(F.try_divide(F.col(predicted), F.nullif(F.col(item_value), F.lit(0.0))), F.lit(0.0))
    return df.withColumns({
        "expected_quantity": F.bround(quantity, 1), "expected_revenue": F.bround(predicted, 2),
    })
