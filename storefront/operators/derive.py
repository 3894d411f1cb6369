"""Derived columns of the product listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def product(a: str, b: str) -> Column:
    """Price times quantity, rating times number of ratings."""
    return F.col(a) * F.col(b)


def add_totals(df: DataFrame, price: str = "initial_price", quantity: int = 1) -> DataFrame:
    """A constant quantity and the total amount at that quantity."""
    return df.withColumn("quantity", F.lit(quantity)).withColumn("total_amount", product(price, "quantity"))


def add_features(df: DataFrame) -> DataFrame:
    """Price difference and popularity score; prices must be numbers by now."""
    return df.withColumns(
        {
            "price_difference": F.col("initial_price") - F.col("final_price"),
            "popularity_score": product("rating", "ratings_count"),
        }
    )
