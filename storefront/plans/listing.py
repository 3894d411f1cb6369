"""The product listing, derived from line items and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.functions.money import money
from storefront.functions.money import parse_currency
from storefront.operators.clean import drop_duplicates, fill_missing
from storefront.operators.derive import add_features, add_totals
from storefront.sources.tables import load


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, dressed as an offer of its part."""
    share = F.col("l_discount").cast("decimal(4,2)")
    price = money("l_extendedprice")
    final = money(F.round(price * (F.lit(1) - share), 2))
    offers = load(spark, folder, "lineitem").join(
        load(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return offers.select(
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("category"),
        (share * 50).cast("decimal(4,2)").alias("rating"),
        F.col("l_quantity").cast("bigint").alias("ratings_count"),
        price.alias("initial_price"),
        final.alias("final_price"),
        F.concat(F.lit('"₹'), F.format_number(final, 2), F.lit('"')).alias("final_price_raw"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("discount"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("seller_name"),
    )


LISTING_SQL = """
WITH listing AS (
  SELECT l_partkey AS product_id, p_name AS title, p_brand AS category,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 50 AS DECIMAL(4,2)) AS rating,
         CAST(l_quantity AS BIGINT) AS ratings_count,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS initial_price,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS final_price,
         NULLIF(l_tax, 0) AS discount,
         NULLIF(l_returnflag, 'N') AS seller_name
  FROM lineitem JOIN part ON l_partkey = p_partkey
)
"""


def clean_listing(df: DataFrame, texts: tuple[str, ...]) -> DataFrame:
    """Missing values filled, copies dropped, quantity and total added.

    Prices in text form stay as they are; this is the state that is saved as CSV.
    """
    filled = fill_missing(df, numbers=["discount"], texts=texts)
    return add_totals(drop_duplicates(filled))


def featured_listing(cleaned: DataFrame, price_text: str = "final_price") -> DataFrame:
    """The cleaned listing with its price text as a number and the derived features."""
    return add_features(cleaned.withColumn("final_price", parse_currency(price_text)))
