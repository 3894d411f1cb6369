"""Queries over the product listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.functions.bands import RATING_LABELS, range_label
from storefront.functions.missing import nan_to_null
from storefront.functions.money import parse_currency
from storefront.operators import aggregate, clean, derive, distribution, profile, stats
from storefront.plans.listing import LISTING_SQL, clean_listing, featured_listing, listing
from storefront.plans.registry import query

MEASURES = ("rating", "ratings_count", "initial_price", "final_price", "discount")


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("shape", LISTING_SQL + "SELECT count(*) AS n_rows, 10 AS n_columns FROM listing")
def shape(spark, folder):
    return profile.shape(listing(spark, folder))


PROFILED = {
    "product_id": "bigint", "title": "string", "category": "string", "rating": "decimal(4,2)",
    "ratings_count": "bigint", "initial_price": "decimal(12,2)", "final_price": "decimal(12,2)",
    "final_price_raw": "string", "discount": "double", "seller_name": "string",
}
# The SQL has the price text only as the number that it is made from.
_IN_SQL = {"final_price_raw": "final_price"}


@query(
    "column_profile",
    LISTING_SQL
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{dtype}' AS dtype, "
        f"count({_IN_SQL.get(c, c)}) AS non_null, count(*) - count({_IN_SQL.get(c, c)}) AS missing FROM listing"
        for i, (c, dtype) in enumerate(PROFILED.items())
    ),
)
def column_profile(spark, folder):
    return profile.column_profile(listing(spark, folder))


def _describe_sql(*columns: str) -> str:
    return LISTING_SQL + " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count({c}) AS "count",
               round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
               round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
               min(CAST({c} AS DOUBLE)) AS "min",
               round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
               max(CAST({c} AS DOUBLE)) AS "max"
        FROM listing
        """
        for c in columns
    )


@query("describe_numeric", _describe_sql(*MEASURES))
def describe_numeric(spark, folder):
    described = distribution.describe(listing(spark, folder), MEASURES)
    return _rounded(described, 4, "mean", "std", "q25", "q50", "q75")


@query("describe_one", _describe_sql("final_price"))
def describe_one(spark, folder):
    described = distribution.describe(listing(spark, folder), ["final_price"])
    return _rounded(described, 4, "mean", "std", "q25", "q50", "q75")


@query(
    "value_counts",
    LISTING_SQL
    + "SELECT category, count(*) AS n_rows FROM listing WHERE category IS NOT NULL "
    "GROUP BY category ORDER BY n_rows DESC, category",
)
def value_counts(spark, folder):
    return profile.value_counts(listing(spark, folder), "category")


@query("fill_numeric", LISTING_SQL + "SELECT product_id, coalesce(discount, 0) AS discount FROM listing")
def fill_numeric(spark, folder):
    offers = listing(spark, folder).select("product_id", "discount")
    return clean.fill_missing(offers, numbers=["discount"])


@query(
    "fill_text",
    LISTING_SQL + "SELECT product_id, coalesce(seller_name, 'Not Available') AS seller_name FROM listing",
)
def fill_text(spark, folder):
    offers = listing(spark, folder).select("product_id", "seller_name")
    return clean.fill_missing(offers, texts=["seller_name"])


@query(
    "parse_currency",
    LISTING_SQL + "SELECT product_id, CAST(final_price AS DOUBLE) AS final_price FROM listing",
)
def parse_currency_text(spark, folder):
    return listing(spark, folder).select("product_id", parse_currency("final_price_raw").alias("final_price"))


@query(
    "derived_total",
    LISTING_SQL
    + "SELECT title, CAST(initial_price AS DOUBLE) AS initial_price, 1 AS quantity, "
    "CAST(initial_price * 1 AS DOUBLE) AS total_amount FROM listing",
)
def derived_total(spark, folder):
    totals = derive.add_totals(listing(spark, folder))
    wanted = totals.select("title", "initial_price", "quantity", "total_amount")
    return _doubles(wanted, "initial_price", "total_amount")


@query(
    "price_difference",
    LISTING_SQL
    + "SELECT title, CAST(initial_price - final_price AS DOUBLE) AS price_difference FROM listing",
)
def price_difference(spark, folder):
    features = derive.add_features(listing(spark, folder))
    return _doubles(features.select("title", "price_difference"), "price_difference")


@query(
    "popularity",
    LISTING_SQL
    + "SELECT title, CAST(rating * CAST(ratings_count AS INTEGER) AS DOUBLE) AS popularity_score FROM listing",
)
def popularity(spark, folder):
    features = derive.add_features(listing(spark, folder))
    return _doubles(features.select("title", "popularity_score"), "popularity_score")


_BAND_SQL = """
  CASE WHEN rating > 0 AND rating <= 2 THEN '0-2' WHEN rating > 2 AND rating <= 3 THEN '2-3'
       WHEN rating > 3 AND rating <= 4 THEN '3-4' WHEN rating > 4 AND rating <= 5 THEN '4-5' END
"""


@query(
    "rating_bins",
    LISTING_SQL
    + f"SELECT product_id, CAST(rating AS DOUBLE) AS rating, {_BAND_SQL} AS rating_group FROM listing",
)
def rating_bins(spark, folder):
    grouped = listing(spark, folder).select(
        "product_id", "rating", range_label("rating").alias("rating_group")
    )
    return _doubles(grouped, "rating")


@query(
    "mean_by_bin",
    LISTING_SQL
    + f""", banded AS (SELECT {_BAND_SQL} AS band, final_price FROM listing),
    labels_of AS (SELECT unnest([{", ".join(f"'{b}'" for b in RATING_LABELS)}]) AS band)
    SELECT labels_of.band AS band, CAST(sum(final_price) AS DOUBLE) / count(final_price) AS mean
    FROM labels_of LEFT JOIN banded ON labels_of.band = banded.band GROUP BY labels_of.band""",
)
def mean_by_bin(spark, folder):
    return aggregate.mean_by_band(listing(spark, folder), "rating", "final_price")


@query(
    "filter_gt",
    LISTING_SQL + "SELECT product_id, title, CAST(rating AS DOUBLE) AS rating FROM listing WHERE rating > 4.0",
)
def filter_gt(spark, folder):
    high = listing(spark, folder).where(F.col("rating") > 4.0)
    return _doubles(high.select("product_id", "title", "rating"), "rating")


@query("filter_gt_count", LISTING_SQL + "SELECT count(*) AS n_rows FROM listing WHERE rating > 4.0")
def filter_gt_count(spark, folder):
    return listing(spark, folder).where(F.col("rating") > 4.0).agg(F.count("*").alias("n_rows"))


def _top_sql(measure: str) -> str:
    return LISTING_SQL + (
        f"SELECT category, CAST(sum({measure}) AS DOUBLE) / count({measure}) AS mean FROM listing "
        "WHERE category IS NOT NULL GROUP BY category ORDER BY mean DESC, category LIMIT 10"
    )


@query("top_price", _top_sql("final_price"))
def top_price(spark, folder):
    return aggregate.top_k_by_mean(listing(spark, folder), "category", "final_price")


@query("top_rating", _top_sql("rating"))
def top_rating(spark, folder):
    return aggregate.top_k_by_mean(listing(spark, folder), "category", "rating")


@query("top_popularity", _top_sql("(rating * CAST(ratings_count AS INTEGER))"))
def top_popularity(spark, folder):
    features = derive.add_features(listing(spark, folder))
    return aggregate.top_k_by_mean(features, "category", "popularity_score")


@query(
    "top_count",
    LISTING_SQL
    + "SELECT category, count(*) AS n_rows FROM listing WHERE category IS NOT NULL "
    "GROUP BY category ORDER BY n_rows DESC, category LIMIT 10",
)
def top_count(spark, folder):
    return aggregate.top_k_by_count(listing(spark, folder), "category")


@query(
    "corr_pair",
    LISTING_SQL
    + "SELECT round(corr(CAST(rating AS DOUBLE), CAST(final_price AS DOUBLE)), 6) AS corr FROM listing",
)
def corr_pair(spark, folder):
    return _rounded(stats.correlation(listing(spark, folder), "rating", "final_price"), 6, "corr")


@query(
    "corr_matrix",
    LISTING_SQL
    + ", filled AS (SELECT coalesce(discount, 0) AS discount, CAST(rating AS DOUBLE) AS rating FROM listing) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS corr FROM filled"
        for a in ("discount", "rating")
        for b in ("discount", "rating")
    ),
)
def corr_matrix(spark, folder):
    filled = clean.fill_missing(listing(spark, folder), numbers=["discount"])
    return _rounded(stats.correlation_matrix(filled, ["discount", "rating"]), 6, "corr")


@query(
    "histogram",
    LISTING_SQL
    + """, span AS (SELECT min(CAST(rating AS DOUBLE)) AS lo, max(CAST(rating AS DOUBLE)) AS hi FROM listing),
    binned AS (
      SELECT least(floor((CAST(rating AS DOUBLE) - lo) / (hi - lo) * 20), 19) AS bin FROM listing, span
    ),
    counted AS (SELECT bin, count(*) AS n_rows FROM binned GROUP BY bin),
    numbers AS (SELECT unnest(range(20)) AS bin)
    SELECT CAST(numbers.bin AS INTEGER) AS bin,
           round(lo + numbers.bin * ((hi - lo) / 20), 6) AS bin_from,
           round(lo + (numbers.bin + 1) * ((hi - lo) / 20), 6) AS bin_to,
           coalesce(n_rows, 0) AS n_rows
    FROM numbers CROSS JOIN span LEFT JOIN counted ON counted.bin = numbers.bin""",
)
def histogram(spark, folder):
    return _rounded(distribution.histogram(listing(spark, folder), "rating"), 6, "bin_from", "bin_to")


def _box_sql(value: str) -> str:
    return LISTING_SQL + f""", val AS (SELECT CAST({value} AS DOUBLE) AS v FROM listing),
    box AS (SELECT quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS median,
                   quantile_cont(v, 0.75) AS q75 FROM val)
    SELECT round(q25, 4) AS q25, round(median, 4) AS median, round(q75, 4) AS q75,
           min(CASE WHEN v >= q25 - 1.5 * (q75 - q25) THEN v END) AS whisker_low,
           max(CASE WHEN v <= q75 + 1.5 * (q75 - q25) THEN v END) AS whisker_high,
           CAST(sum(CASE WHEN v < q25 - 1.5 * (q75 - q25) OR v > q75 + 1.5 * (q75 - q25)
                         THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
    FROM val, box GROUP BY q25, median, q75"""


@query("box_price", _box_sql("final_price"))
def box_price(spark, folder):
    return _rounded(distribution.box_plot(listing(spark, folder), "final_price"), 4, "q25", "median", "q75")


@query("box_discount", _box_sql("coalesce(discount, 0)"))
def box_discount(spark, folder):
    filled = clean.fill_missing(listing(spark, folder), numbers=["discount"])
    return _rounded(distribution.box_plot(filled, "discount"), 4, "q25", "median", "q75")


@query(
    "cleaned_listing",
    LISTING_SQL
    + """SELECT DISTINCT product_id, title, category, CAST(rating AS DOUBLE) AS rating, ratings_count,
           CAST(initial_price AS DOUBLE) AS initial_price, coalesce(discount, 0) AS discount,
           coalesce(seller_name, 'Not Available') AS seller_name, 1 AS quantity,
           CAST(initial_price AS DOUBLE) AS total_amount, CAST(final_price AS DOUBLE) AS final_price,
           round(CAST(initial_price - final_price AS DOUBLE), 2) AS price_difference,
           CAST(rating * CAST(ratings_count AS INTEGER) AS DOUBLE) AS popularity_score
    FROM listing""",
)
def cleaned_listing(spark, folder):
    """The whole clean-up in order: fill, drop copies, derive, read prices, add features."""
    raw = listing(spark, folder).drop("final_price").withColumnRenamed("final_price_raw", "final_price")
    raw = _doubles(raw, "rating", "initial_price")
    featured = featured_listing(clean_listing(raw, texts=("seller_name",)))
    return _rounded(featured, 2, "price_difference")


@query(
    "nan_stats",
    LISTING_SQL
    + """, rated AS (SELECT category, nullif(CAST(rating AS DOUBLE), 0) AS rating, CAST(final_price AS DOUBLE) AS price FROM listing)
    SELECT category, n_rated, mean, corr FROM (
      SELECT category, count(rating) AS n_rated, round(avg(rating), 6) AS mean FROM rated GROUP BY category ORDER BY avg(rating) DESC, category LIMIT 10)
    CROSS JOIN (SELECT round(corr(rating, price), 6) AS corr FROM rated)""",
)
def nan_stats(spark, folder):
    """Zero ratings as NaN, as a data frame library leaves them: no figure may take them in."""
    rating = F.col("rating").cast("double")
    rated = listing(spark, folder).select(
        "category", F.when(rating == 0, float("nan")).otherwise(rating).alias("rating"), F.col("final_price").cast("double").alias("price")
    )
    best = aggregate.top_k_by_mean(rated, "category", "rating")
    counts = nan_to_null(rated).groupBy("category").agg(F.count("rating").alias("n_rated"))
    corr = stats.correlation(rated, "rating", "price").scalar()
    return _rounded(best.join(counts, "category").withColumn("corr", corr), 6, "mean", "corr")
