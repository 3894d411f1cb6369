"""Grouped figures and rankings.

All of these combine on the map side, so a key that holds a third of the rows reaches
its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.bands import RATING_EDGES, RATING_LABELS, range_label
from storefront.functions.missing import nan_to_null
from storefront.functions.money import mean


def top_k_by_mean(df: DataFrame, key: str, measure: str | Column, k: int = 10, name: str = "mean") -> DataFrame:
    """The ``k`` groups with the highest mean, ties by key; rows without a key are left out."""
    return (
        nan_to_null(df).where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(mean(measure).alias(name))
        .orderBy(F.desc_nulls_last(name), F.asc(key))
        .limit(k)
    )


def top_k_by_count(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent groups, ties by key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc(key))
        .limit(k)
    )


def totals_by(df: DataFrame, key: str, amount: str | Column) -> DataFrame:
    """Row count and summed amount per key, largest sum first."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n_rows"), F.sum(amount).alias("total"))
        .orderBy(F.desc("total"), F.asc(key))
    )


def split_count(df: DataFrame, column: str, value: str, yes: str, no: str) -> DataFrame:
    """One row: rows equal to ``value`` and rows different from it.

    A missing value is neither. Over no rows both figures are NULL, as sums are.
    """
    return df.agg(
        F.sum(F.when(F.col(column) == value, 1).otherwise(0)).alias(yes),
        F.sum(F.when(F.col(column) != value, 1).otherwise(0)).alias(no),
    )


def mean_by_band(
    df: DataFrame,
    column: str,
    measure: str,
    edges: Sequence[float] = RATING_EDGES,
    labels: Sequence[str] = RATING_LABELS,
) -> DataFrame:
    """Mean of a measure per labelled range; a range without rows stays, with NULL.

    The labels are few and known, so this is one global aggregate without a shuffle
    by key: one conditional mean per label, turned into rows at the end.
    """
    banded = nan_to_null(df).select(range_label(column, edges, labels).alias("band"), F.col(measure).alias("measure"))
    wide = banded.agg(
        *[mean(F.when(F.col("band") == label, F.col("measure"))).alias(f"m{i}") for i, label in enumerate(labels)]
    )
    rows = F.array(
        *[F.struct(F.lit(label).alias("band"), F.col(f"m{i}").alias("mean")) for i, label in enumerate(labels)]
    )
    return wide.select(F.inline(rows))
