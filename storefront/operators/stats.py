"""Correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.missing import present


def _number(column: str) -> Column:
    return present(F.col(f"`{column}`").cast("double"))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: Pearson correlation over the rows where both values are present."""
    return df.agg(F.corr(_number(a), _number(b)).alias("corr"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(var_a, var_b, corr) for every ordered pair of columns, in one scan.

    A row gives its values as one array and one (i, j, x, y) per pair of columns that are
    both there; co-moments are merged by (i, j), on the map side first. The plan is the same
    for two columns or two hundred, and at most a row per pair leaves a task.
    """
    width = len(columns)
    names = F.array(*[F.lit(c) for c in columns])
    places = lambda first: F.sequence(first, F.lit(width - 1))
    values = df.select(F.array(*[_number(c) for c in columns]).alias("v"))
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"), F.get("v", i).alias("x"), F.get("v", j).alias("y"))
    each = F.flatten(F.transform(places(F.lit(0)), lambda i: F.transform(places(i), lambda j: pair(i, j))))
    met = values.select(F.inline(each)).where("x IS NOT NULL AND y IS NOT NULL")
    moments = met.groupBy("i", "j").agg(F.corr("x", "y").alias("corr"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    )
    found = moments.select("corr", F.inline(both))
    # pairs that never meet keep their row
    grid = F.flatten(F.transform(places(F.lit(0)), lambda i: F.transform(places(F.lit(0)), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    frame = df.sparkSession.range(1).select(F.inline(grid))
    return frame.join(found, ["i", "j"], "left").select(F.get(names, "i").alias("var_a"), F.get(names, "j").alias("var_b"), "corr")
