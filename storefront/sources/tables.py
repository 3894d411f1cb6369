"""Parquet tables, literal rows and SQL text as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from storefront.functions.missing import nan_to_null
from storefront.schemas import TableRules


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``, NaN as NULL."""
    return nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def literal_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small table written out in the program, checked against ``schema``, NaN as NULL."""
    return nan_to_null(spark.createDataFrame(list(rows), schema))


def empty_tables(spark: SparkSession, rules: Mapping[str, TableRules]) -> dict[str, DataFrame]:
    """Each declared table, newly made and without rows."""
    return {name: spark.createDataFrame([], rule.schema) for name, rule in rules.items()}


def run_sql(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame], values: Mapping[str, object] | None = None
) -> DataFrame:
    """Run SQL whose table names stand in braces, e.g. ``SELECT * FROM {orders}``; NaN as NULL.

    ``values`` are bound to named markers such as ``:day``, so no value becomes part of the text.
    """
    return nan_to_null(spark.sql(text, args=dict(values or {}), **tables))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables known by name to ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_state(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write the tables of one state below a new folder; readers switch over afterwards.

    Nothing is overwritten: a folder that already holds one of the tables is an error,
    so the state that was read stays whole until the caller points readers to the new one.
    """
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}.parquet")
