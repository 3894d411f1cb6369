"""First looks at a table: shape, columns, missing values, value counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.functions.missing import nan_to_null, present


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, one row per table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def head(df: DataFrame, by: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of ``by``, which should be unique."""
    return df.orderBy(F.asc(by)).limit(n)


def tail(df: DataFrame, by: str, n: int = 5) -> DataFrame:
    """The last ``n`` rows in the order of ``by``, which should be unique."""
    return df.orderBy(F.desc(by)).limit(n)


def column_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, present and missing values of every column, in one scan."""

    def there(name: str, dtype: str) -> Column:
        c = F.col(name)
        return present(c) if dtype in ("float", "double") else c

    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(there(name, dtype)).alias(f"c{i}") for i, (name, dtype) in enumerate(df.dtypes)],
    )
    facts = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(dtype).alias("dtype"),
                F.col(f"c{i}").alias("non_null"),
                (F.col("n_rows") - F.col(f"c{i}")).alias("missing"),
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ]
    )
    return counted.select(F.inline(facts))


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, NaN counted as missing."""
    return column_profile(df).select("column_name", "missing")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, most frequent first; missing values do not count."""
    return (
        nan_to_null(df).where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc(column))
    )
