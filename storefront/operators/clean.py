"""Cleaning: missing values and duplicate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the text that stands for a missing one.
TEXT_MARKER = "Not Available"


def fill_missing(
    df: DataFrame,
    numbers: Sequence[str] = (),
    texts: Sequence[str] = (),
    marker: str = TEXT_MARKER,
) -> DataFrame:
    """Zero for missing numbers and ``marker`` for missing texts in the named columns."""
    if numbers:
        df = df.fillna(0, subset=list(numbers))
    if texts:
        df = df.fillna(marker, subset=list(texts))
    return df


def _digested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a digest of 128 bits of the named columns, equal for equal rows."""
    named = [F.col(f"`{c}`") for c in columns]
    absent = [c.isNull() for c in named]
    return df.withColumn(_DIGEST, F.struct(F.xxhash64(*named, *absent).alias("a"), F.xxhash64(F.lit(1), *reversed(named), *absent).alias("b")))


def _repeated(digested: DataFrame) -> DataFrame:
    """The digests that several rows have; 16 bytes a row are shuffled, counted on the map side first."""
    return digested.groupBy(_DIGEST).agg(F.count("*").alias("n")).where("n > 1").select(_DIGEST)


_DIGEST = "__digest"


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one, missing values being equal.

    Rows with a digest of their own are unlike all others; only the rest is compared whole.
    """
    columns = list(columns or df.columns)
    digested = _digested(df.select(*[F.col(f"`{c}`") for c in columns]), columns)
    suspects = digested.join(_repeated(digested), _DIGEST, "left_semi")
    copies = suspects.groupBy(*[F.col(f"`{c}`") for c in columns]).agg((F.count("*") - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0).cast("bigint")).alias("n_duplicates"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows, missing values being equal.

    Rows with a digest of their own go straight through; copies of a row meet on the map side
    first, so a much-copied row does not load one reducer.
    """
    digested = _digested(df, df.columns)
    repeated = _repeated(digested)
    alone = digested.join(repeated, _DIGEST, "left_anti").drop(_DIGEST)
    return alone.unionAll(digested.join(repeated, _DIGEST, "left_semi").drop(_DIGEST).dropDuplicates())
