"""Values as they come in: NaN becomes NULL, and a number is written in digits only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(column: Column) -> Column:
    """The floating-point value, or NULL when it is NaN."""
    return F.nanvl(column, F.lit(None))


# A number in digits, or one of the words for what is no finite number.
_NUMBER = r"(?i)^\s*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


def number_text(text: Column) -> Column:
    """The text, spoiled unless it is a number written in digits.

    Java also reads ``12d``, ``0x1p3`` and the like; a product code must not turn into a
    number.
    """
    return F.when(text.rlike(_NUMBER), text).otherwise(F.concat(text, F.lit("?")))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float and double column."""
    floating = {name for name, dtype in df.dtypes if dtype in ("float", "double")}
    if not floating:
        return df
    return df.select(
        *[present(F.col(f"`{c}`")).alias(c) if c in floating else F.col(f"`{c}`") for c in df.columns]
    )
