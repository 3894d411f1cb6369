"""Joins that hold up when one key has a third of all rows.

Spark splits an overfull partition of an inner join on either side, but of an outer
join only on the side that is kept whole. ``outer_join`` therefore adds up an inner join
and anti joins against the distinct keys of the other side, which are combined on the
map side first. Rows without a key match nothing and go past the joins; what is left of a
side is the same table in both of its joins, so its rows are shuffled once. It also lets a
small kept side be broadcast, which a plain outer join cannot do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; a NULL key never occurs."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def _named_apart(left: DataFrame, right: DataFrame, keys: list[str], suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a suffix to each column, other than the keys, that the other side has too."""
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {k.lower() for k in keys}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in df.columns if c.lower() in shared})

    return renamed(left, suffixes[0]), renamed(right, suffixes[1])


def outer_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    side: str | None = None,
    suffixes: tuple[str, str] = ("_left", "_right"),
) -> DataFrame:
    """Left, right or full outer equi-join on key columns of the same name.

    ``side`` names a column that tells where a row comes from: ``both``, ``left_only``
    or ``right_only``. Keys of unmatched rows stay; other columns of the side that is
    missing are NULL. Columns that both sides have get ``suffixes``, as in a data frame merge.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "right", "full"):
        raise ValueError(f"unknown outer join: {how}")
    left, right = _named_apart(left, right, keys, suffixes)
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed_left, keyed_right = left.where(whole), right.where(whole)
    parts = [(keyed_left.join(keyed_right, keys, "inner"), "both")]
    if how in ("left", "full"):
        parts += [(without_match(keyed_left, keyed_right, keys), "left_only"), (left.where(~whole), "left_only")]
    if how in ("right", "full"):
        parts += [(without_match(keyed_right, keyed_left, keys), "right_only"), (right.where(~whole), "right_only")]
    if side:
        flagged = [df.withColumn(side, F.lit(flag)) for df, flag in parts]
    else:
        flagged = [df for df, _ in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flagged)


def key_audit(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Every key of either side with its rows on both: (keys, n_left, n_right, side).

    The keys of both sides meet in one aggregation, so no pairs are made and a key with a
    third of all rows is a row per task. NULL keys are counted, but match nothing.
    """
    keys = [on] if isinstance(on, str) else list(on)
    told = [df.select(*keys, F.lit(flag).alias("_of")) for df, flag in ((left, 0), (right, 1))]
    counted = told[0].unionAll(told[1]).groupBy(*keys).agg(F.count_if(F.col("_of") == 0).alias("n_left"), F.count_if(F.col("_of") == 1).alias("n_right"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    side = F.when(whole & (F.col("n_left") > 0) & (F.col("n_right") > 0), "both").when(F.col("n_right") == 0, "left_only")
    return counted.withColumn("side", side.when(F.col("n_left") == 0, "right_only").otherwise("no_key"))
