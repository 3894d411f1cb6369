"""Describe, quantiles, histograms and box plots without a task that sees a whole column.

Quantiles are exact and take two scans. The first is one wide aggregate: counts, moments,
extremes and, from ``percentile_approx``, a bracket of two values around each wanted rank.
The second counts the values inside the brackets, each once with its number of rows, and the
rows between the brackets; both are combined on the map side, so a value that a third of all
rows share leaves each task as one row. What lies inside a bracket is cut once more into
``_PARTS`` parts of about as many distinct values, counted, and only the values of the parts
that hold a wanted rank are put in order.

With n rows a bracket spans at most ``2 * (margin + 1 / _ACCURACY)`` of them, a thousandth
from ``_needed(_MARGINS[0])`` rows on, and one ordered group at most two parts of it: about
n / 50,000 values, however they are spread. A bracket that missed its rank would stop the
query, not give a wrong figure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}

_ACCURACY = 10_000  # ranks of the sketch are off by one in so many rows
_MARGINS = (4 / _ACCURACY, 0.04)  # of the rows, to each side of a rank
_PARTS = 100  # of the distinct values in a bracket


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the number columns, booleans and texts left out."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _number(column: str) -> Column:
    """A column as a double, NaN as NULL."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) for the values present in ``columns``, as doubles."""
    numbers = df.select(*[_number(c).alias(c) for c in columns])
    return numbers.unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "value").where("value IS NOT NULL")


def _needed(margin: float) -> int:
    """Rows from which a margin holds the two neighbours of a rank in spite of the sketch's error."""
    return ceil(2 / (margin - 1 / _ACCURACY))


def _summary(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """A row per column: total, mean, std, min, max, and a bracket (lo_i, hi_i) per quantile.

    All figures of a column are one array: whoever reads some of them needs the same aggregate,
    so the several readers share its exchange and the table is scanned once.
    """
    sides = [min(max(p + side * m, 0.0), 1.0) for p in probabilities.values() for m in _MARGINS for side in (-1, 1)]
    names = ["total", "mean", "std", "min", "max"]
    figures = []
    for c in columns:
        v = _number(c)
        moments = F.array(F.count(v).cast("double"), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v))
        figures.append(F.concat(moments, F.percentile_approx(v, sides, _ACCURACY)))
    row = df.agg(*[f.alias(f"c{i}") for i, f in enumerate(figures)])
    named = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("figures")) for i, c in enumerate(columns)]
    rows = row.select(F.inline(F.array(*named)))
    rows = rows.withColumns({n: F.get("figures", i) for i, n in enumerate(names)})
    rows = rows.withColumn("total", F.coalesce(F.col("total").cast("bigint"), F.lit(0)))
    ends = {}
    for i in range(len(probabilities)):
        for end, side, whole in (("lo", 0, "min"), ("hi", 1, "max")):
            place = 2 * len(_MARGINS) * i + side
            chosen = reduce(
                lambda rest, k: F.when(F.col("total") >= _needed(_MARGINS[k]), F.get("figures", len(names) + place + 2 * k)).otherwise(rest),
                reversed(range(len(_MARGINS))),
                F.col(whole),
            )
            ends[f"{end}_{i}"] = chosen
    return rows.withColumns(ends).drop("figures")


def _counted(df: DataFrame, columns: Sequence[str], summary: DataFrame, intervals: int) -> DataFrame:
    """(column_name, n, low, high): values inside an interval of the summary, one by one with their
    rows (low = high), and the stretches between the intervals as a whole."""
    bounds = [f for i in range(intervals) for f in (f"lo_{i}", f"hi_{i}")]
    # one row per column name
    held = _long(df, columns).join(F.broadcast(summary.select("column_name", *bounds)), "column_name")
    inside = " OR ".join(f"value BETWEEN lo_{i} AND hi_{i}" for i in range(intervals))
    stretch = " + ".join(f"CAST(value > hi_{i} AS INT) * {2**i}" for i in range(intervals))
    return held.groupBy(
        "column_name",
        F.expr(f"CASE WHEN {inside} THEN value END").alias("value"),
        F.expr(f"CASE WHEN {inside} THEN -1 ELSE {stretch} END").alias("stretch"),
    ).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).select(
        "column_name", "n", "low", "high"
    )


def _holding_a_rank(counted: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Keep the rows whose run of ranks [first, last) holds the ranks around ``at``.

    ``before`` says how many values of the column come ahead of the group.
    """
    so_far = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counted.withColumn("last", F.col("before") + F.sum("n").over(so_far))
        .withColumn("first", F.expr("last - n"))
        .where("(floor(at) >= first AND floor(at) < last) OR (ceil(at) >= first AND ceil(at) < last)")
    )


def _in_parts(counted: DataFrame, summary: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """The values in each quantile's bracket, with its rank ``at``, the rows ``before`` the bracket
    and the ``part`` of the bracket."""
    marks = [
        F.struct(
            F.lit(name).alias("quantile"), (F.lit(float(p)) * (F.col("total") - 1)).alias("at"),
            F.col(f"lo_{i}").alias("lo"), F.col(f"hi_{i}").alias("hi"),
        )
        for i, (name, p) in enumerate(probabilities.items())
    ]
    # the frames that are broadcast have a row per column and quantile
    met = counted.join(F.broadcast(summary.select("column_name", F.inline(F.array(*marks)))), "column_name")
    # stretches lie outside all brackets; all readers use n, low and high, and so share one scan
    inside = F.expr("low >= lo AND high <= hi AND n > 0")
    cuts = [k / _PARTS for k in range(1, _PARTS)]
    frame = met.groupBy("column_name", "quantile").agg(
        F.coalesce(F.sum(F.when(F.col("high") < F.col("lo"), F.col("n"))), F.lit(0)).alias("before"),
        F.percentile_approx(F.when(inside, F.col("low")), cuts, 10 * _PARTS).alias("cuts"),
    )
    part = F.size(F.filter("cuts", lambda cut: cut < F.col("low")))
    return met.where(inside).join(F.broadcast(frame), ["column_name", "quantile"]).select(
        "column_name", "quantile", "at", "before", F.col("low").alias("value"), "n", part.alias("part")
    )


def _to_order(in_parts: DataFrame) -> DataFrame:
    """The values of the parts that hold a wanted rank: what is put in order."""
    group = ["column_name", "quantile"]
    parts = in_parts.groupBy(*group, "at", "before", "part").agg(F.sum("n").alias("n"))
    held = _holding_a_rank(parts, group, "part").select(*group, "part", F.col("first").alias("before"))
    # at most two parts per quantile
    return in_parts.drop("before").join(F.broadcast(held), [*group, "part"])


def _quantiles(counted: DataFrame, summary: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """A row per column that has values, with its quantiles."""
    left = _to_order(_in_parts(counted, summary, probabilities))
    found = _holding_a_rank(left, ["column_name", "quantile", "part"], "value")

    def at(name: str) -> Column:
        low, high = (
            f"max(CASE WHEN quantile = '{name}' AND {rank}(at) >= first AND {rank}(at) < last THEN value END)" for rank in ("floor", "ceil")
        )
        return F.expr(f"{low} + ({high} - {low}) * max(CASE WHEN quantile = '{name}' THEN at - floor(at) END)").alias(name)

    return found.groupBy("column_name").agg(*[at(name) for name in probabilities])


def _found(name: str) -> Column:
    """A quantile, which every column with values must have."""
    missed = F.raise_error(F.lit(f"the bracket of {name} missed its rank")).cast("double")
    return F.when((F.col("total") > 0) & F.col(name).isNull(), missed).otherwise(F.col(name)).alias(name)


def _described(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """The summary with its quantiles; every column has a row."""
    summary = _summary(df, columns, probabilities)
    found = _quantiles(_counted(df, columns, summary, len(probabilities)), summary, probabilities)
    figures = ["total", "mean", "std", "min", "max"]
    return summary.join(F.broadcast(found), "column_name", "left").select(
        "column_name", *figures, *[_found(n) for n in probabilities]
    )


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float] = QUARTILES
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column that has values.

    ``probabilities`` names the result columns.
    """
    return _described(df, columns, probabilities).where("total > 0").select("column_name", *probabilities)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of number columns.

    One row per column; missing values are left out of every figure.
    """
    columns = list(columns or numeric_columns(df))
    return _described(df, columns, QUARTILES).select(
        "column_name", F.col("total").alias("count"), "mean", "std", "min", *QUARTILES, "max"
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts of equal-width bins over the range of a column, empty bins included.

    Bins are closed on the left, the last one on both sides. A column with a single
    value gets a range of one around it.
    """
    values = _long(df, [column])
    span = (
        values.groupBy("column_name")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .selectExpr(
            "column_name",
            "CASE WHEN low = high THEN low - 0.5D ELSE low END AS low",
            "CASE WHEN low = high THEN high + 0.5D ELSE high END AS high",
        )
        .withColumn("step", F.expr(f"(high - low) / {bins}"))
    )
    guess = F.expr(f"coalesce(least(floor((value - low) / (high - low) * {bins}), {bins - 1}), 0)")
    # The division may round a value across an edge; the edges themselves decide.
    exact = F.expr(
        f"""CAST(CASE WHEN value < low + guess * step THEN guess - 1
             WHEN value >= low + (guess + 1) * step AND guess < {bins - 1} THEN guess + 1
             ELSE guess END AS INT)"""
    )
    # One row of range, one row per bin: both broadcasts are of fixed size.
    counted = (
        values.join(F.broadcast(span), "column_name")
        .withColumn("guess", guess)
        .groupBy(exact.alias("bin"))
        .agg(F.count("*").alias("n_rows"))
    )
    frame = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        F.expr("low + bin * step").alias("bin_from"),
        F.expr(f"CASE WHEN bin = {bins - 1} THEN high ELSE low + (bin + 1) * step END").alias("bin_to"),
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )


def box_plot(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count of one column, in two scans.

    Whiskers end at the outermost values that lie within ``reach`` interquartile ranges of
    the box; they never end inside the box. The brackets of the quartiles bound where the
    fences can lie; values there are counted one by one with those of the brackets, and every
    stretch outside counts as a whole, so the fences need no scan of their own.
    """
    summary = _summary(df, [column], QUARTILES)
    fence_low = f"{{0}} - {float(reach)!r}D * ({{1}} - {{0}})"
    fence_high = f"{{1}} + {float(reach)!r}D * ({{1}} - {{0}})"
    # a fence falls as the other quartile moves away; lo_0, hi_0: lower, lo_2, hi_2: upper quartile
    summary = summary.withColumns(
        {
            "lo_3": F.expr(fence_low.format("lo_0", "hi_2")), "hi_3": F.expr(fence_low.format("hi_0", "lo_2")),
            "lo_4": F.expr(fence_high.format("hi_0", "lo_2")), "hi_4": F.expr(fence_high.format("lo_0", "hi_2")),
        }
    )
    counted = _counted(df, [column], summary, 5)
    box = _quantiles(counted, summary, QUARTILES).withColumns(
        {"fence_low": F.expr(fence_low.format("q25", "q75")), "fence_high": F.expr(fence_high.format("q25", "q75"))}
    )
    # The box is one row.
    return (
        counted.join(F.broadcast(box), "column_name")
        .groupBy(*QUARTILES)
        .agg(
            F.min(F.when(F.col("low") >= F.col("fence_low"), F.col("low"))).alias("lowest"),
            F.max(F.when(F.col("high") <= F.col("fence_high"), F.col("high"))).alias("highest"),
            F.sum(F.expr("CASE WHEN high < fence_low OR low > fence_high THEN n ELSE 0 END")).alias("n_outliers"),
            F.sum("n").alias("total"),
        )
        .select(*[_found(n) for n in QUARTILES], "lowest", "highest", "n_outliers")
        .select(
            "q25", F.col("q50").alias("median"), "q75",
            F.least("lowest", "q25").alias("whisker_low"),
            F.greatest("highest", "q75").alias("whisker_high"),
            "n_outliers",
        )
    )
