"""Labelled bands of a number."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges and labels of the rating groups, and the price tiers.
RATING_EDGES = (0, 2, 3, 4, 5)
RATING_LABELS = ("0-2", "2-3", "3-4", "4-5")
TIER_BOUNDS = (1000, 5000)
TIER_LABELS = ("Budget", "Mid-Range", "Premium")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def range_label(
    column: Column | str,
    edges: Sequence[float] = RATING_EDGES,
    labels: Sequence[str] = RATING_LABELS,
) -> Column:
    """Label of the range ``(low, high]`` a value lies in, NULL outside all of them."""
    if len(edges) != len(labels) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("edges must rise and be one more than the labels")
    c = _col(column)
    # NaN sorts above every number in Spark, so the upper bound keeps it out.
    first = F.when((c > edges[0]) & (c <= edges[1]), labels[0])
    return reduce(
        lambda chain, i: chain.when((c > edges[i]) & (c <= edges[i + 1]), labels[i]),
        range(1, len(labels)),
        first,
    )


def price_tier(
    column: Column | str,
    bounds: tuple[float, float] = TIER_BOUNDS,
    labels: tuple[str, str, str] = TIER_LABELS,
) -> Column:
    """Lower, middle or upper tier; both bounds belong to the middle one.

    As in the SQL form, everything else falls into the upper tier, a NULL price too.
    """
    c = _col(column)
    low, high = bounds
    return F.when(c < low, labels[0]).when(c.between(low, high), labels[1]).otherwise(labels[2])
