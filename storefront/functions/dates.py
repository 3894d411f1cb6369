"""Date predicates written as ranges on the bare column, so that scans can prune by them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def between_days(column: Column | str, first: date, last: date) -> Column:
    """Dates or timestamps from ``first`` to the end of ``last``, both days whole."""
    c = F.col(column) if isinstance(column, str) else column
    return (c >= F.lit(first)) & (c < F.lit(last + timedelta(days=1)))


def on_day(column: Column | str, day: date) -> Column:
    """Dates or timestamps that fall on ``day``."""
    return between_days(column, day, day)


def in_year(column: Column | str, year: int) -> Column:
    """Dates or timestamps of one calendar year."""
    return between_days(column, date(year, 1, 1), date(year, 12, 31))
