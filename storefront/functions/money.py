"""Money: currency text to numbers, and means that do not depend on the order of rows."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from storefront.functions.missing import number_text, present

# Every character that counts as white space in Unicode text.
_BLANKS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())

# The characters that price texts carry besides the number.
CURRENCY_MARKS = '₹,"'


def parse_currency(column: Column | str, strict: bool = True, marks: str = CURRENCY_MARKS) -> Column:
    """The number in a price text such as ``"₹1,299.00"``.

    With ``strict`` an unreadable text fails the job, otherwise it gives NULL. The
    text ``nan`` means a missing price.
    """
    c = F.col(column) if isinstance(column, str) else column
    unmarked = reduce(lambda text, mark: F.replace(text, F.lit(mark)), marks, c.cast("string"))
    bare = number_text(F.btrim(unmarked, F.lit(_BLANKS)))
    return present(bare.cast("double") if strict else bare.try_cast("double"))


def money(column: Column | str) -> Column:
    """A price as an exact decimal of two places."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("decimal(12,2)")


def mean(column: Column | str) -> Column:
    """Mean of the values present, NULL when there are none.

    Decimals are summed exactly, so the order in which partitions merge cannot show.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.try_divide(F.sum(c).cast("double"), F.count(c))
