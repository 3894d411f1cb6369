"""Sparse features of texts for the trained operators: words by hashed place, in Python workers."""

from __future__ import annotations

import re
from functools import cache

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
DIMENSIONS = 1 << 18
WORDS_KEPT = 200_000


class _Places(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode()) % DIMENSIONS
        return value


@cache
def places() -> dict[str, int]:
    """Place of each word, kept up to a bound."""
    return _Places()


def words_of(text: str | None) -> list[str]:
    """Words of letters, lower-cased."""
    return LETTERS.findall(text.lower()) if isinstance(text, str) else []


def sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, all where there are fewer; chosen by a hash of doc_id.

    Labels are counted first (one row each), then each keeps the rows whose hash lies below
    its share, so no label is gathered in one task.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    kept = F.lit(False)
    for value, n in counts.items():
        kept = kept | (F.col(label).eqNullSafe(F.lit(value)) & (draw < int(1_000_000 * min(1.0, per_label / n))))
    return rows.where(kept)
