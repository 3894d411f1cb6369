"""What several text operators share: words, row keys, landed tables, crc buckets."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import storefront
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.session import land, land_observed, remove_scratch
from storefront.sources.tables import load

__all__ = ["SPACE", "SPACES", "Scratch", "bind", "bit_array", "bucket", "documents", "fitted", "has_bit", "land", "load", "maybe_in", "row_key", "set_apart", "ship", "shuffle_width", "words"]

# White space between words, as a regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents")


def words(text: Column) -> Column:
    """The words between ASCII white space; no words for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def row_key(text: str = "text") -> Column:
    """A number that tells documents with one doc_id but unlike texts apart; NULL is not ''."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def bucket(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ROWS_PER_TASK = 50_000


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as few partitions as ``rows`` short rows ask for, and in those it has if that is more.

    For small tables that go through many rounds: every round writes a file, its checksum and
    a task's records for each partition, which is more than is in them.
    """
    width = max(1, -(-rows // ROWS_PER_TASK))
    return df.coalesce(width) if width < shuffle_width(df.sparkSession) else df


def set_apart(docs: DataFrame, read: set[str], operate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``operate`` makes of ``docs``, whose columns other than ``read`` go under names of their own meanwhile.

    So no column of the input can clash with one that the operator adds or needs on the way. A
    column of the input called like one that the operator returns gives way to it.
    """
    read = {c.lower() for c in read}
    inner = {c if c.lower() in read else f"_other_{i}": c for i, c in enumerate(docs.columns)}
    made = operate(docs.toDF(*inner))
    added = {c.lower() for c in made.columns if c not in inner}
    return made.select(
        *[F.col(f"`{c}`").alias(inner.get(c, c)) for c in made.columns if c not in inner or inner[c].lower() not in added]
    )


def bit_array(positions: DataFrame, n_bits: int) -> Column:
    """The bits at ``positions`` (one long column) as one array of longs, a scalar subquery.

    ``n_bits`` bounds what comes together and goes to the tasks: a byte for eight bits.
    """
    (name,) = positions.columns
    place = F.col(name)
    one = F.lit(1).cast("long")
    bit = F.call_function("shiftleft", one, (place % 64).cast("int"))
    held = positions.groupBy((F.floor(place / 64)).cast("long").alias("i")).agg(F.bit_or(bit).alias("bits"))
    every = positions.sparkSession.range(n_bits // 64).withColumnRenamed("id", "i")
    filled = every.join(held, "i", "left").select("i", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    row = filled.agg(F.sort_array(F.collect_list(F.struct("i", "bits"))).alias("all"))
    return row.select(F.transform("all", lambda x: x["bits"]).alias("bits")).scalar()


def has_bit(bits: Column, place: Column) -> Column:
    held = F.get(bits, F.floor(place / 64).cast("int"))
    return F.call_function("shiftrightunsigned", held, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def maybe_in(keys: DataFrame, column: Column, n_bits: int = 1 << 23) -> Column:
    """False only where ``column`` is none of ``keys`` (one column): a filter ahead of a join.

    Of fixed size (1 MB), so with very many keys it lets more through; the join decides.
    """
    (name,) = keys.columns
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(n_bits))
    return has_bit(bit_array(keys.select(place(F.col(name)).alias("place")), n_bits), place(column))


class Scratch:
    """Landed tables that go as soon as what was made of them has landed."""

    def __init__(self) -> None:
        self._paths: list[tuple[SparkSession, str]] = []

    def land(self, df: DataFrame, label: str) -> DataFrame:
        return self.land_observed(df, label)[0]

    def land_observed(self, df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
        """The landed table, and aggregates that its write counted on the way."""
        landed, seen, path = land_observed(df, label, **figures)
        self._paths.append((df.sparkSession, path))
        return landed, seen

    def clear(self) -> None:
        for spark, path in self._paths:
            remove_scratch(spark, path)
        self._paths = []


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(storefront.__file__).parent
    folder = tempfile.mkdtemp(prefix="storefront-code-")  # executors fetch the file from the driver, later too
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, f"{folder}/code/storefront", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/storefront-llm", "zip", f"{folder}/code"))


_shipped: set[str] = set()
