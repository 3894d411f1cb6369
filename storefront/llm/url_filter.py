"""URL filters: rules by host and path, and a cascade of Bloom filters for listed keys.

The cascade is exact over all keys of the corpus: its first filter holds the listed keys,
the second the unlisted keys that the first lets through, the third the listed keys that
the second lets through, and so on until a filter lets none through. A key is listed if
the first filter that refuses it is an even one. Filters are arrays of bits that go to the
tasks as scalar subqueries, so urls are judged in one scan, without a join.

The filters' size follows the number of listed keys. Up to ``MAX_BITS`` bits in a filter they
go to every task; a longer list is met by a semi-join on the keys instead, with the same
result.

Cases: a NULL url, or one without ``://``, has an empty host and path and the key ``''``,
which is judged as any other; rows repeated whole each get their row; listed keys that no
page has do no harm; extra columns are left alone, but for those called like a column of the
result, which give way to it; empty tables give an empty result.
"""

from __future__ import annotations

from math import ceil, log
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import bit_array, has_bit, land, set_apart

# Rules as (verdict, host, path), and host labels of listed pages.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LISTED_LABELS = ("spam-farm", "cheap-pills")
MAX_BITS = 1 << 27  # 16 MB
LATER_RATE = 0.1


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to / ? # (A-Z lower-cased), and from there up to ? #."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda n: F.regexp_extract(F.coalesce(url, F.lit("")), pattern, n)
    return F.translate(part(1), ascii_uppercase, ascii_lowercase), part(2)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or NULL."""
    chosen = None
    for verdict, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        value = F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen


def _places(key: Column, level: int, n_bits: int, n_hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(n_bits).cast("long")) for j in range(n_hashes)]


def cascade(keys: DataFrame, max_bits: int = MAX_BITS):
    """A test for listed keys, from ``keys`` (key, listed), a row per key of the corpus.

    Returns a function from a column to a boolean column, or None where a filter would be
    larger than ``max_bits``.
    """
    keys = land(keys, "url-keys")
    total = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    encoded, tested, level, filters = True, total[1], 0, []
    left = {True: keys.where("listed"), False: keys.where(~F.col("listed"))}
    count = {True: total[0], False: total[1]}
    while count[encoded]:
        tested = count[not encoded]
        rate = min(0.5, max(1e-4, count[encoded] / tested)) if not level and tested else LATER_RATE
        n_hashes = max(1, round(-log(rate, 2)))
        n_bits = 64 * ceil(1.45 * n_hashes * count[encoded] / 64)
        if n_bits > max_bits:
            return None
        places = left[encoded].select(F.explode(F.array(*_places(F.col("key"), level, n_bits, n_hashes))).alias("place"))
        bits = bit_array(places, n_bits)
        filters.append((bits, level, n_bits, n_hashes))
        through = left[not encoded].where(_let_through(F.col("key"), *filters[-1]))
        left[not encoded] = land(through, f"url-keys-{level}")
        count[not encoded] = left[not encoded].count()
        encoded, level = not encoded, level + 1

    def listed(key: Column) -> Column:
        held = F.lit(False)
        for one in reversed(filters):
            held = _let_through(key, *one) & ~held
        return held

    return listed


def _let_through(key: Column, bits: Column, level: int, n_bits: int, n_hashes: int) -> Column:
    held = F.lit(True)
    for place in _places(key, level, n_bits, n_hashes):
        held = held & has_bit(bits, place)
    return held


def listed_by_label(host: Column, labels=LISTED_LABELS) -> Column:
    """Hosts with one of ``labels`` between their dots."""
    return F.arrays_overlap(F.split(host, r"\."), F.lit(list(labels)))


def judge(pages: DataFrame, listed: DataFrame, url: str = "url", rules=RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` without ``html``, with host, path, rule and verdict.

    ``listed``: a column ``key`` of blocked keys, a key being host and path of a url. A rule
    decides where one fits, else the list does.
    """
    return set_apart(pages, {url, "html"}, lambda inner: _judge(inner, listed, url, rules, max_bits))


def _judge(pages: DataFrame, listed: DataFrame, url: str, rules, max_bits: int) -> DataFrame:
    host, path = host_and_path(F.col(url))
    parted = pages.drop("html").withColumns({"host": host, "path": path})
    own = parted.select(F.concat("host", "path").alias("key"), F.lit(False).alias("listed"), F.lit(True).alias("here"))
    named = listed.select("key", F.lit(True).alias("listed"), F.lit(False).alias("here"))
    both = own.unionAll(named).groupBy("key").agg(F.bool_or("listed").alias("listed"), F.bool_or("here").alias("here"))
    test = cascade(both.where("here").select("key", "listed"), max_bits)
    key = F.concat("host", "path")
    if test is None:
        hits = listed.select(F.col("key").alias("_listed")).distinct()
        parted = parted.join(hits, key == F.col("_listed"), "left").withColumn("_hit", F.col("_listed").isNotNull()).drop("_listed")
    else:
        parted = parted.withColumn("_hit", test(key))
    own_verdict = F.when(F.col("_hit"), "block").otherwise("allow")
    ruled = parted.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    return ruled.withColumns(
        {"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), own_verdict)}
    ).drop("_rule", "_hit")
