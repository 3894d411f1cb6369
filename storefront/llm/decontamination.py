"""Benchmark decontamination: item-sized windows by SimHash, verified by weighted shingles.

Texts are lower-cased and cut into words; shingles are five words (all words, where there
are fewer). Only windows that share a shingle with some item can reach the similarity, so
windows as long as that item (in words) are laid where the shared shingle would be
aligned; equal windows are searched once, so a passage in a third of all documents is one
search. Every window gets a 64-bit SimHash over its weighted shingles. Its four 16-bit
blocks are looked up in an index that holds each item's blocks with up to ``radius // 4``
bits turned, so every fingerprint within ``radius`` bits is met in a block. Of these, pairs
of window and item are kept whose weighted Jaccard similarity is at least ``threshold``; a
shingle weighs its number of characters, each time it occurs.

Two windows at the threshold differ in 9.7 bits on average with a deviation of 2.9, as bits of
a SimHash differ by the angle between the weights. A radius of 19 leaves out some 3 in 10,000 of
those; one of 15 left out 2 in 100.

The items' shingles are broadcast only up to ``MAX_BROADCAST_ROWS`` rows; beyond that Spark
joins them by shuffle, with equal results.

Cases: NULL and wordless texts, of documents or items, match nothing; a document shorter
than the item is one window; rows repeated whole give one result; a NULL doc_id is kept;
of windows with equal similarity the first is named, of those the shortest; extra columns are
left alone, whatever they are called; a very long text is one row like any other; empty
tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import bind, land, maybe_in, row_key, set_apart, words

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
MAX_BROADCAST_ROWS = 500_000
WORDED = r"[^\x20\x09-\x0D]"


def _lowered(text: str) -> Column:
    return words(F.lower(F.col(text)))


def _shingle(found: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(found, at + j) for j in range(SHINGLE)])


def _starts(found: Column) -> Column:
    """Where shingles begin; one for under five words, none for no words."""
    last = F.greatest(F.size(found) - SHINGLE, F.lit(0))
    return F.when(F.size(found) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _weighted(found: Column) -> Column:
    """(h, w) of every distinct shingle of a window, with its weight."""
    length = lambda i: F.length(F.array_join(F.slice(found, i + 1, F.lit(SHINGLE)), " "))
    return F.transform(_starts(found), lambda i: F.struct(_shingle(found, i).alias("h"), length(i).cast("long").alias("w")))


def _totals(shingles: Column) -> Column:
    keys = F.array_distinct(F.transform(shingles, lambda x: x["h"]))
    weight = lambda h: F.aggregate(
        F.filter(shingles, lambda y: y["h"] == h), F.lit(0).cast("long"), lambda a, y: a + y["w"]
    )
    return F.transform(keys, lambda h: F.struct(h.alias("h"), weight(h).alias("w")))


def _simhash(shingles: Column) -> Column:
    bit = lambda h, b: F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long"))
    vote = lambda b: F.aggregate(
        shingles, F.lit(0).cast("long"), lambda a, x: a + x["w"] * (2 * bit(x["h"], b) - 1)
    )
    one = F.lit(1).cast("long")
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda a, b: a.bitwiseOR(F.when(vote(b) > 0, F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long"))),
    )


def fingerprints(df: DataFrame, found: str) -> DataFrame:
    """``df`` with ``shingles`` (distinct, weighted) and ``simhash`` of its words."""
    shingles = bind(_weighted(F.col(found)), _totals)
    both = bind(shingles, lambda s: F.struct(s.alias("shingles"), _simhash(s).alias("simhash")))
    held = df.withColumn("_both", both)
    return held.withColumns({"shingles": F.col("_both.shingles"), "simhash": F.col("_both.simhash")}).drop("_both")


def _block(value: Column, number: int) -> Column:
    return F.shiftrightunsigned(value, BLOCK_BITS * number).bitwiseAND(F.lit(2**BLOCK_BITS - 1).cast("long")).cast("int")


def hamming_pairs(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs whose ``simhash`` differ in at most ``radius`` bits, each pair once.

    ``right``, the smaller side, is entered with all blocks within ``radius // BLOCKS`` bits:
    of four blocks that differ in ``radius`` bits together one differs in no more.
    """
    near = radius // BLOCKS
    masks = F.lit([m for m in range(2**BLOCK_BITS) if m.bit_count() <= near])
    entered = right.withColumn("_masks", masks)
    blocks = F.array(*[F.struct(F.lit(j).alias("b"), _block(F.col("simhash"), j).alias("v")) for j in range(BLOCKS)])
    index = entered.withColumn("_x", F.explode(blocks)).withColumn("_m", F.explode("_masks")).select(
        *[F.col(c).alias(f"r_{c}") for c in right.columns], F.col("_x.b").alias("_b"), F.col("_x.v").bitwiseXOR(F.col("_m")).alias("_v")
    )
    probes = left.withColumn("_x", F.explode(blocks)).select(*left.columns, F.col("_x.b").alias("_b"), F.col("_x.v").alias("_v"))
    # the index is far larger than the table it is made from, so its size is never guessed
    met = probes.join(index.hint("merge"), ["_b", "_v"])
    differ = F.col("simhash").bitwiseXOR(F.col("r_simhash"))
    # a pair that meets in several blocks is taken in the first of them
    earlier = F.lit(False)
    for j in range(BLOCKS - 1):
        earlier = earlier | ((F.col("_b") > j) & (F.bit_count(_block(differ, j)) <= near))
    return met.where((F.bit_count(differ) <= radius) & ~earlier).drop("_b", "_v")


def _similarity(a: Column, b: Column) -> Column:
    zero = F.lit(0).cast("long")
    total = lambda s: F.aggregate(s, zero, lambda acc, x: acc + x["w"])
    weight_in = lambda s, h: total(F.filter(s, lambda y: y["h"] == h))
    shared = F.aggregate(a, zero, lambda acc, x: acc + F.least(x["w"], weight_in(b, x["h"])))
    return bind(shared, lambda s: s / (total(a) + total(b) - s))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): the best window of each document and item.

    ``_key`` tells documents with one doc_id apart.
    """
    items = benchmark.select(F.col("item_id").alias("item"), _lowered("text").alias("w")).where(F.size("w") > 0).distinct()
    spots = items.select(F.size("w").alias("_size"), F.posexplode(F.transform(_starts(F.col("w")), lambda i: _shingle(F.col("w"), i))).alias("_q", "_h")).distinct()
    spots = land(spots, "item-shingles")
    bounded = spots.count() <= MAX_BROADCAST_ROWS
    texts = docs.where(F.col(text).rlike(WORDED)).select(F.col("doc_id").alias("_doc"), row_key(text).alias("_key"), F.col(text).alias("_text"))
    cut = texts.select("_doc", "_key", _lowered("_text").alias("_w")).select("*", F.size("_w").alias("_n"))
    hashed = cut.select("_doc", "_key", "_n", F.posexplode(F.transform(_starts(F.col("_w")), lambda i: _shingle(F.col("_w"), i))).alias("_p", "_h"))
    hits = hashed.join(F.broadcast(spots) if bounded else spots, "_h")
    size = F.least("_size", "_n")
    first = F.greatest(F.lit(0), F.least(F.col("_p") - F.col("_q"), F.col("_n") - size))
    places = hits.select("_doc", "_key", first.alias("_first"), size.alias("_size")).distinct()
    per_doc = land(places.groupBy("_doc", "_key").agg(F.collect_list(F.struct("_first", "_size")).alias("_places")), "window-places")
    held = texts.where(maybe_in(per_doc.select("_key"), F.col("_key"))).withColumnsRenamed({"_doc": "_d", "_key": "_k"})
    cut = per_doc.join(held, per_doc._doc.eqNullSafe(held._d) & (per_doc._key == held._k))
    cut = cut.select("_doc", "_key", "_places", _lowered("_text").alias("_w"))
    cut = cut.select(
        "_doc", "_key",
        F.explode(F.transform("_places", lambda x: F.struct(
            x["_first"].alias("first"), x["_size"].alias("size"),
            F.array_join(F.slice(F.col("_w"), x["_first"] + 1, x["_size"]), " ").alias("window"),
        ))).alias("_x"),
    )
    windows = land(cut.select("_doc", "_key", F.col("_x.first").alias("_first"), F.col("_x.size").alias("_size"), F.col("_x.window").alias("_window"), F.md5("_x.window").alias("_id")), "windows")
    apart = windows.groupBy("_id").agg(F.any_value("_window").alias("_window"))
    apart = land(fingerprints(apart.withColumn("_found", F.split("_window", " ")), "_found").select("_id", "shingles", "simhash"), "window-prints")
    named = items.select("item", "w", F.md5(F.array_join("w", " ")).alias("_entry"))
    entries = land(fingerprints(named.select("_entry", "w").distinct(), "w").select("_entry", "shingles", "simhash"), "item-prints")
    pairs = hamming_pairs(apart.select("_id", "simhash"), entries.select("_entry", "simhash"), radius)
    pairs = pairs.select("_id", F.col("r__entry").alias("_entry"))
    met = pairs.join(apart.select("_id", "shingles"), "_id").join(entries.select("_entry", F.col("shingles").alias("_wanted")), "_entry")
    met = met.withColumn("similarity", _similarity(F.col("shingles"), F.col("_wanted"))).where(F.col("similarity") >= threshold)
    found = met.join(named.select("item", "_entry"), "_entry").select("_id", F.col("item").alias("item_id"), "similarity")
    best = F.max_by(F.struct("similarity", F.col("_first").alias("first_word"), F.col("_size").alias("n_words")), F.struct("similarity", -F.col("_first"), -F.col("_size")))
    return (
        windows.drop("_window").join(found, "_id").groupBy("_doc", "_key", "item_id").agg(best.alias("_best"))
        .select(F.col("_doc").alias("doc_id"), "_key", "item_id", F.col("_best.similarity").alias("similarity"), F.col("_best.first_word").cast("long").alias("first_word"), F.col("_best.n_words").cast("long").alias("n_words"))
    )


def apply_decontamination(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents in which no item was found, with the columns of ``docs``."""
    bad = contaminated(docs, benchmark, **limits).select(F.col("doc_id").alias("_doc"), "_key").distinct()

    def keep(inner: DataFrame) -> DataFrame:
        keyed = inner.withColumn("_k", row_key())
        return keyed.join(bad, keyed.doc_id.eqNullSafe(bad._doc) & (keyed._k == bad._key), "left_anti").drop("_k")

    return set_apart(docs, {"doc_id", "text"}, keep)
