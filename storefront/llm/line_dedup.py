"""Line dedup: repeated runs of lines, found by a suffix array over line-ID sequences.

A document is the sequence of its lines with a word. Lines that stand once in the corpus
end a run, so only runs of repeated lines with ``min_words`` words or more are held. The
suffixes of these runs are ranked by prefix doubling: at level k a suffix carries the left
end of its longest-common-prefix interval of depth 2**k, that is the number of suffixes
whose first 2**k lines are smaller; a pair of such ranks gives the next level. Distinct
pairs, with their counts, are put in order by a range partitioning, so no rank needs all
suffixes, or all of one interval, in one task.

A passage is the fewest lines from a place on that hold ``min_words`` words (at most
``min_words`` lines, which bounds the levels). Places with the same passage share an
interval, named by the ranks of its first and last 2**k lines. All but the interval's first
place, by (doc_id, text, line), are later copies, and their lines are deleted; runs longer
than a passage go with the passages they are made of, so what is deleted of a run is maximal.

Cases: NULL and wordless texts stay as they are; rows repeated whole are one document and
each keeps the same text; a NULL doc_id comes first; lines are equal only if all
characters are (128-bit digests are compared); other columns pass through, but for one called
``n_removed_lines``, which gives way (``apply_line_dedup`` returns it too); a very long text is
one row like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storefront.llm.common import Scratch, land, row_key, set_apart, shuffle_width, words

MIN_WORDS = 50
DOC = ("_doc", "_text")


def _ranked(groups: DataFrame, keys: list[str], held: Scratch) -> DataFrame:
    """``groups`` (distinct keys with ``_n`` members) with ``_rank``: members with smaller keys."""
    spark = groups.sparkSession
    groups = held.land(groups, "line-groups")
    parts = groups.repartitionByRange(shuffle_width(spark), *keys).withColumn("_part", F.spark_partition_id())
    parts = held.land(parts, "line-order")
    # one row per partition: as many as the shuffle width, whatever the input
    sums = parts.groupBy("_part").agg(F.sum("_n").alias("_sum"))
    start = F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("_part").alias("_p"), start.alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    within = parts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = within.join(F.broadcast(starts), within._part == starts._p)
    return joined.select(*keys, (F.col("_start") + F.col("_before")).alias("_rank"))


def repeated_runs(docs: DataFrame, held: Scratch, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Places in runs of repeated lines: ``_doc _text _run _at _line`` (number of the line),
    ``_id`` (digest) and ``_need`` (lines of the passage that begins here, or NULL)."""
    lines = F.filter(
        F.transform(
            F.split(text, "\n"),
            lambda x, i: F.struct(i.alias("line"), F.size(words(x)).alias("w"), F.unhex(F.md5(x)).alias("id")),
        ),
        lambda x: x["w"] > 0,
    )
    texts = docs.where(F.col(text).isNotNull()).select(F.col("doc_id").alias("_doc"), row_key(text).alias("_text"), lines.alias("_lines"))
    texts = texts.groupBy(*DOC).agg(F.first("_lines").alias("_lines"))
    placed = held.land(texts.select(*DOC, F.posexplode("_lines").alias("_at", "_l")).select(
        *DOC, "_at", F.col("_l.line").alias("_line"), F.col("_l.w").alias("_w"), F.col("_l.id").alias("_id")
    ), "lines")
    again = placed.groupBy("_id").agg(F.count("*").alias("_n")).where("_n > 1").select("_id")
    tied = placed.join(again, "_id", "left_semi")
    of_doc = Window.partitionBy(*DOC).orderBy("_at")
    tied = tied.withColumn("_run", F.col("_at") - F.row_number().over(of_doc))
    run = Window.partitionBy(*DOC, "_run")
    ahead = F.coalesce(F.sum("_w").over(run.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tied = tied.withColumns({"_ahead": ahead, "_all": F.sum("_w").over(run)}).where(F.col("_all") >= min_words)
    reach = F.count("*").over(run.orderBy("_ahead").rangeBetween(0, min_words - 1))
    need = F.when(F.col("_all") - F.col("_ahead") >= min_words, reach.cast("int"))
    return tied.select(*DOC, "_run", "_at", "_line", "_id", need.alias("_need"))


def later_copies(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(_doc, _text, _gone): which lines with a word to delete, a row per document that loses any."""
    held, levels, placed = Scratch(), Scratch(), Scratch()
    runs = held.land(repeated_runs(docs, placed, text, min_words), "line-runs")
    placed.clear()
    ranks = _ranked(runs.groupBy("_id").agg(F.count("*").alias("_n")), ["_id"], held)
    level = levels.land(runs.join(ranks, "_id").drop("_id"), "suffixes")
    held.clear()
    deepest = level.agg(F.max("_need")).first()[0] or 0
    run = Window.partitionBy(*DOC, "_run").orderBy("_at")
    members, step = [], 1
    while step <= deepest:
        # passages of step to 2 * step - 1 lines: the interval of their first and last `step`
        ends = level.withColumn("_ends", F.collect_list("_rank").over(run.rowsBetween(0, step)))
        passages = ends.where((F.col("_need") >= step) & (F.col("_need") < 2 * step))
        last = F.element_at("_ends", F.col("_need") - step + 1)
        members.append(passages.select(*DOC, "_at", "_need", F.col("_rank").alias("_left"), last.alias("_right")))
        if 2 * step <= deepest:
            level = _doubled(level, step, levels)
        step *= 2
    if not members:
        return level.where("false").groupBy(*DOC).agg(F.collect_list("_at").alias("_gone"))
    found = members[0].withColumn("_level", F.lit(0))
    for k, more in enumerate(members[1:], 1):
        found = found.unionAll(more.withColumn("_level", F.lit(k)))
    found = land(found, "passages")
    levels.clear()
    interval = ["_level", "_left", "_right"]
    place = F.struct(*DOC, "_at")
    firsts = found.groupBy(*interval).agg(F.min(place).alias("_first"), F.count("*").alias("_copies")).where("_copies > 1")
    later = found.join(firsts, interval).where(~place.eqNullSafe(F.col("_first")))
    covered = F.sequence(F.col("_at"), F.col("_at") + F.col("_need") - 1)
    return later.groupBy(*DOC).agg(F.array_distinct(F.flatten(F.collect_list(covered))).alias("_gone"))


def _doubled(level: DataFrame, step: int, levels: Scratch) -> DataFrame:
    """The suffixes with their ranks by twice as many lines; past a run's end stands -1."""
    held = Scratch()
    run = Window.partitionBy(*DOC, "_run").orderBy("_at")
    after = F.coalesce(F.lead("_left", step).over(run), F.lit(-1).cast("long"))
    pairs = held.land(level.withColumnRenamed("_rank", "_left").withColumn("_right", after), "suffix-pairs")
    order = _ranked(pairs.groupBy("_left", "_right").agg(F.count("*").alias("_n")), ["_left", "_right"], held)
    doubled = levels.land(pairs.join(order, ["_left", "_right"]).drop("_left", "_right"), "suffixes")
    held.clear()
    return doubled


def line_dedup(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs taken out of ``text``, and ``n_removed_lines``."""
    return set_apart(docs, {"doc_id", text}, lambda inner: _line_dedup(inner, text, min_words))


def _line_dedup(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    gone = later_copies(docs, text, min_words)
    keyed = docs.withColumn("_key", row_key(text))
    joined = keyed.join(gone, keyed.doc_id.eqNullSafe(gone._doc) & (keyed._key == gone._text), "left")
    joined = joined.withColumn("_parts", F.when(F.col("_gone").isNotNull(), F.split(text, "\n")))
    every = F.sequence(F.lit(0), F.size("_parts") - 1)
    worded = F.filter(every, lambda i: F.get(F.col("_parts"), i).rlike(r"[^\x20\x09-\x0D]"))
    joined = joined.withColumn("_worded", worded)
    deleted = F.transform("_gone", lambda o: F.get(F.col("_worded"), o))
    rest = F.transform(F.array_except(every, deleted), lambda i: F.get(F.col("_parts"), i))
    return joined.withColumns(
        {
            text: F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(rest, "\n")),
            "n_removed_lines": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        }
    ).drop("_key", "_doc", "_text", "_gone", "_parts", "_worded")


def apply_line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The same with the columns of ``docs`` only; ``n_chars`` follows the text."""

    def clean(inner: DataFrame) -> DataFrame:
        cleaned = line_dedup(inner, min_words=min_words)
        if "n_chars" in inner.columns:
            n_chars = F.when(F.col("n_removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
            cleaned = cleaned.withColumn("n_chars", n_chars)
        return cleaned.drop("n_removed_lines")

    return set_apart(docs, {"doc_id", "text", "n_chars"}, clean).select(*[F.col(f"`{c}`") for c in docs.columns])
