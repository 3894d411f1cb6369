"""Quality rules: figures of each text, and how often its lines stand in a host's other documents.

A line is compared after lower-casing, with runs of white space as one space and runs of
digits as one 0, by a 64-bit hash. Per host, documents with equal texts count once, so
copies of one page are no template. A line in at least ``min_docs`` such documents and in
more than ``max_share`` of the host's is template text: it is taken out, and a document
that loses more than ``max_removed`` of its words is depleted and rejected.

Counts go by (host, line) after duplicates are dropped by (host, line, text), so a line in a
third of all documents is summed on the map side; the lines above the limits meet the
documents' lines in a join that Spark may split.

Cases: a NULL or empty text has no words and fails; a NULL host is a host of its own;
repeated rows each get their row; extra columns are left alone, but for those called like a
figure, which give way to it (``apply_quality_rules`` returns those too); a very long text is one row like
any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import bind, land, row_key, set_apart, words

MIN_DOCS = 20
MAX_SHARE = 0.02
MAX_REMOVED = 0.5


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_hash(line: Column) -> Column:
    spaced = F.regexp_replace(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.regexp_replace(F.lower(spaced), "[0-9]+", "0"))


def _repeat_words(found: Column) -> Column:
    """Words in 3-word windows that stand twice or more; ``found`` is an array of words."""

    def covered(ordered: Column) -> Column:
        # ordered: (hash, place) of every window; neighbours of equal hash are repeats
        return F.filter(
            ordered,
            lambda x, j: ((j > 0) & (F.get(ordered, j - 1)["h"] == x["h"]))
            | ((j + 1 < F.size(ordered)) & (F.get(ordered, j + 1)["h"] == x["h"])),
        )

    def width(places: Column) -> Column:
        # each window covers three words, fewer where the next one begins sooner
        steps = F.transform(
            places, lambda x, j: F.coalesce(F.least(F.get(places, j + 1) - x, F.lit(3)), F.lit(3))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def counted(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = bind(ordered, lambda s: F.sort_array(F.transform(covered(s), lambda x: x["i"])))
        heavy = bind(places, width)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(heavy)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - 3),
        lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)),
    )
    return F.when(F.size(found) < 6, _few(found)).otherwise(bind(windows, counted))


def _few(found: Column) -> Column:
    """The same for under six words, where a repeat needs windows that overlap."""
    n = F.size(found)
    window = lambda i: F.concat_ws("\n", F.get(found, F.lit(i)), F.get(found, F.lit(i + 1)), F.get(found, F.lit(i + 2)))
    first = (n >= 4) & (window(0) == window(1))
    second = (n >= 5) & (window(1) == window(2))
    apart = (n >= 5) & (window(0) == window(2))
    return (
        F.when((first & second) | apart, 5).when(first | second, 4).otherwise(0).cast("long")
    )


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the figures of each text and ``base_failed``."""
    held = docs.withColumns({"_words": words(F.col(text)), "_lines": _lines(F.col(text))})
    figures = held.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _repeat_words(F.col("_words")),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return figures.withColumn("base_failed", failed).drop("_words")


def template_lines(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """(host, line) of the lines above both limits, one row each."""
    texts = docs.select(
        F.col(host).alias("_host"), row_key(text).alias("_key"), F.array_distinct(F.transform(_lines(F.col(text)), line_hash)).alias("_hashes")
    )
    apart = texts.select("_host", "_key", F.explode("_hashes").alias("_line")).distinct()
    counted = apart.groupBy("_host", "_line").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_docs)
    hosts = texts.select("_host", "_key").distinct().groupBy("_host").agg(F.count("*").alias("_all"))
    above = counted.alias("c").join(hosts.alias("h"), F.col("c._host").eqNullSafe(F.col("h._host")))
    return above.where(F.col("_n") > max_share * F.col("_all")).select("c._host", "_line")


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    max_removed: float = MAX_REMOVED,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` (without its text unless asked) with the base figures, ``n_removed_lines``,
    ``n_removed_words``, ``removed`` (hashes of the lines taken out) and ``kept``."""
    limits = (host, text, min_docs, max_share, max_removed, keep_text)
    return set_apart(docs, {"doc_id", host, text}, lambda inner: _quality_rules(inner, *limits))


def _quality_rules(docs: DataFrame, host: str, text: str, min_docs: int, max_share: float, max_removed: float, keep_text: bool) -> DataFrame:
    templates = template_lines(docs, host, text, min_docs, max_share)
    where = docs.select(
        F.col(host).alias("_h"), F.col("doc_id").alias("_doc"), row_key(text).alias("_k"),
        F.explode(F.array_distinct(F.transform(_lines(F.col(text)), line_hash))).alias("_l"),
    )
    hits = where.join(templates, where._h.eqNullSafe(templates._host) & (where._l == templates._line), "left_semi")
    gone = hits.groupBy("_h", "_doc", "_k").agg(F.collect_set("_l").alias("removed"))

    hashed = base_rules(docs, text).withColumn("_key", row_key(text))
    hashed = hashed.withColumn(
        "_lines", F.transform("_lines", lambda x: F.struct(line_hash(x).alias("h"), F.size(words(x)).alias("w")))
    )
    if not keep_text:
        hashed = hashed.drop(text)
    joined = hashed.join(
        gone,
        hashed.doc_id.eqNullSafe(gone._doc) & (hashed._key == gone._k) & hashed[host].eqNullSafe(gone._h),
        "left",
    )
    taken = F.when(
        F.col("removed").isNotNull(), F.filter("_lines", lambda x: F.array_contains(F.col("removed"), x["h"]))
    ).otherwise(F.filter("_lines", lambda x: F.lit(False)))
    judged = joined.withColumn("_taken", taken).withColumns(
        {
            "n_removed_lines": F.size("_taken").cast("long"),
            "n_removed_words": F.aggregate("_taken", F.lit(0).cast("long"), lambda a, x: a + x["w"]),
        }
    )
    depleted = F.col("n_removed_words") > max_removed * F.col("n_words")
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).drop(
        "_lines", "_key", "_taken", "_h", "_doc", "_k"
    )


def apply_quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, without their template lines, with the columns of ``docs``.

    Other columns than doc_id, text and the host go under names of their own meanwhile.
    The judged rows are landed before the rejected ones go: a filter on ``kept`` would be
    moved ahead of the join, and the words computed again wherever the filter names them.
    """
    own = {"doc_id", "text", limits.get("host", "source")}
    inner = {c: c if c in own else f"_x{i}" for i, c in enumerate(docs.columns)}
    judged = quality_rules(docs.toDF(*inner.values()), keep_text=True, **limits)
    judged = land(judged.select(*inner.values(), "removed", "kept"), "judged-documents").where("kept")
    rest = F.array_join(
        F.filter(
            F.split("text", "\n"),
            lambda x: ~(x.rlike(r"[^\x20\x09-\x0D]") & F.array_contains(F.col("removed"), line_hash(x))),
        ),
        "\n",
    )
    cleaned = judged.withColumn("text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(rest))
    if "n_chars" in docs.columns:
        name = inner["n_chars"]
        changed = F.col("removed").isNotNull()
        cleaned = cleaned.withColumn(name, F.when(changed, F.length("text").cast("long")).otherwise(F.col(name)))
    return cleaned.select(*[F.col(i).alias(c) for c, i in inner.items()])
