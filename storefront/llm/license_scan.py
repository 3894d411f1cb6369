"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a line. A template is found in a block if at least ``threshold`` of its distinct
words stand there. Words are ordered by how many blocks hold them, rarest first. A block
that holds ``t`` of a template's words holds one of its rarest ``size - t + 1`` words, so
only these prefixes are indexed; blocks with fewer than ``t`` words of all templates are
passed over, as are meetings so late in both orders that too few words are left behind
them. What remains is compared word by word.

The templates are a parameter of at most ``MAX_TEMPLATE_WORDS`` distinct words, and only they
and their counts go to all tasks. Texts are never shuffled.

Cases: a NULL text is the empty one; wordless phrases and templates match nothing; repeated
rows each get their row; a NULL doc_id is kept; extra columns are left alone, but for those
called like a column of the result, which give way to it; a very long text is one row like
any other; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import reduce
from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import land, row_key, set_apart

# What stands between words, phrases with their labels, templates with theirs.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "permission to use copy modify and or distribute this software for any purpose is hereby granted": "isc",
}
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 10_000


def _lower(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _split(text: Column) -> Column:
    return F.filter(F.split(text, BETWEEN), lambda w: w != "")


def parts_of(phrase: str) -> list[str]:
    """The words of a phrase, by the same rules as those of a text."""
    lowered = phrase.translate(str.maketrans(ascii_uppercase, ascii_lowercase))
    return [w for w in re.split(BETWEEN, lowered) if w]


def hint(phrases: list[list[str]]) -> str:
    """A pattern that every text with one of the phrases meets, for a cheap test ahead of the exact
    one: the longest word of each phrase, in any case, on its own."""
    longest = sorted({re.escape(max(parts, key=len)) for parts in phrases})
    return f"(?i)(?<![0-9a-z])(?:{'|'.join(longest)})(?![0-9a-z])"


def _places(found: Column, parts: list[str], label: str) -> Column:
    """(at, label) wherever ``parts`` stand one after the other."""

    def stands(i: Column) -> Column:
        same = [F.coalesce(F.get(found, i + j) == part, F.lit(False)) for j, part in enumerate(parts)]
        return reduce(Column.__and__, same)

    starts = F.filter(F.sequence(F.lit(0), F.size(found) - 1), stands)
    return F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))


def phrase_places(docs: DataFrame, text: str, phrases: dict[str, str]) -> DataFrame:
    """``docs`` with ``_key``, n_words, and ``_places``: (first word, label) of every phrase."""
    whole = F.coalesce(F.col(text), F.lit(""))
    wanted = [(parts, label) for parts, label in ((parts_of(p), label) for p, label in phrases.items()) if parts]
    may_hold = whole.rlike(hint([parts for parts, _ in wanted])) if wanted else F.lit(False)
    found = docs.withColumns(
        {
            "_key": row_key(text),
            "n_words": F.regexp_count(whole, F.lit(BETWEEN.replace("[", "[^", 1))).cast("long"),
            "_found": F.when(may_hold, _split(_lower(whole))),
        }
    )
    places = [_places(F.col("_found"), parts, label) for parts, label in wanted]
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    all_places = F.when(F.size("_found") > 0, F.concat(*places, none)).otherwise(none)
    return found.withColumn("_places", all_places).drop("_found")


def matching_blocks(
    docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, _key, block, label, containment) of every block and template that meet the threshold."""
    sets = {t: sorted(set(t.split())) for t in templates if t.split()}
    vocabulary = sorted({w for words in sets.values() for w in words})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_WORDS} distinct words")
    least = {t: max(1, ceil(threshold * len(words) - 1e-9)) for t, words in sets.items()}
    lines = docs.where(F.col(text).isNotNull()).select(
        F.col("doc_id"), row_key(text).alias("_key"), F.posexplode(F.split(text, "\n")).alias("block", "_line")
    )
    held = F.array_intersect(F.split(_low_if_needed(F.col("_line")), BETWEEN), F.lit(vocabulary))
    blocks = lines.select("doc_id", "_key", "block", held.alias("_held"))
    # how many blocks hold each word of the templates: as many rows as the templates have words
    counted = blocks.select(F.explode("_held").alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in counted}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    prefixes = []
    for t, words in sets.items():
        ordered = sorted(words, key=order.__getitem__)
        for at, w in enumerate(ordered[: len(words) - least[t] + 1]):
            prefixes.append((w, t, templates[t], ordered, at, least[t]))
    schema = "w string, template string, label string, words array<string>, at int, least int"
    entries = docs.sparkSession.createDataFrame(prefixes, schema)
    near = blocks.where((F.size("_held") >= min(least.values(), default=1)) & F.arrays_overlap("_held", F.lit(sorted({p[0] for p in prefixes}))))
    ranked = F.sort_array(F.transform("_held", lambda w: F.struct(F.array_position(F.lit(sorted(vocabulary, key=order.__getitem__)), w).alias("rank"), w.alias("w"))))
    near = near.withColumn("_held", F.transform(ranked, lambda x: x["w"]))
    probes = near.select("doc_id", "_key", "block", "_held", F.posexplode("_held").alias("_at", "w"))
    met = probes.join(F.broadcast(entries), "w")
    enough = F.size("_held") >= F.col("least")
    left_over = 1 + F.least(F.size("words") - F.col("at") - 1, F.size("_held") - F.col("_at") - 1)
    shared = F.size(F.array_intersect("words", "_held"))
    met = met.where(enough & (F.col("at") + left_over >= F.col("least"))).withColumn("_shared", shared).where("_shared >= least")
    return met.select("doc_id", "_key", "block", "label", (F.col("_shared") / F.size("words")).alias("containment")).distinct()


def _low_if_needed(line: Column) -> Column:
    """A-Z lower-cased; ``lower`` does the same on lines of ASCII characters, at less cost."""
    return F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(_lower(line))


def license_scan(docs: DataFrame, text: str = "text", phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``, without its text: n_words, n_base, first_word, last_word,
    base_labels, labels, and score (1 where a phrase stands, else the best containment, else 0)."""
    return set_apart(docs, {"doc_id", text}, lambda inner: _license_scan(inner, text, phrases, templates, threshold))


def _license_scan(docs: DataFrame, text: str, phrases: dict[str, str], templates: dict[str, str], threshold: float) -> DataFrame:
    blocks = matching_blocks(docs, text, templates, threshold)
    by_doc = land(
        blocks.groupBy(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")).agg(
            F.collect_set("label").alias("_labels"), F.max("containment").alias("_best")
        ), "license-blocks"
    )
    based = phrase_places(docs, text, phrases).drop(text)
    joined = based.join(by_doc, based.doc_id.eqNullSafe(by_doc._d) & (based._key == by_doc._k), "left")
    base = F.array_sort(F.array_distinct(F.transform("_places", lambda x: x["label"])))
    starts = F.transform("_places", lambda x: x["at"])
    empty = F.array().cast("array<string>")
    return joined.withColumns(
        {
            "n_base": F.size("_places").cast("long"),
            "first_word": F.array_min(starts),
            "last_word": F.array_max(starts),
            "base_labels": F.array_join(base, ","),
            "labels": F.array_join(F.array_sort(F.array_union(base, F.coalesce("_labels", empty))), ","),
            "score": F.when(F.size("_places") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))),
        }
    ).drop("_d", "_k", "_key", "_labels", "_best", "_places")
