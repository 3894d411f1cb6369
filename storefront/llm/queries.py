"""Registered queries of the text operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
import storefront.llm.structure_queries  # noqa: F401
from storefront.llm import (
    bpe,
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    quality_classifier,
    quality_rules,
    toxicity,
    url_filter,
)
from storefront.llm.common import documents, load
from storefront.plans.registry import query

_WORDS = r"[x FOR x IN regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+') IF x <> '']"


@query(
    "op1_quality_rules",
    rf"""WITH t AS (
      SELECT row_number() OVER () AS rid, doc_id, source, text, {_WORDS.format("text")} AS ws FROM documents
    ), grams AS (
      SELECT rid, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) > 2)
    ), again AS (
      SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
    ), repeated AS (
      SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(j) GROUP BY rid
    ), lines AS (
      SELECT rid, source, text, line, {_WORDS.format("line")} AS lw
      FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM t)
    ), worded AS (
      SELECT *, regexp_replace(lower(array_to_string(lw, ' ')), '[0-9]+', '0', 'g') AS norm FROM lines WHERE len(lw) > 0
    ), dups AS (
      SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY rid
    ), hosts AS (
      SELECT source, count(DISTINCT coalesce(text, '')) + max((text IS NULL)::int) * 0 AS n FROM documents GROUP BY source
    ), templates AS (
      SELECT w.source, norm FROM worded w JOIN hosts h ON w.source IS NOT DISTINCT FROM h.source
      GROUP BY w.source, norm, h.n HAVING count(DISTINCT text) >= {quality_rules.MIN_DOCS}
        AND count(DISTINCT text) > {quality_rules.MAX_SHARE} * h.n
    ), removed AS (
      SELECT rid, count(*) AS n_removed_lines, sum(len(lw)) AS n_removed_words
      FROM worded w JOIN templates p ON w.norm = p.norm AND w.source IS NOT DISTINCT FROM p.source GROUP BY rid
    ), figures AS (
      SELECT t.rid, doc_id, len(ws)::bigint AS n_words, length(array_to_string(ws, ''))::bigint AS word_chars,
        (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
        coalesce(n_dup_lines, 0)::bigint AS n_dup_lines, coalesce(n_repeat_words, 0)::bigint AS n_repeat_words,
        coalesce(n_removed_lines, 0)::bigint AS n_removed_lines, coalesce(n_removed_words, 0)::bigint AS n_removed_words
      FROM t LEFT JOIN dups USING (rid) LEFT JOIN repeated USING (rid) LEFT JOIN removed USING (rid)
    )
    SELECT * EXCLUDE (rid), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND NOT n_removed_words > {quality_rules.MAX_REMOVED} * n_words AS kept
    FROM figures""",
)
def op1_quality_rules(spark, folder):
    judged = quality_rules.quality_rules(documents(spark, folder))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_removed_lines", "n_removed_words", "base_failed", "kept",
    )


@query("op2_decontamination")
def op2_decontamination(spark, folder):
    """Every document and item that share a window, with the best window."""
    return decontamination.contaminated(documents(spark, folder), load(spark, folder, "benchmark")).drop("_key")


@query("op3_language_id")
def op3_language_id(spark, folder):
    """lang is read to learn from; a prediction sees the text only."""
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    return language_id.identify(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query(
    "op4_url_filter",
    r"""WITH p AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
      FROM pages
    ), r AS (
      SELECT *, CASE
        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
      FROM p
    )
    SELECT page_id, host, path, rule, CASE
      WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
      WHEN list_has_any(string_split(host, '.'), ['spam-farm', 'cheap-pills']) THEN 'block' ELSE 'allow' END AS verdict
    FROM r""",
)
def op4_url_filter(spark, folder):
    pages = load(spark, folder, "pages").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    keys = pages.select(host.alias("host"), path.alias("path")).where(url_filter.listed_by_label(F.col("host")))
    listed = keys.select(F.concat("host", "path").alias("key")).distinct()
    return url_filter.judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


@query("op6_toxicity")
def op6_toxicity(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return toxicity.severity(docs, load(spark, folder, "labels"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark, folder):
    docs = documents(spark, folder).select("doc_id", "text")
    return quality_classifier.quality_scores(docs, load(spark, folder, "labels"))


_LICENSE_WORDS = (
    "[x FOR x IN regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']"
)
_PHRASE_ROWS = ", ".join(f"('{p}', '{label}')" for p, label in license_scan.PHRASES.items())
_TEMPLATE_ROWS = ", ".join(f"('{t}', '{label}')" for t, label in license_scan.TEMPLATES.items())


@query(
    "op8_license_scan",
    f"""WITH t AS (
      SELECT row_number() OVER () AS rid, doc_id, text, {_LICENSE_WORDS.format("coalesce(text, '')")} AS ws FROM documents
    ), phrases(phrase, label) AS (VALUES {_PHRASE_ROWS}
    ), templates(template, label) AS (VALUES {_TEMPLATE_ROWS}
    ), starts AS (
      SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM t
    ), places AS (
      SELECT rid, i - 1 AS spot, label FROM starts JOIN phrases
        ON array_to_string(ws[i : i + len(string_split(phrase, ' ')) - 1], ' ') = phrase
    ), base AS (
      SELECT rid, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS base FROM places GROUP BY rid
    ), lines AS (
      SELECT rid, {_LICENSE_WORDS.format("line")} AS lw
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM t) WHERE contains(lower(line), 'licen') OR contains(lower(line), 'permi')
    ), held AS (
      SELECT rid, label, len(list_intersect(list_distinct(lw), list_distinct(string_split(template, ' '))))
        / len(list_distinct(string_split(template, ' '))) AS containment FROM lines CROSS JOIN templates
    ), blocks AS (
      SELECT rid, list(DISTINCT label) AS found, max(containment) AS best FROM held
      WHERE containment >= {license_scan.THRESHOLD} GROUP BY rid
    )
    SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word::bigint AS first_word,
      last_word::bigint AS last_word, array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(coalesce(base, []) || coalesce(found, []))), ',') AS labels,
      CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::double AS score
    FROM t LEFT JOIN base USING (rid) LEFT JOIN blocks USING (rid)""",
)
def op8_license_scan(spark, folder):
    return license_scan.license_scan(documents(spark, folder).select("doc_id", "text"))


@query("op5_bpe")
def op5_bpe(spark, folder):
    return bpe.digests(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op9_line_dedup",
    rf"""WITH t AS (
      SELECT row_number() OVER () AS rid, doc_id, text FROM documents
    ), firsts AS (
      SELECT min(rid) AS rid, doc_id, text FROM t WHERE text IS NOT NULL GROUP BY doc_id, text
    ), lines AS (
      SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS line_no FROM firsts
    ), worded AS (
      SELECT rid, doc_id, line, line_no, len({_WORDS.format("line")}) AS w FROM lines
    ), placed AS (
      SELECT *, row_number() OVER d AS i, sum(w) OVER d - w AS ahead FROM worded WHERE w > 0
      WINDOW d AS (PARTITION BY rid ORDER BY line_no)
    ), passages AS (
      SELECT a.rid, a.doc_id, a.i, max(b.i) AS last, string_agg(b.line, chr(10) ORDER BY b.i) AS passage
      FROM placed a JOIN placed b ON a.rid = b.rid AND b.i >= a.i AND b.ahead - a.ahead < {line_dedup.MIN_WORDS}
      GROUP BY ALL HAVING sum(b.w) >= {line_dedup.MIN_WORDS}
    ), later AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id NULLS FIRST, rid, i) AS nth FROM passages)
      WHERE nth > 1
    ), gone AS (
      SELECT DISTINCT p.rid, p.line_no FROM later l JOIN placed p ON p.rid = l.rid AND p.i BETWEEN l.i AND l.last
    ), rest AS (
      SELECT rid, doc_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (g.line_no IS NULL) AS cleaned,
        count(g.line_no) AS n_removed_lines
      FROM lines LEFT JOIN gone g USING (rid, line_no) GROUP BY rid, doc_id
    ), cleaned AS (
      SELECT f.doc_id, f.text, coalesce(r.cleaned, '') AS cleaned, n_removed_lines FROM firsts f JOIN rest r USING (rid)
    )
    SELECT t.doc_id, coalesce(c.n_removed_lines, 0)::bigint AS n_removed_lines,
      length(c.cleaned)::bigint AS n_chars, sha256(c.cleaned) AS text_sha256
    FROM t LEFT JOIN cleaned c ON t.doc_id IS NOT DISTINCT FROM c.doc_id AND t.text = c.text""".replace(
        "FILTER (g.line_no", "FILTER (WHERE g.line_no"
    ),
)
def op9_line_dedup(spark, folder):
    cleaned = line_dedup.line_dedup(documents(spark, folder))
    return cleaned.select(
        "doc_id", "n_removed_lines", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


@query(
    "op10_ngram_join",
    r"""WITH RECURSIVE t AS (
      SELECT row_number() OVER () AS rid, doc_id,
        [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x20\x09-\x0D]+') IF x <> ''] AS ws
      FROM documents
    ), shingles AS (
      SELECT DISTINCT rid, array_to_string(ws[i : i + 4], ' ') AS s
      FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM t WHERE len(ws) > 0)
    ), sizes AS (
      SELECT rid, count(*) AS n FROM shingles GROUP BY rid
    ), pairs AS (
      SELECT a.rid AS a, b.rid AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL
    ), linked AS MATERIALIZED (
      SELECT a, b FROM pairs JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
    ), reached(rid, other) AS (
      SELECT rid, rid FROM t UNION SELECT r.rid, l.b FROM reached r JOIN linked l ON l.a = r.other
    )
    SELECT t.doc_id, coalesce(any_value(s.n), 0)::bigint AS n_shingles, coalesce(min(o.doc_id), t.doc_id) AS component_id
    FROM t JOIN reached r ON r.rid = t.rid JOIN t o ON o.rid = r.other LEFT JOIN sizes s ON s.rid = t.rid
    GROUP BY t.rid, t.doc_id""",
)
def op10_ngram_join(spark, folder):
    return ngram_join.near_duplicates(documents(spark, folder)).select("doc_id", "n_shingles", "component_id")


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
