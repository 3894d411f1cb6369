"""Registered queries of search, repair and manifest, each next to its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from storefront.llm import conversations, merkle, vector_search
from storefront.llm.common import documents, load
from storefront.plans.registry import query


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(a, b))"
    return f"xor(list_reduce([ord(c)::BIGINT FOR c IN string_split({text}, '')], lambda a, b: {bits}, 4294967295::BIGINT), 4294967295::BIGINT)"


@query(
    "op11_top_k",
    f"""WITH v AS (
      SELECT row_number() OVER () AS rid, vec_id, [floor({vector_search.SCALE} * x::double) FOR x IN embedding] AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
      SELECT a.rid, a.vec_id AS query_id, b.vec_id, b.rid AS other, list_inner_product(a.q, b.q)::bigint AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid AND len(a.q) = len(b.q)
    )
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, other)::int AS rank FROM scored
    ) WHERE rank <= 5""",
)
def op11_top_k(spark, folder):
    """The five highest integer inner products of every vector whose id is divisible by 50."""
    return vector_search.top_k(load(spark, folder, "embeddings"), 5, F.col("vec_id") % 50 == 0)


def _struct(cost: str, audit: str, said: str) -> str:
    return f"{{'c': {cost}, 'a': {audit}, 't': {said}}}"


def _edit(state: str, cost: str, edit: str, line: str = "''") -> str:
    return _struct(f"{state}.c + {cost}", f"{state}.a || '{edit}'", f"{state}.t || {line}")


_NEVER = 1_000_000_000


def _insert(state: str, role: str) -> str:
    return _edit(state, str(conversations.INSERT), "I", f"chr(10) || '{role}:'")


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _row_edits(source: str, target: str) -> str:
    """Keep and rerole from a state to the state after a role (its whole name)."""
    keep = _edit(source, f"CASE WHEN gone OR initial <> '{target[0]}' THEN {_NEVER} ELSE cut END", "K", "chr(10) || role || ':' || text")
    if target == "system":
        return keep
    return keep + ", " + _edit(source, f"CASE WHEN gone THEN {_NEVER} ELSE cut + {conversations.REROLE} END", "R", f"chr(10) || '{target}:' || text")


_DELETED = {s: _edit(s, str(conversations.DELETE), "D") for s in ("s0", "s1", "s2", "s3")}


@query(
    "op12_conversation_repair",
    f"""WITH RECURSIVE kinds AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 AS kind FROM conversations
    ), damaged AS (
      SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM (SELECT * FROM kinds WHERE kind <> 0 UNION ALL SELECT * FROM kinds WHERE kind = 3)
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS rn,
        rtrim(text, {_SPACES}) AS said, left(role, 1) AS initial FROM damaged
    ), judged AS (
      SELECT *, said = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
        right(said, 1) NOT IN ('.', '!', '?') AS short, lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS two FROM placed
    ), steps AS (
      SELECT conv_id, rn, role, text, initial, blank OR again AS gone, CASE WHEN short THEN {conversations.CUT} ELSE 0 END AS cut FROM judged
    ), figures AS (
      SELECT conv_id, max(rn) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
        count(*) FILTER (WHERE short AND NOT again AND NOT blank) AS truncated,
        count(*) FILTER (WHERE two NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
    ), walk(conv_id, rn, s0, s1, s2, s3) AS (
      SELECT DISTINCT conv_id, 0::bigint, {_struct("0", "''", "''")}, {_struct(str(_NEVER), "''", "''")},
        {_struct(str(_NEVER), "''", "''")}, {_struct(str(_NEVER), "''", "''")} FROM conversations
      UNION ALL
      SELECT conv_id, rn, {_DELETED["s0"]}, list_min([{_DELETED["s1"]}, {_row_edits("s0", "system")}]),
        list_min([{_DELETED["s2"]}, {_row_edits("s0", "user")}, {_row_edits("s1", "user")}, {_row_edits("s3", "user")}]),
        list_min([{_DELETED["s3"]}, {_row_edits("s2", "assistant")}])
      FROM (
        SELECT w.conv_id, w.rn + 1 AS rn, role, text, initial, gone, cut, s0, s1, s2,
          list_min([s3, {_insert("s2", "assistant")}]) AS s3
        FROM (
          SELECT conv_id, rn, s0, s1, s3,
            list_min([s2, {", ".join(_insert(s, "user") for s in ("s0", "s1", "s3"))}]) AS s2 FROM walk
        ) w JOIN steps r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.rn = w.rn + 1
      )
    ), done AS (
      SELECT w.conv_id, f.* EXCLUDE (conv_id), list_min([s0, s3, {_insert("s2", "assistant")},
        {_insert("(" + _insert("s1", "user") + ")", "assistant")}]) AS best
      FROM walk w LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.rn = coalesce(f.n, 0)
    )
    SELECT conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank, coalesce(duplicate, 0)::bigint AS duplicate,
      coalesce(truncated, 0)::bigint AS truncated, coalesce(illegal, 0)::bigint AS illegal, best.c::bigint AS cost, best.a AS audit,
      sha256(substr(best.t, 2)) AS repaired_sha256 FROM done""",
)
def op12_conversation_repair(spark, folder):
    """Faults of each damaged conversation, and the cheapest edits that repair it."""
    return conversations.repair_conversations(load(spark, folder, "conversations"))


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}::varchar, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_SQL_LEVELS = 8  # of 8 children each: 16 million documents of a language


def _level(k: int, name: str) -> str:
    """Runs of level ``k`` and the nodes of the next; a tree that is down to one node stays."""
    return f"""{name}_runs{k} AS (
      SELECT tree, i // 8 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {name}{k} GROUP BY tree, i // 8
    ), {name}{k + 1} AS (
      SELECT tree, run AS i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h, (n + 7) // 8 AS n FROM {name}_runs{k}
    )"""


def _climb(k: int, name: str, before: str) -> str:
    """The proof and the folded root after level ``k`` of a tree."""
    at = "(i % 8)::int"
    return f"""{name}_up{k} AS (
      SELECT u.* REPLACE (i // 8 AS i,
        CASE WHEN r.n = 1 THEN proof ELSE proof || array_to_string(hs[: {at}] || hs[{at} + 2 :], '') END AS proof,
        CASE WHEN r.n = 1 THEN folded ELSE sha256(array_to_string(hs[: {at}] || [folded] || hs[{at} + 2 :], '')) END AS folded)
      FROM {before} u JOIN {name}_runs{k} r ON r.tree = u.tree AND r.run = u.i // 8
    )"""


@query(
    "op13_merkle_manifest",
    f"""WITH leaves AS (
      SELECT doc_id, lang, {_leaf("text")} AS leaf, CASE WHEN {_crc32("doc_id::varchar")} % 3 = 0
          THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed FROM documents
    ), low0 AS (
      SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, doc_id, leaf AS h, changed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM leaves
    ), {", ".join(_level(k, "low") for k in range(_SQL_LEVELS))}, top0 AS (
      SELECT 0 AS tree, tree AS i, h, count(*) OVER () AS n FROM low{_SQL_LEVELS}
    ), {", ".join(_level(k, "top") for k in range(3))}, start AS (
      SELECT doc_id, tree, tree AS own, i, h AS leaf, '' AS proof, coalesce(changed, h) AS folded FROM low0
    ), {", ".join(_climb(k, "low", f"low_up{k - 1}" if k else "start") for k in range(_SQL_LEVELS))}, below AS (
      SELECT * REPLACE (0 AS tree, tree AS i) FROM low_up{_SQL_LEVELS - 1}
    ), {", ".join(_climb(k, "top", f"top_up{k - 1}" if k else "below") for k in range(3))}
    SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
    FROM top_up2 u JOIN low{_SQL_LEVELS} s ON s.tree = u.own CROSS JOIN top3 r""",
)
def op13_merkle_manifest(spark, folder):
    """Leaf, roots and proof of every document; tampered ones are not verified."""
    proofs = merkle.manifest(merkle.document_leaves(documents(spark, folder)))
    return proofs.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
