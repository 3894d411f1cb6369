"""Top-k search, conversation repair and the Merkle manifest against brute force."""

import random
import zlib
from hashlib import md5, sha256
from math import isfinite

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as registered
from storefront.llm import conversations, merkle, vector_search
from tests.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_top_k", "op12_conversation_repair", "op13_merkle_manifest"])
def test_query_equals_sql(name, spark):
    assert differences(registered.queries()[name](spark, SMALL), connect(SMALL), registered.oracle_sql()[name]) == []


# -- top-k search

VECTORS = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("score", T.StringType())]
)


def _floors(v):
    return [int(256 * x // 1) for x in v]


def _expected(rows, k):
    good = [(i, n, _floors(v)) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and isfinite(x) for x in v)]
    out = []
    for i, n, q in good:
        if i is None or i % 2:
            continue
        scored = [(-max(min(sum(a * b for a, b in zip(q, v)), 2**63 - 1), -(2**63)), j is None, j or 0) for j, m, v in good if m != n and len(v) == len(q)]
        out += [(i, r, None if null else j, -s) for r, (s, null, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def test_top_k_against_all_pairs(spark, rows):
    draw = random.Random(11)
    near = [draw.randint(-3, 3) / 4 for _ in range(6)]
    table = [(i, [draw.randint(-3, 3) / 4 for _ in range(6)]) for i in range(160)]
    table += [(i, near) for i in range(160, 260)]  # a group of equal vectors: ties by id
    table += [(7, table[7][1]), (8, table[8][1]), (None, near), (None, None), (300, None), (302, [1.0, None]), (304, [float("nan")] * 6)]
    table += [(306, [float("inf")] * 6), (308, []), (310, []), (312, [0.5, 0.25]), (313, [0.5, -0.25]), (314, [1.0])]
    made = spark.createDataFrame([(i, v, "x") for i, v in table], VECTORS)
    got = rows(vector_search.top_k(made, 5, F.col("vec_id") % 2 == 0))
    assert got == _expected(table, 5)


def test_top_k_of_large_numbers_and_nothing(spark, rows):
    table = [(i, [float(3 ** (i % 7)) * 1e5, 1e7 + i, -(2.0**40) * i]) for i in range(40)]
    made = spark.createDataFrame([(i, v, "x") for i, v in table], VECTORS)
    assert rows(vector_search.top_k(made, 3, F.col("vec_id") % 2 == 0)) == _expected(table, 3)
    assert rows(vector_search.top_k(made.where("false"), 3, F.col("vec_id") % 2 == 0)) == []


def test_leaves_are_left_out():
    import numpy as np

    draw = np.random.default_rng(3)
    values = np.concatenate([draw.normal(c, 1, (400, 8)) for c in (-40, 0, 40)]).round()
    tree = vector_search.BallTree(vector_search.Vectors(range(1200), range(1200), values), leaf=32)
    queries = vector_search.Vectors([5000], [5000], np.full((1, 8), 40.0))
    search = vector_search.Search(queries, 5, vector_search._known([None], [None]))
    scanned, scan = [], search.scan
    search.scan = lambda *a: (scanned.append(a), scan(*a))
    search.run(tree)
    assert len(scanned) < len(tree.spans) / 2
    best = sorted(((-int(s), i) for i, s in enumerate(values @ np.full(8, 40.0))))[:5]
    assert [(-s, i) for s, i in zip(search.own[1], search.own[2])] == best


# -- conversation repair


def _least_edits(codes):
    """All walks at once, with their lists written out."""
    after = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def offer(held, t, cost, edits):
        held[t] = min(held.get(t, (10**9, "")), (cost, edits))

    def inserted(held):
        for _ in range(3):
            more = dict(held)
            for s, (c, x) in held.items():
                for r in "ua":
                    if s in after[r]:
                        offer(more, after[r][s], c + 5, x + "I")
            held = more
        return held

    best = {0: (0, "")}
    for code in codes:
        now, kind, gone = {}, chr(code).lower(), code == conversations.GONE
        cut = 5 if chr(code).isupper() and not gone else 0
        for s, (c, x) in inserted(best).items():
            offer(now, s, c + 2, x + "D")
            if gone:
                continue
            if s in after.get(kind, {}):
                offer(now, after[kind][s], c + cut, x + "K")
            for r in "ua":
                if s in after[r]:
                    offer(now, after[r][s], c + cut + 1, x + "R")
        best = now
    return min(v for s, v in inserted(best).items() if s in (0, 3))


def test_crossings_against_all_walks():
    draw = random.Random(4)
    for _ in range(3000):
        codes = bytes(ord(draw.choice("suaSUAxXDuaua")) for _ in range(draw.randint(0, 14)))
        cost, audit = _least_edits(codes)
        assert conversations.repair(codes) == (audit, cost)
        if len(codes) > 2:
            cuts = sorted(draw.sample(range(1, len(codes)), 2))
            parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
            states, total = conversations.borders([conversations.matrix_of(p) for p in parts])
            found = "".join(conversations.solve(p, a, b) for p, a, b in zip(parts, states, states[1:]))
            assert (found + conversations._tails()[states[-1]], total) == (audit, cost)


def _repaired(rows):
    """rows: (turn, role, text) of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r[2].encode()).digest()))
    seen, codes, faults = set(), bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        said, cut = text.strip(" \t\n\x0b\x0c\r"), False
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        cut = fault == "truncated"
        codes.append(conversations.GONE if fault in ("blank", "duplicate") else conversations.row_code(role[:1], cut))
    cost, audit = _least_edits(bytes(codes))
    lines, left = [], list(rows)
    n = len(audit) - audit.count("D")
    for edit in audit:
        role = ["user", "assistant"][(len(lines) - n % 2) % 2]
        if edit == "I":
            lines.append(f"{role}:")
            continue
        _, own, text = left.pop(0)
        if edit != "D":
            lines.append(f"{own if edit == 'K' else role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return gaps, *faults.values(), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()


TURNS = "conv_id long, turn long, role string, text string, cost string"


@pytest.mark.parametrize("fragment", [3, 65_536])
def test_repair_against_all_walks(spark, fragment):
    draw = random.Random(12)
    table = []
    for conv in [None, *range(25)]:
        for turn in range(draw.randint(1, 12)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "", "tool", " "])
            text = draw.choice(["Yes.", "No!", "Why?", "cut", "", " \t", "é.", "a\nb.", "word. ", "x" * 3_000])
            table.append((conv, draw.choice([turn, turn + draw.randint(0, 2), None]) if draw.random() < 0.2 else turn, role, text))
    table += [(90, 1, "user", "Same.")] * 7  # rows repeated whole
    table += [(91, t, ["user", "assistant"][t % 2], f"Turn {t}{'.' * (t % 5 > 0)}") for t in range(300)]
    found = spark.createDataFrame([(*r, "x") for r in table], TURNS).drop("cost")
    ids = spark.createDataFrame([(i,) for i in {r[0] for r in table} | {99}], "conv_id long")
    got = {r[0]: tuple(r[1:]) for r in conversations.repair_conversations(ids, found, fragment).collect()}
    assert got.pop(99) == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    for conv in {r[0] for r in table}:
        assert got.pop(conv) == _repaired([r[1:] for r in table if r[0] == conv]), conv
    assert not got


def test_damage_and_nothing(spark, rows):
    table = [(c, t, "system", "One. Two! Three?", "x") for c in range(40) for t in [*range(4), None]] + [(None, None, None, None, "x")]
    made = spark.createDataFrame(table, TURNS)
    want = []
    for c, t, role, text, _ in table:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else "One Two Three" if kind == 2 and text != " " else text
            want += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert rows(conversations.damaged(made)) == sorted(want, key=repr)
    assert rows(conversations.repair_conversations(made.where("false"))) == []


# -- Merkle manifest


def test_positions_in_the_log():
    for n in [*range(1, 80), 511, 512, 513, 700]:
        for top in {merkle.height(n), merkle.height(n) + 1}:
            level, levels = [str(i) for i in range(n)], []
            for k in range(top + 1):
                levels.append(level)
                level = [merkle.digest(level[i : i + 8]) for i in range(0, len(level), 8)]
            log = merkle.append_log(levels[0], top)
            assert len(log) == sum(map(len, levels))
            assert merkle.levels_of(log, n, top) == levels


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


@pytest.mark.parametrize("levels", [1, 4])
def test_manifest_against_whole_trees(spark, levels):
    draw = random.Random(13)
    table = [(i, draw.choice(["Text", "", None, "É" * 50, "x" * 20_000]), draw.choice(["a", "b"]), draw.choice([None, 5])) for i in range(150)]
    langs = [*["en"] * 100, *["fr"] * 30, *[None] * 10, *[f"l{i}" for i in range(10)]]
    table = [(i, t, s, n, lang) for (i, t, s, n), lang in zip(table, langs)]
    table += [(None, "No id", "a", 1, "en"), (3, "Other", "a", 1, "en"), *[(4, "Same", "a", 1, "en")] * 30]
    docs = spark.createDataFrame([(*r, "x") for r in table], "doc_id long, text string, source string, n_chars long, lang string, root string")

    def leaf(i, t, s, n, lang):
        return merkle.digest([_field(v) for v in (i, s, lang, n, t)])

    def tree(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([merkle.digest(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    groups = {}
    for r in table:
        groups.setdefault(r[4], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for k, v in groups.items()}
    top = tree([trees[k][-1][0] for k in names])
    want = []
    for place, name in enumerate(names):
        for i, (_, _, own, r) in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            now, proof = leaf(r[0], r[1].translate({c: c + 32 for c in range(65, 91)}), *r[2:]) if tampered else own, ""
            for nodes, at in ((trees[name], i), (top, place)):
                for level in nodes[:-1]:
                    run, k = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:k] + run[k + 1 :])
                    now, at = merkle.digest([*run[:k], now, *run[k + 1 :]]), at // 8
            want.append((name, r[0], own, trees[name][-1][0], top[-1][0], sha256(proof.encode()).hexdigest(), now, now == top[-1][0]))
    got = [tuple(r) for r in merkle.manifest(merkle.document_leaves(docs), levels).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_manifest_of_nothing(docs):
    assert merkle.manifest(merkle.document_leaves(docs([]))).collect() == []
