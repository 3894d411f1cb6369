"""Each text operator against brute force on small invented documents, and its odd cases."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from storefront import session
from storefront.llm import (
    bpe,
    common,
    components,
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
from tests.llm.conftest import ODD, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_quality_rules(docs):
    template = "This very line stands on all pages of the host"
    rows = [(i, f"{template}\n{prose(i, 60)}") for i in range(30)]
    rows += [(100, f"{template}\n" * 3 + prose(100, 20)), (101, "a b c a b c " * 10)]
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs(rows), min_docs=5, max_share=0.1).collect()}
    assert got[0].kept and got[0].n_removed_lines == 1 and got[0].n_words == 70
    assert got[100].n_dup_lines == 2 and not got[100].kept
    assert got[101].n_repeat_words == 60 and got[101].base_failed
    kept = quality_rules.apply_quality_rules(docs(rows), min_docs=5, max_share=0.1).where("doc_id = 0").first()
    assert kept.text == prose(0, 60) and kept.n_chars == len(kept.text)


def test_repeat_words_against_counting(docs, spark):
    import random

    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 12)))) for i in range(300)]
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.base_rules(docs(rows)).select("doc_id", "n_repeat_words").collect()}
    for i, text in rows:
        w = text.split()
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        places = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        assert got[i] == len(places), text


def test_line_dedup_against_windows(docs):
    import random

    draw = random.Random(5)
    lines = [prose(k, draw.choice([2, 3, 4, 6])) for k in range(6)]
    rows = [(i, "\n".join(draw.choice([*lines, "", prose(900 + 20 * i + j, 3)]) for j in range(draw.randint(1, 25)))) for i in range(30)]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(docs(rows), min_words=10).collect()}
    seen, gone = {}, set()
    for i, text in sorted(rows):
        held = [(n, x) for n, x in enumerate(text.split("\n")) if x.split()]
        for k in range(len(held)):
            taken, total = [], 0
            for n, x in held[k:]:
                taken.append((n, x))
                total += len(x.split())
                if total >= 10:
                    break
            if total < 10:
                continue
            passage = tuple(x for _, x in taken)
            if seen.setdefault(passage, (i, k)) != (i, k):
                gone |= {(i, n) for n, _ in taken}
    for i, text in rows:
        assert got[i] == "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in gone)


def _shingles(text):
    w = text.lower().split() if text else []
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_ngram_join_against_all_pairs(docs, monkeypatch):
    import random

    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    draw = random.Random(7)
    rows = [(i, prose(i, 80)) for i in range(10)]
    base = prose(50, 120).split()
    for i in range(20, 50):  # a chain of near copies: tokens become frequent
        at = draw.randrange(len(base))
        base = base[:at] + ["changed"] + base[at + 1 :]
        rows.append((i, " ".join(base)))
    rows += [(60, rows[0][1].upper()), (61, "a b"), (62, "a  B"), (63, ""), (64, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(rows)).collect()}
    assert got == _joined(rows)


def _joined(rows):
    """doc_id -> (size of the set, least doc_id reachable), from all pairs."""
    sets = {i: _shingles(t) for i, t in rows}
    near = [(a, b) for a in sets for b in sets if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    name = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            if name[b] < name[a]:
                name[a], changed = name[b], True
    return {i: (len(s), name[i]) for i, s in sets.items()}


def test_ngram_join_of_a_crowd(docs, monkeypatch):
    """Near copies on both sides of the threshold, and texts that share one passage: no link is lost."""
    import random

    monkeypatch.setattr(ngram_join, "FREQUENT", 8)
    draw, met = random.Random(3), []
    index = ngram_join._crowd_pairs
    monkeypatch.setattr(ngram_join, "_crowd_pairs", lambda entries: met.append(index(entries)) or met[-1])
    base, passage = prose(1, 110).split(), prose(2, 60)
    rows = []
    for i in range(140):
        text = list(base)[: 110 - draw.randrange(12)]
        for at in draw.sample(range(len(text)), draw.randrange(1, 6)):
            text[at] = draw.choice(["odd", "even", f"own{i}"])
        rows.append((i, " ".join(text)))
    rows += [(200 + i, f"{passage} {prose(100 + i, 8 + i % 30)}") for i in range(200)]
    want = _joined(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(rows)).collect()} == want
    assert len(met) == 1 and len({name for _, name in want.values()}) > 20


def test_ngram_join_lists_meet_small_sets_by_size(docs, monkeypatch):
    """Long texts that hold a frequent line whole short texts are made of do not enter the short texts' index."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    line = prose(1, 12).split()
    spans = [(a, b) for a in range(12) for b in range(a + 6, 12)]
    rows = [(i, " ".join(line[a:b])) for i, (a, b) in enumerate(spans)]
    rows += [(100 + i, f"{' '.join(line)} {prose(200 + i, 30 + i)}") for i in range(60)]
    listing = ngram_join.sets(docs(rows))
    short = listing.where("n < 10").select(F.explode("tokens").alias("token")).distinct()
    assert listing.where("n >= 30").select(F.explode("tokens").alias("token")).join(short, "token").count() > 0
    entries = ngram_join.index(docs(rows), listing)[0]
    spread = entries.groupBy("key").agg(F.min("n").alias("least"), F.max("n").alias("most")).where("least < 10").collect()
    assert spread and all(r.most < 10 for r in spread)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(rows)).collect()} == _joined(rows)


def test_entries_are_heavy_by_pairs_left_to_compare(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    rows = [(1, 100, 7, 6)] * 5 + [(1, 100, 8, 6)]  # all of one component and one other: few pairs
    rows += [(2, 2**k, k, 20) for k in range(20)]  # no two sizes fit
    rows += [(3, 100 + k, k, 20) for k in range(20)]
    of = spark.createDataFrame(rows, "key long, n long, component long, members long")
    assert [r.key for r in ngram_join._heavy(of).collect()] == [3]


def test_hashes_of_words_follow_white_space_and_case():
    texts = ["", " \t\n\x0b\x0c\r", "A b\x0bC", "x" * 64 + " " + "x" * 65 + " " + "x" * 128 + " " + "y" * 129, "\xe9\x85\xc9 b\x1cd", prose(4, 300)]
    texts.append(" " + texts[-1].upper() + "\n")
    for text in texts:
        found = text.encode().lower().split()
        hashes = ngram_join.word_hashes(text).tolist()
        assert len(hashes) == len(found) and len(set(hashes)) == len(set(found)) == len(set(zip(hashes, found)))
        assert len(ngram_join.shingle_set(text)) == len({tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else ())
    assert ngram_join.shingle_set(texts[-1]).tolist() == ngram_join.shingle_set(texts[-2]).tolist()
    assert not len(ngram_join.shingle_set(None))


def test_decontamination(docs, spark):
    item = prose(1, 30)
    changed = item.split()
    changed[15] = "other"
    benchmark = spark.createDataFrame([(0, item), (1, prose(2, 25)), (2, None)], "item_id long, text string")
    rows = [(0, prose(10, 50) + " " + item.upper() + "\n" + prose(11, 9)), (1, prose(12, 90)), (2, item), (3, " ".join(item.split()[:12]))]
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs(rows), benchmark).collect()}
    assert set(got) == {(0, 0), (2, 0)}
    assert got[0, 0].first_word == 50 and got[0, 0].similarity == 1.0
    kept = decontamination.apply_decontamination(docs(rows), benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def _best_window(text: str, item: str) -> float:
    """The highest weighted shingle similarity of an item with a window of its size, laid where a
    shingle that they share stands at the same place in both."""

    def weights(words):
        size = min(decontamination.SHINGLE, len(words))
        found = Counter()
        for i in range(len(words) - size + 1):
            shingle = " ".join(words[i : i + size])
            found[shingle] += len(shingle)
        return found

    words, wanted = text.lower().split(), item.lower().split()
    size, target, best = min(len(wanted), len(words)), weights(wanted), 0.0
    n = decontamination.SHINGLE
    places = {
        max(0, min(p - q, len(words) - size))
        for q in range(len(wanted) - n + 1) for p in range(len(words) - n + 1) if words[p : p + n] == wanted[q : q + n]
    }
    for at in places:
        held = weights(words[at : at + size])
        best = max(best, (held & target).total() / (held | target).total())
    return best


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination_against_all_windows(broadcast, docs, spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_ROWS", 500_000 if broadcast else 0)
    draw = random.Random(5)
    items = {i: prose(1000 + i, 40 + 10 * i) for i in range(6)}
    texts = {}
    for d in range(60):
        passage = items[d % 6].split()
        for _ in range(d // 12):  # up to four words put in, taken out or replaced
            at, turn = draw.randrange(len(passage)), draw.randrange(3)
            passage[at : at + (turn > 0)] = [] if turn == 2 else [prose(draw.randrange(10**6), 1)]
        texts[d] = f"{prose(d, 30)} {' '.join(passage)} {prose(d + 500, 20)}" if d % 5 else " ".join(passage)
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(docs(list(texts.items())), benchmark).collect()}
    best = {(d, i): _best_window(texts[d], items[i]) for d in texts for i in items}
    assert {p for p, s in best.items() if s >= 0.8} == set(got)
    assert all(0.8 <= s <= best[p] + 1e-9 for p, s in got.items())


def test_hamming_pairs_are_all_within_the_radius(spark):
    import random

    draw = random.Random(1)
    left = [draw.getrandbits(63) for _ in range(40)]
    right = [x ^ sum(1 << b for b in draw.sample(range(63), draw.randint(0, 20))) for x in left[:12]]
    a = spark.createDataFrame(list(enumerate(left)), "i long, simhash long")
    b = spark.createDataFrame(list(enumerate(right)), "j long, simhash long")
    got = sorted((r.i, r.r_j) for r in decontamination.hamming_pairs(a, b, 15).collect())
    assert got == [(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if (x ^ y).bit_count() <= 15]


def test_bpe_agrees_with_the_library(docs):
    coder = bpe.ChunkEncoder(VOCABULARY)
    texts = [prose(1, 3000), "", "  ", "x<|endoftext|>y " + prose(2, 900), "日本語テキスト" * 500, "é́ z don't 12 " * 300]
    whole = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [coder.encode(t).tolist() for t in texts] == whole
    assert bpe.decode_ids([coder.encode(t) for t in texts], VOCABULARY) == coder.tokenizer.decode_batch(whole, skip_special_tokens=False)
    before = coder.encoded_chunks
    coder.encode("another beginning " + texts[0])
    assert coder.encoded_chunks - before < len(bpe.cuts(texts[0].encode())) / 2
    assert [r.n_tokens for r in bpe.digests(docs([(1, None), (2, "a b")]), VOCABULARY).orderBy("doc_id").collect()] == [0, 2]


def test_bpe_keeps_bounded_bytes_however_long_the_chunks():
    coder = bpe.ChunkEncoder(VOCABULARY)
    texts = [chr(97 + i) * 600_000 + " " + prose(i, 50) for i in range(3)]  # runs without a cut: a chunk each
    for text in texts:
        assert coder.encode(text).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    held = [len(k) + len(v) for s in (coder.chunks, coder.words) for d in (s.young, s.old) for k, v in d.items()]
    assert sum(held) < 1_000_000
    few = bpe.ByteStore(64 * 1000)
    for i in range(1000):
        few.put(b"%03d" % i, b"x" * 500)
        assert len(few.young) + len(few.old) <= 2 * 64 * 1000 // 500
    assert few.get(b"999") == b"x" * 500


def test_bpe_store_goes_when_another_operator_works(spark, docs):
    from storefront.llm import store

    coder = bpe._encoder(VOCABULARY)
    assert bpe._encoder(VOCABULARY) is coder
    list(ngram_join._slices(iter([])))
    assert not store._held


def test_bpe_passes_other_columns_through(spark):
    rows = [(2**62 + 1, "a b", None, [1, 2]), (None, None, 2**60 + 1, None), (3, "", 7, [])]
    table = spark.createDataFrame(rows, "doc_id long, text string, n long, more array<int>")
    got = bpe.encode(table, VOCABULARY, decoded=True).collect()
    assert sorted([(r.doc_id, r.n, r.more) for r in got], key=str) == sorted([(r[0], r[2], r[3]) for r in rows], key=str)
    assert sorted(len(r.ids) for r in got) == [0, 0, 2]
    assert sorted(r.decoded for r in got)[:2] == ["", ""]


def test_language_id_learns_from_other_documents(docs):
    texts = {"en": "the cat and the dog were with them on that thing", "es": "los perros y las casas de una ciudad que no son"}
    rows = [(k, t) for k, t in enumerate([texts["en"]] * 20)]
    table = docs(rows).unionAll(docs([(100 + k, texts["es"]) for k in range(20)], lang="es")).unionAll(docs([(300, None), (301, "12 !")], lang=None))
    got = {r.doc_id: r for r in language_id.identify(table, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got[0].lang_pred == "en" and got[105].lang_pred == "es" and 0.5 < got[0].score <= 1
    assert got[300].lang_pred == got[301].lang_pred == "und"


def test_forward_sums_all_segmentations():
    import numpy as np

    names = {" a": 0, "b": 1, " ": 2, "a": 3, "ab": 4, " ab": 5}
    p = np.array([[0.1], [0.2], [0.3], [0.1], [0.05], [0.02], [1e-9]])
    assert np.isclose(np.exp(language_id.forward("ab", names, p, 3))[0], 0.02 + 0.1 * 0.2 + 0.3 * 0.05 + 0.3 * 0.1 * 0.2)


def test_forwards_against_all_segmentations():
    import random

    import numpy as np

    draw = random.Random(2)
    names = {p: k for k, p in enumerate({"".join(draw.choice(" abc") for _ in range(draw.randint(1, 4))) for _ in range(40)} - {"c"})}
    table = np.random.default_rng(2).random((len(names) + 1, 3)) / 10

    def total(held, k):
        if not held:
            return 1.0
        rest = sum(table[names[held[:j]], k] * total(held[j:], k) for j in range(1, min(4, len(held)) + 1) if held[:j] in names)
        return rest + (table[-1, k] * total(held[1:], k) if held[0] not in names else 0.0)

    words = ["".join(draw.choice("abcd") for _ in range(draw.randint(1, 9))) for _ in range(80)]
    got = np.exp(language_id.forwards(words, names, table, 4))
    assert np.allclose(got, [[total(" " + w, k) for k in range(3)] for w in words], rtol=1e-9)


def test_only_letters_are_words(docs):
    assert language_id.words_of("½ ² ① Ⅷ 12") == [] and language_id.words_of("Straße½ÄB x²y") == ["straße", "äb", "x", "y"]
    rows = [(k, "the cat and the dog were with them") for k in range(40)] + [(100, "½ ² ①")]
    got = {r.doc_id: r for r in language_id.identify(docs(rows), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert (got[100].lang_pred, got[100].score) == ("und", 0.0)


@pytest.mark.parametrize("limit", [url_filter.MAX_BITS, 1])
def test_url_cascade_is_exact(spark, limit):
    urls = [f"http://h{i}.example.org/x" for i in range(500)] + [None, "no scheme", "HTTP://A.Example.NET/en/x?q", "https://b.net"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.example.org/x",) for i in range(0, 700, 7)], "key string")
    got = {r.page_id: r for r in url_filter.judge(pages, listed, max_bits=limit).collect()}
    assert all(got[i].verdict == ("block" if i % 7 == 0 else "allow") for i in range(500))
    assert (got[502].host, got[502].rule, got[502].verdict) == ("a.example.net", "example.net/en/", "allow")
    assert got[503].rule is None and got[500].host == "" == got[501].path


def test_license_scan(docs):
    rows = [(1, "x CC by-NC cc BY nc y"), (2, "This work is licensed under the GNU General Public License, version 3."), (3, "licensed work"), (4, None)]
    got = {r.doc_id: r for r in license_scan.license_scan(docs(rows)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].n_words) == (2, 1, 4, "cc-by-nc", 8)
    assert (got[2].base_labels, got[2].labels, got[2].score) == ("", "gpl-3", 1.0)
    assert (got[3].labels, got[3].score, got[4].n_words, got[4].first_word) == ("", 0.0, 0, None)


def test_license_phrases_of_any_words(docs):
    phrases = {"gpl v3": "gpl-3", "GNU-Lesser": "lgpl", "日本 x": "jp", " - ": "none"}
    rows = [(1, "released under gpl v3 terms"), (2, "gplv3, GNU lesser"), (3, "a 日本 X b"), (4, "gpl v33"), (5, "GPL\nV3 gpl-v3"), (6, "日本語 x")]
    got = {r.doc_id: r for r in license_scan.license_scan(docs(rows), phrases=phrases, templates={}).collect()}
    assert [got[i].base_labels for i in range(1, 7)] == ["gpl-3", "lgpl", "jp", "", "gpl-3", ""]
    assert (got[5].n_base, got[5].first_word, got[5].last_word, got[1].first_word) == (2, 0, 2, 2)
    assert {r.labels for r in license_scan.license_scan(docs(rows), phrases={}, templates={}).collect()} == {""}


def test_toxicity_and_quality_catch_what_is_labelled(docs, spark):
    rows = [(i, prose(i, 40) + (" vile scoundrel" if i % 3 == 0 else "")) for i in range(150)]
    labels = spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.severity(docs(rows), labels).collect()}
    assert all(got[i].toxic_pred == (i % 3 == 0) for i in range(150))
    rows = [(i, prose(i, 200) if i % 2 else "BUY NOW $$$ " * 50 + str(i)) for i in range(150)]
    scored = {r.doc_id: r for r in quality_classifier.quality_scores(docs(rows), labels).collect()}
    assert all(scored[i].predicted == i % 2 for i in range(150))


def _applied(spark, name, docs):
    benchmark = spark.createDataFrame([(0, prose(1, 30))], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    return {
        "rules": lambda: quality_rules.quality_rules(docs), "rules_stage": lambda: quality_rules.apply_quality_rules(docs),
        "lines": lambda: line_dedup.line_dedup(docs), "join": lambda: ngram_join.near_duplicates(docs),
        "lines_stage": lambda: line_dedup.apply_line_dedup(docs), "join_stage": lambda: ngram_join.apply_near_duplicates(docs),
        "leaks": lambda: decontamination.apply_decontamination(docs, benchmark), "bpe": lambda: bpe.digests(docs, VOCABULARY),
        "lang": lambda: language_id.identify(docs, public_tokenizers.path("piece_bpe_32k.model")),
        "toxic": lambda: toxicity.severity(docs, labels), "quality": lambda: quality_classifier.quality_scores(docs, labels),
        "license": lambda: license_scan.license_scan(docs),
    }[name]()


ALL = ["rules", "lines", "join", "leaks", "bpe", "lang", "toxic", "quality", "license"]


@pytest.mark.parametrize("name", ALL)
def test_odd_rows_and_clashing_columns(name, docs, spark):
    table = docs(ODD).withColumns({"node": F.lit("mine"), "key": F.lit(1), "w": F.lit(2), "rank": F.lit(3)})
    assert _applied(spark, name, table).count() == len(ODD)


OWN = ["n_words", "removed", "kept", "labels", "score", "held_out", "lang_pred", "predicted", "severity", "grade", "toxic_pred", "ids"]
HIDDEN = ["_key", "_k", "_doc", "_d", "_gone", "_text", "_lines", "_words", "_found", "_places", "_labels", "_best", "_parts", "_h", "N_Removed_Lines"]


@pytest.mark.parametrize("name", [*ALL, "rules_stage", "lines_stage", "join_stage"])
def test_columns_called_like_the_operators(name, docs, spark):
    table = docs([(1, prose(1, 60)), (2, "one"), (None, None)])
    added = {c: F.lit(f"mine {c}") for c in [*OWN, *HIDDEN]}
    plain, got = _applied(spark, name, table), _applied(spark, name, table.withColumns(added))
    of = plain.columns
    order = lambda df: sorted(map(repr, df.select(*of).collect()))
    assert order(got) == order(plain)
    kept = [c for c in added if c in got.columns and c not in of and c.lower() not in {x.lower() for x in of}]
    for row in got.collect():
        assert all(row[c] == f"mine {c}" for c in kept)
    if name.endswith("_stage") or name == "leaks":
        assert got.columns == [*table.columns, *added]


def test_url_filter_odd_pages(spark):
    schema = "page_id long, url string, host string, `_hit` string, Verdict string"
    rows = [(1, "http://a.net/", "mine", "mine", "mine"), (1, "http://a.net/", "mine", "mine", "mine"), (None, None, None, None, None)]
    listed = spark.createDataFrame([("b.example.org/",)], "key string")
    got = url_filter.judge(spark.createDataFrame(rows, schema), listed).select("page_id", "host", "_hit", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "a.net", "mine", "net/", "block")] * 2 + [(None, "", None, None, "allow")]
    assert url_filter.judge(spark.createDataFrame([], schema), listed).count() == 0
    assert url_filter.judge(spark.createDataFrame(rows, schema), listed.limit(0)).count() == 3


@pytest.mark.parametrize("name", [*ALL, "rules_stage", "join_stage"])
def test_empty_table(name, docs, spark):
    assert _applied(spark, name, docs([])).count() == 0


def test_toxicity_on_texts_it_did_not_learn_from(docs, spark):
    import random

    draw = random.Random(8)
    marks = ["badword", "worseword", "uglyword", "foulword"]
    rows, labels = [], []
    for i in range(400):
        words = prose(2_000 + i, 200).split()
        toxic = i % 4 == 0
        if toxic:
            for mark in draw.sample(marks, draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), mark)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    # a family of near copies that all happen to be toxic must not teach its words
    family = prose(9, 300)
    rows += [(1_000 + i, f"{family} badword {prose(3_000 + i, 3)}") for i in range(40)] + [(2_000, family)]
    labels += [(1_000 + i, 1) for i in range(40)]
    known = spark.createDataFrame([x for x in labels if x[0] % 2 == 0], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.severity(docs(rows).select("doc_id", "text"), known).collect()}
    held = [x for x in labels if x[0] % 2]
    assert sum(got[i].toxic_pred for i, t in held if t) >= 0.9 * sum(t for _, t in held)
    assert sum(got[i].toxic_pred for i, t in held if not t) <= 0.05 * len(held)
    assert got[1_001].severity > got[2_000].severity


def test_near_duplicates_of_missing_and_repeated_ids(docs):
    words = prose(77, 200).split()
    first, bridge, last = (" ".join(words[:a] + extra) for a, extra in ((200, []), (185, prose(78, 4).split()), (170, prose(78, 8).split())))
    alone = prose(79, 100)
    table = docs([(1, first), (None, bridge), (2, last), (5, first), (5, alone)])
    got = {(r.doc_id, r.key): r.component_id for r in ngram_join.near_duplicates(table).collect()}
    assert sorted(got.values()) == [1, 1, 1, 1, 5] and len(got) == 5  # the text without an id links both ends
    kept = {(r.doc_id, r.text) for r in ngram_join.apply_near_duplicates(table).collect()}
    assert kept == {(1, first), (None, bridge), (5, alone)}


def _labels(folder):
    """The landed tables below ``folder``, without what tells runs apart."""
    return {p.name.rpartition("-")[0] for p in folder.iterdir() if p.is_dir()}


def test_what_no_job_reads_any_more_is_deleted(docs, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 8)
    passage = "\n".join(prose(600 + k, 12) for k in range(6))
    rows = [(i, f"{prose(i, 70)}\n{passage}") for i in range(6)] + [(10 + i, prose(50, 40 + i)) for i in range(40)]
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "lines"))
    gone = line_dedup.later_copies(docs(rows))
    assert _labels(tmp_path / "lines") == {"passages"}
    assert {(r._doc, len(r._gone)) for r in gone.collect()} == {(i, 6) for i in range(1, 6)}
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "join"))
    found, joined = ngram_join.links(docs(rows), ngram_join.sets(docs(rows)))
    left = _labels(tmp_path / "join")
    assert "components" in left and all(x == "components" or x.startswith("links-") for x in left)
    assert found.count() and joined.count()


def test_components_of_few_links_take_few_partitions(spark, monkeypatch):
    draw = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 130)] + [(7, i) for i in range(200, 260)]  # a chain and a star
    pairs += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(80)] + [(3, 3)]
    name = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in name:
        for a, b in pairs:
            if a != b:
                name[a] = name[b] = min(name[a], name[b])
    links = spark.createDataFrame(pairs, "a long, b long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        few = components.components(links)
        assert len(few.inputFiles()) == 1
        monkeypatch.setattr(common, "ROWS_PER_TASK", 10)
        many = components.components(links)
        assert len(many.inputFiles()) > 8
        for found in (few, many):
            assert sorted((r.node, r.component) for r in found.collect()) == sorted(name.items())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
