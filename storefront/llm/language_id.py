"""Language identification by unigram pieces, summed over all segmentations.

A language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces of the product of their
probabilities, by the forward algorithm; a character in no piece costs a fixed amount. A
text's languages are compared by the sum of its words' log probabilities; the score is the
posterior of the best, with equal priors.

Piece probabilities are learned by expectation maximisation over word counts of labelled
texts outside fold 2, at most about ``SAMPLE`` texts of each language. Words are counted, and
expected pieces summed, by Spark; what comes to the driver is one number per language and
piece, a size the vocabulary fixes.

Cases: a NULL text or one without a letter is ``und`` with score 0, as is every text when
nothing could be learned; ties go to the language first in order; rows repeated whole
each get their row; labels of NULL are not learned; extra columns are left alone, but for
those called like a column of the result, which give way to it.
"""

from __future__ import annotations

import re
from functools import cache
from math import exp

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import bucket, land, set_apart, ship
from storefront.llm.features import sample
from storefront.llm.store import Store

SAMPLE = 1_000
ROUNDS = 2
FOLD, FOLDS = 2, 4
UNKNOWN = 1e-9
FLOOR = 1e-8  # least probability of a piece
LONGEST = 64  # longer runs of letters are taken in parts of so many
WORDS_KEPT = 400_000  # of a generation of the store
WORDS_AT_ONCE = 2_048
TEXTS_AT_ONCE = 128
_RUNS = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


@cache
def pieces(path: str) -> dict[str, int]:
    """Pieces of letters of a sentencepiece model; the word-start mark is a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).replace("▁", " ")
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and _RUNS.fullmatch(piece.strip(" ") or "a"):
            found.setdefault(piece, len(found))
    return found


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, in parts of at most ``LONGEST``."""
    found = _RUNS.findall(text.lower()) if isinstance(text, str) else []
    if found and not "".join(found).isalpha():  # fractions, circled digits and the like are no letters
        found = [part for w in found for part in ([w] if w.isalpha() else _LETTERS.findall(w))]
    if any(len(w) > LONGEST for w in found):
        found = [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


def _spans(word: str, vocabulary: dict[str, int], longest: int) -> list[tuple[int, int, int]]:
    """(start, end, piece) of all pieces in a blank and the word; -1 for a lone unknown character."""
    held = " " + word
    n, spans = len(held), []
    for i in range(n):
        alone = True
        for j in range(i + 1, min(n, i + longest) + 1):
            piece = vocabulary.get(held[i:j])
            if piece is not None:
                spans.append((i, j, piece))
                alone = alone and j > i + 1
        if alone:
            spans.append((i, i + 1, -1))
    return spans


def forwards(words: list[str], vocabulary: dict[str, int], probabilities: np.ndarray, longest: int) -> np.ndarray:
    """Log probability of each word (a row) in every language (a column, as in ``probabilities``).

    Words of a length are taken together: ``ahead[j]`` is the probability of all segmentations
    of the first j characters, and each span of characters adds to it for all words at once.
    """
    rows = np.vstack([probabilities, np.zeros(probabilities.shape[1])])
    unknown, nothing = len(rows) - 2, len(rows) - 1
    out = np.empty((len(words), probabilities.shape[1]))
    lengths = np.array([len(w) for w in words])
    get = vocabulary.get
    for length in np.unique(lengths):
        n = int(length) + 1
        spans = [(i, j, unknown if j == i + 1 else nothing) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1)]
        at = np.flatnonzero(lengths == length)
        for first in range(0, len(at), WORDS_AT_ONCE):
            part = at[first : first + WORDS_AT_ONCE]
            held = [" " + words[k] for k in part]
            found = np.array([[get(w[i:j], none) for i, j, none in spans] for w in held], np.int32)
            ahead = np.zeros((n + 1, len(part), rows.shape[1]))
            ahead[0] = 1
            for k, (i, j, _) in enumerate(spans):
                ahead[j] += ahead[i] * rows[found[:, k]]
            out[part] = np.log(np.maximum(ahead[-1], 1e-300))
    return out


def forward(word: str, vocabulary: dict[str, int], probabilities: np.ndarray, longest: int) -> np.ndarray:
    """Log probability of one word in every language."""
    return forwards([word], vocabulary, probabilities, longest)[0]


def expected(word: str, n: float, vocabulary: dict[str, int], probabilities: list[float], longest: int, into: dict[int, float]) -> None:
    """Add the expected number of each piece in ``n`` times the word to ``into``."""
    spans = _spans(word, vocabulary, longest)
    ahead, behind = [0.0] * (len(word) + 2), [0.0] * (len(word) + 2)
    ahead[0] = behind[-1] = 1.0
    for i, j, piece in spans:
        ahead[j] += ahead[i] * probabilities[piece]
    for i, j, piece in reversed(spans):
        behind[i] += behind[j] * probabilities[piece]
    whole = ahead[-1]
    if whole <= 0:
        return
    for i, j, piece in spans:
        if piece >= 0:
            into[piece] = into.get(piece, 0.0) + n * ahead[i] * probabilities[piece] * behind[j] / whole


def train(docs: DataFrame, vocabulary: str, sample_size: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (a row per piece, the last for unknown characters)."""
    ship(docs.sparkSession)
    names = pieces(vocabulary)
    longest = max(map(len, names), default=1)
    known = docs.where(F.col("lang").isNotNull() & (bucket("doc_id", FOLDS) != FOLD)).select("doc_id", "lang", "text")
    chosen = sample(known, "lang", sample_size)
    found = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{1,64})"))).alias("word"))
    counts = found.groupBy("lang", "word").agg(F.count("*").alias("n"))

    counts = land(counts, "language-words")
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    table = np.full((len(names) + 1, len(languages)), 1 / max(1, len(names)))
    table[-1] = UNKNOWN
    for _ in range(ROUNDS):
        now = {lang: table[:, k].tolist() for k, lang in enumerate(languages)}

        def run(batches, now=now):
            held = pieces(vocabulary)
            for batch in batches:
                for lang, part in batch.groupby("lang"):
                    into: dict[int, float] = {}
                    for word, n in zip(part["word"], part["n"]):
                        expected(word, n, held, now[lang], longest, into)
                    yield pd.DataFrame({"lang": lang, "piece": list(into), "n": list(into.values())})

        sums = counts.mapInPandas(run, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros_like(table)
        for k, lang in enumerate(languages):
            part = sums[sums["lang"] == lang]
            table[part["piece"].to_numpy(), k] = part["n"]
            table[:, k] /= max(table[:, k].sum(), 1e-12)
        table = np.maximum(table, FLOOR)
        table[-1] = UNKNOWN
    return languages, table


class _Scores:
    """Log probabilities of words in all languages, in a store of bounded size."""

    def __init__(self, vocabulary: dict[str, int], table: np.ndarray):
        self.vocabulary, self.table = vocabulary, table
        self.longest = max(map(len, vocabulary), default=1)
        self.store = Store(WORDS_KEPT)

    def of(self, words: set[str]) -> dict[str, tuple[float, ...]]:
        known, fresh = {}, []
        for word in words:
            found = self.store.get(word)
            if found is None:
                fresh.append(word)
            else:
                known[word] = found
        if fresh:
            for word, row in zip(fresh, forwards(fresh, self.vocabulary, self.table, self.longest).tolist()):
                known[word] = row = tuple(row)
                self.store.put(word, row)
        return known


_scores: dict[tuple, _Scores] = {}


def _kept_scores(vocabulary: str, table: np.ndarray) -> _Scores:
    """The store of this worker, as long as it works for the same model."""
    key = (vocabulary, table.shape, table.tobytes())
    if key not in _scores:
        _scores.clear()
        _scores[key] = _Scores(pieces(vocabulary), table)
    return _scores[key]


def identify(docs: DataFrame, vocabulary: str, text: str = "text", sample_size: int = SAMPLE) -> DataFrame:
    """``docs`` without its text, with ``held_out`` (not learned from), ``lang_pred`` and ``score``."""
    return set_apart(docs, {"doc_id", "lang", text}, lambda inner: _identify(inner, vocabulary, text, sample_size))


def _identify(docs: DataFrame, vocabulary: str, text: str, sample_size: int) -> DataFrame:
    renamed = docs.withColumnRenamed(text, "text") if text != "text" else docs
    languages, table = train(renamed, vocabulary, sample_size)
    rest = [f for f in docs.schema.fields if f.name != text]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches):
        kept = _kept_scores(vocabulary, table)
        for batch in (b.iloc[at : at + TEXTS_AT_ONCE] for b in batches for at in range(0, len(b), TEXTS_AT_ONCE)):
            best, scores = [], []
            worded = [words_of(t) for t in batch[text]]
            known = kept.of(set().union(*worded)) if languages else {}
            for found in worded:
                if not found or not languages:
                    best.append("und")
                    scores.append(0.0)
                    continue
                sums = [sum(x) for x in zip(*map(known.__getitem__, found))]
                top = max(range(len(sums)), key=sums.__getitem__)
                best.append(languages[top])
                scores.append(1 / sum(exp(max(s - sums[top], -700)) for s in sums))
            yield batch.drop(columns=[text]).assign(lang_pred=best, score=scores)

    columns = [F.col(f"`{f.name}`") for f in rest] + [F.col(f"`{text}`")]
    found = docs.select(*columns).mapInPandas(run, f"{spec}, lang_pred string, score double")
    return found.withColumn("held_out", bucket("doc_id", FOLDS) == FOLD)
