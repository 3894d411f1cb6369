"""Toxicity: cumulative-link ordinal regression over hashed words.

Labels say only toxic or not, so a labelled toxic text gets a severity grade by how many
different words it has that stand almost only in toxic texts: grade 0 is not toxic, 1 to 3
are toxic, cut at ``GRADE_CUTS`` words. The model has one weight per feature, shared by all
thresholds: P(grade > j) = 1 / (1 + exp(threshold_j - weights . features)), thresholds in
order. A text's features are its distinct words (hashed), each as 1; words seen in less than
``MIN_SHARE`` of the sampled texts of either label have no weight. Weights are drawn to
zero by an L1 penalty, so words that a few texts happen to share gain nothing and long clean
texts add up to nothing. The penalty is the one of ``PENALTIES`` with the least loss on a fold of
the sample that it did not learn from; texts with the same least word hash, as copies have,
are in one fold. The result is the expected severity, the sum of the probabilities.

The fit takes at most about ``SAMPLE`` texts of each label (all rows are scored). Only texts
that may be of the sample leave the scan; what comes to the driver are at most
``WORDS_AT_MOST`` word hashes a text, the lowest ones, so the driver holds a bounded amount.

Cases: a NULL or wordless text has no features and gets the thresholds' own severity;
labels of rows that are missing, or a training set with one label only, give severity 0
everywhere; a text scored equal for two grades gets the lower one; rows repeated whole each
get their row; very long texts are scored whole; extra columns are left alone, but for those
called like a column of the result, which give way to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import maybe_in, set_apart, ship
from storefront.llm.features import DIMENSIONS, places, sample, words_of

SAMPLE = 2_000
WORDS_AT_MOST = 20_000  # of a sampled text
MIN_SHARE = 0.01
MARKED = 0.95  # share of the texts with a word that are toxic, at even labels
GRADES = 4
GRADE_CUTS = (1, 3)  # more different marked words than these are grades 2 and 3
STEPS = 150
PENALTIES = (3e-4, 1e-3, 3e-3, 1e-2)
FOLDS = 5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _features(rows: DataFrame) -> DataFrame:
    """(toxic, found): distinct places of the words of each sampled text."""
    ship(rows.sparkSession)

    def run(batches):
        known = places()
        for batch in batches:
            out = []
            for toxic, text in zip(batch["toxic"], batch["text"]):
                spots = np.unique(np.array([known[w] for w in words_of(text)], np.int32))
                out.append((int(toxic), spots[:WORDS_AT_MOST]))
            yield pd.DataFrame(out, columns=["toxic", "found"])

    return rows.select("toxic", "text").mapInPandas(run, "toxic int, found array<int>")


def fit_ordinal(x: list[np.ndarray], y: np.ndarray, penalty: float, grades: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """Weights by feature and ordered thresholds, by proximal gradient steps on the mean log loss.

    ``x``: features of each row, all of value 1.
    """
    rows = np.repeat(np.arange(len(x)), [len(f) for f in x])
    spots = np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    names, at = np.unique(spots, return_inverse=True)
    # thresholds as a first one and positive steps, so their order cannot break
    above = np.array([(y > j).mean() for j in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    theta = -np.log(above / (1 - above))
    theta = np.maximum.accumulate(theta + np.arange(grades - 1) * 1e-3)
    raw = np.r_[theta[0], np.log(np.diff(theta))]
    w = np.zeros(len(names))
    squares_w, squares_t = np.full(len(names), 1e-6), np.full(grades - 1, 1e-6)
    balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(STEPS):
        theta = raw[0] + np.r_[0, np.cumsum(np.exp(raw[1:]))]
        score = np.bincount(rows, w[at], len(x)) if len(at) else np.zeros(len(x))
        upper = _sigmoid(score[:, None] - np.r_[-1e3, theta])[np.arange(len(x)), y]
        lower = _sigmoid(score[:, None] - np.r_[theta, 1e3])[np.arange(len(x)), y]
        # likelihood of grade y is upper - lower, with upper = P(grade >= y)
        like = np.maximum(upper - lower, 1e-9)
        d_score = balance * (upper * (1 - upper) - lower * (1 - lower)) / like / len(x)
        grad_w = np.bincount(at, d_score[rows], len(names)) if len(at) else np.zeros(0)
        d_theta = np.zeros(grades - 1)
        np.add.at(d_theta, (y - 1)[y > 0], -(balance * upper * (1 - upper) / like)[y > 0] / len(x))
        np.add.at(d_theta, y[y < grades - 1], (balance * lower * (1 - lower) / like)[y < grades - 1] / len(x))
        grad_raw = np.r_[d_theta.sum(), [d_theta[j + 1 :].sum() * np.exp(raw[j + 1]) for j in range(grades - 2)]]
        squares_w += grad_w**2
        squares_t += grad_raw**2
        step = 0.3 / np.sqrt(squares_w)
        w += step * grad_w
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        raw += 0.1 * grad_raw / np.sqrt(squares_t)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[names] = w
    return weights, raw[0] + np.r_[0, np.cumsum(np.exp(raw[1:]))]


def loss(model: tuple[np.ndarray, np.ndarray], x: list[np.ndarray], y: np.ndarray) -> float:
    """Log loss of toxic or not, both labels weighing the same."""
    weights, theta = model
    above = _sigmoid(np.array([weights[f].sum() for f in x]) - theta[0]).clip(1e-6, 1 - 1e-6)
    parts = [-np.log(above[y > 0]), -np.log(1 - above[y == 0])]
    return float(np.mean([p.mean() for p in parts if len(p)])) if len(y) else 0.0


def fit(found: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from the features and labels of sampled texts."""
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((toxic == 0).sum()))
    bad = np.bincount(np.concatenate([f for f, t in zip(found, toxic) if t]), minlength=DIMENSIONS) / n_bad
    good = np.bincount(np.concatenate([f for f, t in zip(found, toxic) if not t]), minlength=DIMENSIONS) / n_good
    used = np.maximum(bad, good) >= MIN_SHARE
    marked = used & (bad > MARKED * (bad + good))
    x = [f[used[f]] for f in found]
    grades = [1 + sum(int(marked[f].sum()) > c for c in GRADE_CUTS) if t else 0 for f, t in zip(x, toxic)]
    y = np.array(grades)
    # copies share nearly all words, and so their least hash; it must not hinge on a common word
    rare = [f[~used[f]] for f in found]
    key = np.array([int((r * 2654435761 % 2**32).min()) if len(r) else -1 for r in (np.asarray(r, np.int64) for r in rare)])
    out = key % FOLDS == 0
    if out.all() or not out.any() or len(set(toxic[~out])) < 2:
        return fit_ordinal(x, y, PENALTIES[1])
    inner, outer = np.flatnonzero(~out), np.flatnonzero(out)

    def judged(penalty: float) -> float:
        return loss(fit_ordinal([x[i] for i in inner], y[inner], penalty), [x[i] for i in outer], y[outer])

    return fit_ordinal(x, y, min(PENALTIES, key=judged))


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE):
    """(weights, thresholds), or None where the labels have fewer than two values."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = sample(known, "toxic", sample_size)
    # one text of a doc_id, so that repeated ids do not swell the sample
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").where(maybe_in(chosen.select("doc_id"), F.col("doc_id")))
    rows = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    got = _features(rows).toPandas()
    if got["toxic"].nunique() < 2 or not got["found"].map(len).sum():
        return None
    return fit([np.asarray(f, np.int64) for f in got["found"]], got["toxic"].to_numpy())


def severity(docs: DataFrame, labels: DataFrame, text: str = "text", sample_size: int = SAMPLE) -> DataFrame:
    """``docs`` without its text, with ``severity`` (0 to 3), ``grade`` (the likeliest) and ``toxic``
    (a grade of 1 or more is likelier than 0)."""
    return set_apart(docs, {"doc_id", text}, lambda inner: _severity(inner, labels, text, sample_size))


def _severity(docs: DataFrame, labels: DataFrame, text: str, sample_size: int) -> DataFrame:
    model = train(docs.withColumnRenamed(text, "text") if text != "text" else docs, labels, sample_size)
    rest = [f for f in docs.schema.fields if f.name != text]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches):
        known = places()
        weights, theta = model if model else (np.zeros(DIMENSIONS), np.full(GRADES - 1, 40.0))
        for batch in batches:
            above = []
            for t in batch[text]:
                spots = {known[w] for w in words_of(t)}
                score = weights[np.fromiter(spots, np.int64, len(spots))].sum() if spots else 0.0
                above.append(_sigmoid(score - theta))
            above = np.array(above).reshape(-1, GRADES - 1)
            each = np.c_[np.ones(len(above)), above] - np.c_[above, np.zeros(len(above))]
            yield batch.drop(columns=[text]).assign(
                severity=above.sum(axis=1), grade=each.argmax(axis=1).astype(np.int32), toxic_pred=above[:, 0] >= 0.5
            )

    ship(docs.sparkSession)
    columns = [F.col(f"`{f.name}`") for f in rest] + [F.col(f"`{text}`")]
    return docs.select(*columns).mapInPandas(run, f"{spec}, severity double, grade int, toxic_pred boolean")
