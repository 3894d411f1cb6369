"""Quality classifier: a text's size under two zstandard dictionaries, of good and of bad texts.

A dictionary is built from each label's texts. A text is cut into blocks of ``BLOCK`` bytes,
each compressed with either dictionary; the difference of the sizes over their mean is the
text's evidence, and a logistic curve over it and the text's own compressed share is fitted to labelled texts
that built no dictionary.

At most about twice ``SAMPLE`` labelled texts of each label are used, half for the
dictionaries and half for the curve; every text, also in the sample, is taken whole.

Cases: NULL, empty and wordless texts have no evidence and get the curve's value there; with
fewer than two labels every score is the share of label 1 (0.5 without labels); rows
repeated whole each get their row; extra columns are left alone, but for those called like a
column of the result, which give way to it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import bucket, maybe_in, set_apart, ship
from storefront.llm.features import sample

SAMPLE = 1_500
BLOCK = 1_024
DICTIONARY = 110 * 1024
LEVEL = 3
CUT = 0.3


class Compressors:
    """Sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.both = []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=LEVEL)
            self.both.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """(difference over mean, mean size over length, log length)."""
        data = text.encode() if isinstance(text, str) else b""
        if not data:
            return 0.0, 0.0, 0.0
        good = bad = 0
        for at in range(0, len(data), BLOCK):
            block = data[at : at + BLOCK]
            good += len(self.both[0].compress(block))
            bad += len(self.both[1].compress(block))
        return 2 * (bad - good) / (bad + good), (bad + good) / 2 / len(data), float(np.log(len(data)))


def _design(evidence: np.ndarray) -> np.ndarray:
    d, share, length = evidence.T
    return np.c_[np.ones(len(d)), d * 10, share, length / 10, (d * 10) ** 2, share**2, d * 10 * share]


def fit_curve(evidence: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps, with a small penalty."""
    x = _design(evidence)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE, folds: int = 5):
    """(good dictionary, bad dictionary, curve), or the share of label 1, from rows outside fold 0."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.where(bucket("doc_id", folds) != 0)
    chosen = sample(known, "quality", 2 * sample_size)
    shares = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    # only texts that may be of the sample leave the scan, one of a doc_id
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").where(maybe_in(chosen.select("doc_id"), F.col("doc_id")))
    rows = texts.join(chosen, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).toPandas()
    if rows["quality"].nunique() < 2:
        return float(shares.get(1, 0) / max(1, sum(shares.values()))) if shares else 0.5
    rows = rows.sort_values(["doc_id", "text"]).reset_index(drop=True)
    builds = np.arange(len(rows)) % 2 == 0
    contents = []
    for label in (1, 0):
        texts = [t.encode() for t in rows["text"][builds & (rows["quality"] == label)]]
        contents.append(_dictionary(texts))
    pair = Compressors(*contents)
    rest = rows[~builds]
    evidence = np.array([pair.evidence(t) for t in rest["text"]])
    y = rest["quality"].to_numpy(float)
    # each label counts by its share of all labelled rows, as the sample is even
    curve = fit_curve(evidence, y)
    drawn = np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
    curve[0] += np.log(shares[1] / shares[0]) - drawn
    return (*contents, curve)


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train one."""
    blocks = [t[at : at + BLOCK] for t in texts for at in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-DICTIONARY:] or b"\n" * 8


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", sample_size: int = SAMPLE, folds: int = 5) -> DataFrame:
    """``docs`` without its text, with ``held_out`` (fold 0, not learned from), ``score``, ``predicted``."""
    return set_apart(docs, {"doc_id", text}, lambda inner: _quality_scores(inner, labels, text, sample_size, folds))


def _quality_scores(docs: DataFrame, labels: DataFrame, text: str, sample_size: int, folds: int) -> DataFrame:
    renamed = docs.withColumnRenamed(text, "text") if text != "text" else docs
    model = train(renamed, labels, sample_size, folds)
    rest = [f for f in docs.schema.fields if f.name != text]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches):
        pair = None if isinstance(model, float) else Compressors(*model[:2])
        for batch in batches:
            if pair is None:
                scores = np.full(len(batch), model)
            else:
                evidence = np.array([pair.evidence(t) for t in batch[text]]).reshape(-1, 3)
                scores = 1 / (1 + np.exp(-np.clip(_design(evidence) @ model[2], -30, 30)))
            yield batch.drop(columns=[text]).assign(score=scores)

    ship(docs.sparkSession)
    columns = [F.col(f"`{f.name}`") for f in rest] + [F.col(f"`{text}`")]
    scored = docs.select(*columns).mapInPandas(run, f"{spec}, score double")
    return scored.withColumns(
        {"held_out": bucket("doc_id", folds) == 0, "predicted": (F.col("score") >= CUT).cast("int")}
    )
