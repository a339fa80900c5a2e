"""Language ID: averaged hashed subword embeddings with a linear softmax (op 5).

Trained by stochastic gradient descent in numpy on a bounded sample of whole
labelled texts. The softmax is calibrated on rows kept from training: one
temperature is fitted to their likelihood, and the rejection threshold is the
confidence below which no more than ``CLEAN_LOSS`` of those rows, read
rightly, would be lost (never above ``MOST_REJECT``).

Defined results: ``und`` with score 0 for null, empty and letterless texts, and
for every text if nothing could be learned. Equal texts get equal results. Rows
with a null language are not learned from. An empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample
from .subword import Frozen, SubwordSoftmax, Vocabulary, blocks

UND = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Most rows of each language that training reads; whole texts.
SAMPLE = 250
#: Bags of training: tokens of a piece of text.
PIECE = 60
CLEAN_LOSS, MOST_REJECT = 0.001, 0.5


class LanguageModel:
    def __init__(self, names: list[str], frozen: Frozen | None, temperature: float = 1.0, reject: float = 0.0):
        self.names, self.frozen, self.temperature, self.reject = names, frozen, temperature, reject

    def logits(self, texts: list[str]) -> np.ndarray:
        """Mean of each text's words, plus the bias."""
        rows = self.frozen.token_rows(texts)
        out = np.tile(self.frozen.bias, (len(texts), 1))
        full = [k for k, r in enumerate(rows) if len(r)]
        if full:
            sizes = np.array([len(rows[k]) for k in full])
            sums = np.add.reduceat(self.frozen.rows[np.concatenate([rows[k] for k in full])], np.cumsum(sizes) - sizes)
            out[full] += sums / sizes[:, None]
        return out

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for part in blocks(texts):
            read = [t if self.frozen and t and LETTER.search(t) else None for t in part]
            z = self.logits([t or "" for t in read]) / self.temperature if self.frozen else np.zeros((len(part), 1))
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for text, k, best in zip(read, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                names.append(UND if text is None else self.names[k])
                scores.append(0.0 if text is None else best)
        return names, scores


def fit(texts: list[str], langs: list[str], epochs: int = 4, seed: int = 11) -> LanguageModel:
    texts = [t or "" for t in texts]
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], None)
    y = np.asarray([names.index(x) for x in langs])
    order = np.random.default_rng(seed).permutation(len(y))
    held, used = (order[::5], np.setdiff1d(order, order[::5])) if len(y) >= 20 * len(names) else (order[:0], order)
    model = SubwordSoftmax(len(names), rate=0.1, seed=seed)
    vocabulary = Vocabulary([texts[i] for i in used], model.buckets)
    pieces = [(bag[a : a + PIECE], y[i]) for bag, i in zip(vocabulary.bags, used) for a in range(0, len(bag), PIECE)]
    if not pieces:
        return LanguageModel(names, None)
    targets = np.asarray([t for _, t in pieces])
    per_class = np.bincount(targets, minlength=len(names))
    for _ in range(epochs):
        model.epoch(vocabulary, [p for p, _ in pieces], targets, 1 / per_class[targets])
    out = LanguageModel(names, model.frozen())
    check = [i for i in (held if len(held) else order) if LETTER.search(texts[i])]
    if check:
        z = out.logits([texts[i] for i in check])
        grid = np.geomspace(0.05, 20, 60)
        out.temperature = float(min(grid, key=lambda t: _loss(z / t, y[check])))
        p = np.exp(z / out.temperature - (z / out.temperature).max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y[check]])
        if len(right):
            out.reject = float(min(MOST_REJECT, right[int(CLEAN_LOSS * len(right))]))
    return out


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    top = z.max(axis=1)
    return float((np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(len(y)), y]).mean())


def learn(docs: DataFrame, learnable, sample: int = SAMPLE) -> LanguageModel:
    """Fits on at most about ``sample`` rows of each language among those that
    ``learnable`` (a condition) admits."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & learnable)
    rows = bounded_sample(known.select("doc_id", "text", "lang"), "lang", "doc_id", sample).toPandas().sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), rows["lang"].tolist())


def identified(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` of each whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: buckets x languages

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        names, scores = shipped.value.predict(texts.where(texts.notna(), None).tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    out = docs.withColumn("_lang", of(F.col(text))).withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")
    return out.withColumn("rejected", (F.col("lang_pred") == UND) | (F.col("score") < F.lit(model.reject)))


def reject_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language stays open, all columns kept."""
    model = learn(docs, F.lit(True))
    kept = docs.columns
    renamed = docs.select(F.struct(*[F.col(c) for c in kept]).alias("_row"), F.col("text").alias("_text"))
    return identified(renamed, model, "_text").filter(~F.col("rejected")).select("_row.*")
