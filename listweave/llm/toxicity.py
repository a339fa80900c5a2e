"""Toxicity: subword bags averaged into a linear softmax (op 1).

A text is cut into windows of about ``WINDOW`` tokens, each window is one bag,
and the text scores as its most toxic window: a slur of a few words is as
visible in a book as in a short remark. Training learns the windows too: it
starts with every window of a toxic text as a positive and then keeps, epoch
by epoch, the window that the model finds most toxic, against the clean texts'
windows that it finds most toxic and some of their others. A last logistic fit on
rows kept from training turns the window logit into the score.

Defined results: null and empty texts, and texts without letter or digit, are
one empty bag and get the prior score of the fit, below ``REJECT``. Ties and
repeated rows score alike, since a score depends on the text alone. Rows whose
label is null are not learned from. If the labelled sample lacks a class, every
text scores 0. An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import bounded_sample
from .subword import Frozen, SubwordSoftmax, Vocabulary, blocks

#: Tokens of a window.
WINDOW = 24
#: Neutral words added to each bag, so that the mean of a bag of one or two
#: words is no more extreme than that of a full window.
NEUTRAL = 8
#: Score from which a text counts as toxic.
REJECT = 0.7
#: Most labelled rows of each class that training reads; whole texts.
SAMPLE = 1500
#: Windows of a clean text in an epoch: the most toxic ones, and others at random.
HARDEST, RANDOM = 2, 3
#: Windows of a training step, and the fewest steps: small samples get more epochs.
BATCH, LEAST_STEPS = 256, 300


def window_starts(n: int) -> np.ndarray:
    """Starts of near-equal windows over n tokens."""
    return np.linspace(0, n, max(1, round(n / WINDOW)), endpoint=False).astype(np.int64)


def _windows(bag: np.ndarray) -> list[np.ndarray]:
    """Distinct words of each window: a repeated word counts once."""
    return [np.unique(w) for w in np.split(bag, window_starts(len(bag))[1:])] if len(bag) else []


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 500) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic fit with a small ridge (Newton)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - y) * x).sum() + 0.01 * (a - 1), (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1, 2 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


class ToxicityModel:
    def __init__(self, frozen: Frozen | None, slope: float, offset: float):
        self.frozen, self.slope, self.offset = frozen, slope, offset

    def raw(self, texts: list[str]) -> np.ndarray:
        """Logit of each text's most toxic window; 0 if there is nothing to read."""
        out = np.zeros(len(texts))
        rows = self.frozen.token_rows(texts)
        full = [k for k, r in enumerate(rows) if len(r)]
        if not full:
            return out
        starts = [window_starts(len(rows[k])) for k in full]
        first = np.cumsum([0] + [len(s) for s in starts])[:-1]
        window = np.concatenate([np.repeat(np.arange(len(s)) + f, np.diff(np.append(s, len(rows[k])))) for k, s, f in zip(full, starts, first)])
        n = len(self.frozen.rows)
        pairs = np.unique(window * n + np.concatenate([rows[k] for k in full]))
        window, gain = pairs // n, (self.frozen.rows[:, 1] - self.frozen.rows[:, 0])[pairs % n]
        values = np.bincount(window, weights=gain) / (np.bincount(window) + NEUTRAL)
        out[full] = np.maximum.reduceat(values, first) + self.frozen.bias[1] - self.frozen.bias[0]
        return out

    def scores(self, texts: list) -> np.ndarray:
        if self.frozen is None or not len(texts):
            return np.zeros(len(texts))
        z = np.concatenate([self.raw([t or "" for t in part]) for part in blocks(texts)])
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30)))


def fit(texts: list[str], labels: list[int], epochs: int = 10, seed: int = 7) -> ToxicityModel:
    """Learns from whole texts; every fifth is kept for the calibration."""
    y = np.asarray(labels, dtype=np.int64)
    texts = [t or "" for t in texts]
    if len(set(y.tolist())) < 2:
        return ToxicityModel(None, 0.0, 0.0)
    order = np.random.default_rng(seed).permutation(len(y))
    held = order[::5] if min((y == 0).sum(), (y == 1).sum()) >= 25 else order[:0]
    model = SubwordSoftmax(2, seed=seed, neutral=NEUTRAL)
    used = np.setdiff1d(order, held)
    vocabulary = Vocabulary([texts[i] for i in used], model.buckets)
    bags = [(window, k, y[i]) for k, i in enumerate(used) for window in _windows(vocabulary.bags[k])]
    if not bags:
        return ToxicityModel(None, 0.0, 0.0)
    of_doc: dict[int, list[np.ndarray]] = {}
    for window, k, _ in bags:
        of_doc.setdefault(k, []).append(window)
    batches = 1 + len(used) * (HARDEST + RANDOM) // 2 // BATCH
    for epoch in range(max(epochs, LEAST_STEPS // batches)):
        chosen: list[np.ndarray] = []
        targets, weight = [], []
        if epoch:
            z = model.word_logits(vocabulary)
            gain = z[:, 1] - z[:, 0]
        for k, windows in of_doc.items():
            toxic = int(y[used[k]])
            picked = range(len(windows)) if toxic else model.rng.choice(len(windows), min(len(windows), RANDOM), replace=False)
            if epoch:
                value = np.array([gain[w].sum() / (len(w) + NEUTRAL) for w in windows])
                hardest = np.argsort(-value, kind="stable")[: 1 if toxic else HARDEST]
                picked = hardest if toxic else set(hardest.tolist()) | set(picked.tolist())
            chosen += [windows[i] for i in picked]
            targets += [toxic] * len(picked)
            weight += [(1 / len(picked)) if toxic else 1.0] * len(picked)
        targets, weight = np.asarray(targets), np.asarray(weight)
        weight[targets == 1] *= max(1.0, 0.3 * weight[targets == 0].sum() / weight[targets == 1].sum())
        model.epoch(vocabulary, chosen, targets, weight, BATCH)
    out = ToxicityModel(model.frozen(), 1.0, 0.0)
    check = held if len(held) else order
    out.slope, out.offset = logistic(out.raw([texts[i] for i in check]), y[check].astype(float))
    return out


def learn(docs: DataFrame, labels: DataFrame, learnable, sample: int = SAMPLE) -> ToxicityModel:
    """Fits on at most about ``sample`` labelled rows of each class among those
    that ``learnable`` (a condition on doc_id) admits."""
    known = labels.filter(F.col("toxic").isin(0, 1) & learnable).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    chosen = bounded_sample(known, "_toxic", "doc_id", sample)  # at most about two samples of ids
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.select("doc_id", "text", "_toxic").toPandas().sort_values(["doc_id", "text"], na_position="first")
    return fit(found["text"].where(found["text"].notna(), None).tolist(), found["_toxic"].tolist())


def scored(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: buckets x classes

    @F.pandas_udf(DoubleType())
    def score_of(texts: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.scores(texts.where(texts.notna(), None).tolist()))

    return docs.withColumn(score, score_of(F.col(text)))


def crc_mod(key: str, n: int):
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = REJECT) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more, all columns kept."""
    model = learn(docs, labels, F.lit(True))
    return scored(docs, model, score="_toxicity").filter(F.col("_toxicity") < threshold).drop("_toxicity")
