"""Bags of subwords averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed character n-grams, a bag is the
mean of its words, and a linear softmax reads the bag. Words that share
n-grams share vectors, so a spelling never seen in training still scores like
its neighbours. As everything up to the softmax is linear, a trained model
reduces to one logit vector per word: inside a task each distinct word is
hashed once and then looked up.
"""

from __future__ import annotations

import re

import numpy as np

PARTS = re.compile(r"[^\W_]+")
#: Most words that a task remembers; beyond it the memory starts anew.
MEMORY = 120_000
#: Tokens that are hashed at a time.
CHUNK = 10_000


_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def ngrams(tokens: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the character n-grams of lower-cased tokens, and of their
    whole words, with the ends of words marked: all of them in token order, and
    how many each token has."""
    parts = [_ngrams(tokens[at : at + CHUNK], buckets) for at in range(0, len(tokens), CHUNK)] or [_ngrams([], buckets)]
    return np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])


def _ngrams(tokens: list[str], buckets: int, sizes=(3, 4, 5)) -> tuple[np.ndarray, np.ndarray]:
    marked = [f"<{'><'.join(parts)}>" if (parts := PARTS.findall(t)) else "" for t in tokens]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return np.zeros(0, dtype=np.int32), np.zeros(len(tokens), dtype=np.int64)
    token = np.repeat(np.arange(len(tokens)), np.fromiter(map(len, marked), dtype=np.int64, count=len(marked)))
    begins = np.flatnonzero(codes == ord("<"))
    word = np.cumsum(codes == ord("<")) - 1
    powers = np.cumprod(np.full(int(np.diff(np.append(begins, len(codes))).max()), _PRIME))
    found = [(token[begins], np.add.reduceat(codes * powers[np.arange(len(codes)) - begins[word]], begins))]
    for n in sizes:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                h = h * _PRIME + codes[k : len(codes) - n + 1 + k]
            inside = word[: len(h)] == word[n - 1 :]
            found.append((token[: len(h)][inside], h[inside]))
    of = np.concatenate([t for t, _ in found])
    h = np.concatenate([x for _, x in found])
    h = ((h ^ (h >> np.uint64(29))) * _MIX >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(of, kind="stable")
    return h[order].astype(np.int32), np.bincount(of, minlength=len(tokens))


class Vocabulary:
    """Distinct tokens of the training sample, with their n-grams as one ragged array."""

    def __init__(self, texts: list[str], buckets: int):
        split = [t.lower().split() for t in texts]
        tokens = list(dict.fromkeys(t for bag in split for t in bag))
        self.grams, sizes = ngrams(tokens, buckets)
        row = np.cumsum(sizes > 0) - 1
        ids = {t: int(row[k]) if sizes[k] else -1 for k, t in enumerate(tokens)}
        bags = [np.fromiter(map(ids.__getitem__, bag), dtype=np.int64, count=len(bag)) for bag in split]
        self.bags = [bag[bag >= 0] for bag in bags]
        self.sizes = sizes[sizes > 0]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + size)."""
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


class SubwordSoftmax:
    """Embeddings and softmax weights, fitted by stochastic gradient descent
    with a step per parameter that shrinks with its past gradients."""

    def __init__(self, classes: int, buckets: int = 1 << 16, dim: int = 8, rate: float = 0.3, seed: int = 7, neutral: int = 0):
        rng = np.random.default_rng(seed)
        self.rng, self.rate, self.buckets, self.neutral = rng, rate, buckets, neutral
        self.emb = (rng.standard_normal((buckets, dim)) * 0.1).astype(np.float32)
        self.out = (rng.standard_normal((dim, classes)) * 0.1).astype(np.float32)
        self.bias = np.zeros(classes, dtype=np.float32)
        self._past = [np.full(p.shape, 1e-6, dtype=np.float32) for p in (self.emb, self.out, self.bias)]

    def _step(self, k: int, grad: np.ndarray) -> None:
        self._past[k] += grad * grad
        (self.emb, self.out, self.bias)[k][...] -= self.rate * grad / np.sqrt(self._past[k])

    def epoch(self, vocabulary: Vocabulary, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, batch: int = 256) -> None:
        order = self.rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            picked = order[at : at + batch]
            sizes = np.asarray([len(bags[i]) for i in picked])
            words, inverse = np.unique(np.concatenate([bags[i] for i in picked]), return_inverse=True)
            bag_of = np.repeat(np.arange(len(picked)), sizes)
            n_grams = vocabulary.sizes[words]
            grams = vocabulary.grams[ragged(vocabulary.starts[words], n_grams)]
            firsts = np.concatenate([[0], np.cumsum(n_grams)[:-1]])
            vectors = np.add.reduceat(self.emb[grams], firsts) / n_grams[:, None]
            # mean of the bag's words, as a sum over (bag, word) with the word's share
            share = np.bincount(bag_of * len(words) + inverse, minlength=len(picked) * len(words)).reshape(len(picked), len(words)) / (sizes[:, None] + self.neutral)
            share = share.astype(np.float32)
            means = share @ vectors
            logits = means @ self.out + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(picked)), y[picked]] -= 1
            p *= (weight[picked] / weight[picked].sum())[:, None]
            to_grams = np.repeat((share.T @ (p @ self.out.T)) / n_grams[:, None], n_grams, axis=0)
            grad = np.stack([np.bincount(grams, weights=to_grams[:, d], minlength=self.buckets) for d in range(self.emb.shape[1])], axis=1)
            self._step(1, means.T @ p)
            self._step(2, p.sum(axis=0))
            self._step(0, grad.astype(np.float32))

    def word_logits(self, vocabulary: Vocabulary) -> np.ndarray:
        """Logits that each vocabulary word gives to a bag of its own, without the bias."""
        projected = self.emb @ self.out
        sums = np.add.reduceat(projected[vocabulary.grams], vocabulary.starts[:-1])
        return sums / vocabulary.sizes[:, None]

    def frozen(self) -> "Frozen":
        return Frozen((self.emb @ self.out).astype(np.float32), self.bias.astype(np.float64))


class Frozen:
    """A fitted model as tasks use it: logits per n-gram bucket, and a memory of words."""

    def __init__(self, projected: np.ndarray, bias: np.ndarray):
        self.projected, self.bias, self.memory = projected, bias, {}
        self.rows = np.zeros((1, len(bias)))

    def __getstate__(self):
        return self.projected, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def token_rows(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the row numbers of its tokens in ``rows``, without the
        tokens that have no letter or digit."""
        split = [t.lower().split() for t in texts]
        new = set().union(*split).difference(self.memory)
        if len(self.memory) + len(new) > MEMORY:
            self.memory, self.rows, new = {}, np.zeros((1, len(self.bias))), set().union(*split)
        if new:
            new = list(new)
            grams, sizes = ngrams(new, len(self.projected))
            full = np.flatnonzero(sizes)
            row = np.zeros(len(new), dtype=np.int64)
            row[full] = len(self.rows) + np.arange(len(full))
            self.memory.update(zip(new, row.tolist()))
            if len(full):
                starts = np.cumsum(sizes[full]) - sizes[full]
                sums = np.add.reduceat(self.projected[grams], starts, axis=0, dtype=np.float64)
                self.rows = np.concatenate([self.rows, sums / sizes[full][:, None]])
        get = self.memory.__getitem__
        rows = [np.fromiter(map(get, bag), dtype=np.int64, count=len(bag)) for bag in split]
        return [r[r > 0] for r in rows]


def blocks(texts: list, chars: int = 1 << 20):
    """Runs of texts of about so many characters, so that memory follows the
    longest text, not the batch."""
    at, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held > chars:
            yield texts[at : k + 1]
            at, held = k + 1, 0
    if at < len(texts):
        yield texts[at:]
