"""Byte-level BPE encoding and decoding: speculate and verify (op 3).

A word's tokens are guessed by greedy longest match. A token sequence is the
BPE encoding of its word exactly if each adjacent pair of tokens is the BPE
encoding of the two joined, so one vectorised look-up of all adjacent pairs of
a batch in a sorted table of pairs verifies the guesses; pairs that the table
lacks are settled by merging them once. Only words with a pair that fails are
merged exactly, with a heap of ranked merges (n log n, so words of any length
do). Words that repeat are looked up.

Defined results: null is the empty text, which has no ids; the texts of added
tokens found in a text become their ids, as the tokenizer file says. Unknown
bytes cannot occur, as every byte has a token. An empty table gives an empty
result; other columns pass through.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the tokenizer format: how byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters only.
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Most words that a task remembers; beyond it the memory starts anew.
MEMORY = 600_000
#: Bytes up to which a plain scan for the lowest rank is quicker than a heap.
SHORT = 40
#: Stands for "does not merge"; after every rank.
LAST = (1 << 60, -1)


def byte_characters() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in the tokenizer's
    files: printable Latin-1 for itself, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return out | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Bpe:
    """One tokenizer file, read."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_characters()
        raw = lambda token: bytes(to_byte[c] for c in token)
        self.id_of = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            self.merges[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.decoded = self.bytes_of | {i: x.encode() for x, i in self.added.items()}
        self.size = max(self.decoded) + 1
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.longest: dict[bytes, int] = {}
        for token in self.id_of:
            self.longest[token[:2]] = max(self.longest.get(token[:2], 1), len(token))
        self.words, self.ascii_words = regex.compile(WORDS), re.compile(ASCII_WORDS, re.ASCII)
        self.good = np.zeros(0, dtype=np.int64)  # pairs known to be compatible, sorted
        self.bad = np.zeros(0, dtype=np.int64)
        self.memory: dict[str, str] = {}
        self.exact_words = 0
        self.piece = {str(i): b for i, b in self.decoded.items()}

    def merged(self, word: bytes) -> list[int]:
        """Exact BPE: the lowest ranked pair merges first, the leftmost of equals."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        if n <= SHORT:
            get = self.merges.get
            ranked = [get(pair, LAST) for pair in zip(ids, ids[1:])]
            while ranked and (best := min(ranked)) is not LAST:
                i = ranked.index(best)
                ids[i : i + 2] = [best[1]]
                del ranked[i]
                if i:
                    ranked[i - 1] = get((ids[i - 1], ids[i]), LAST)
                if i < len(ranked):
                    ranked[i] = get((ids[i], ids[i + 1]), LAST)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, found[1], ids[i], ids[i + 1]) for i in range(n - 1) if (found := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, new, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (found[0], a, found[1], ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def greedy(self, word: bytes) -> list[int]:
        """The guess: the longest token that fits, from left to right."""
        whole = self.id_of.get(word)
        if whole is not None:
            return [whole]
        out, at, n, id_of = [], 0, len(word), self.id_of
        while at < n:
            end = min(n, at + self.longest.get(word[at : at + 2], 1))
            while end > at + 1 and word[at:end] not in id_of:
                end -= 1
            out.append(id_of[word[at:end]])
            at = end
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Which pairs (left * (size + 1) + right; right is ``size`` for none) stand."""
        known = _member(self.good, pairs)
        open_ = np.unique(pairs[~known & ~_member(self.bad, pairs)])
        if len(open_):
            verdict = np.zeros(len(open_), dtype=bool)
            for k, pair in enumerate(open_.tolist()):
                left, right = divmod(pair, self.size + 1)
                tokens = [left] if right == self.size else [left, right]
                verdict[k] = self.merged(b"".join(self.bytes_of[t] for t in tokens)) == tokens
            self.good = np.sort(np.concatenate([self.good, open_[verdict]]))
            self.bad = np.sort(np.concatenate([self.bad, open_[~verdict]]))
            known = _member(self.good, pairs)
        return known

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Speculate on all words, verify all adjacent pairs at once, mend the rest."""
        raw = [w.encode() for w in words]
        guesses = [self.greedy(w) for w in raw]
        sizes = np.array([len(g) for g in guesses])
        flat = np.array([t for g in guesses for t in g], dtype=np.int64)
        right = np.append(flat[1:], self.size)
        ends = np.cumsum(sizes) - 1
        right[ends] = self.size  # the last token of a word has no partner: it stands by itself
        sound = self.compatible(flat * (self.size + 1) + right)
        for k in np.flatnonzero(np.add.reduceat(~sound, ends - sizes + 1)):
            guesses[k] = self.merged(raw[k])
            self.exact_words += 1
        return guesses

    def split(self, text: str) -> list[str]:
        return (self.ascii_words if text.isascii() else self.words).findall(text)

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text in decimal, joined by commas."""
        parts = [self.cut.split(t) if self.cut and any(x in t for x in self.added) else [t] for t in texts]
        cut = [[(p in self.added, [p] if p in self.added else self.split(p)) for p in ps] for ps in parts]
        new = {w for ps in cut for special, ws in ps if not special for w in ws}.difference(self.memory)
        if len(self.memory) + len(new) > MEMORY:
            self.memory = {}
            new = {w for ps in cut for special, ws in ps if not special for w in ws}
        if new:
            order = list(new)
            for word, ids in zip(order, self.encode_words(order)):
                self.memory[word] = ",".join(map(str, ids))
        get = self.memory.__getitem__
        return [",".join([str(self.added[ws[0]]) if special else ",".join(map(get, ws)) for special, ws in ps if ws]) for ps in cut]

    def decode(self, ids: str) -> str:
        return b"".join(map(self.piece.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


def _member(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


@functools.lru_cache(maxsize=2)
def reader(path: str) -> Bpe:
    """One reader of a file for each Python worker."""
    return Bpe(path)


#: Characters that are encoded at a time, so that memory does not follow the batch.
CHUNK = 4_000_000


def chunks(texts: list[str]):
    at, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text)
        if held > CHUNK:
            yield texts[at : k + 1]
            at, held = k + 1, 0
    yield texts[at:]


def encode(text: Column, path: str) -> Column:
    """Token ids of a text, as an array; ``decode`` is its inverse."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        bpe = reader(path)
        return pd.Series([[int(i) for i in x.split(",")] if x else [] for part in chunks(texts.fillna("").tolist()) for x in bpe.encode(part)])

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    @F.pandas_udf("string")
    def text(rows: pd.Series) -> pd.Series:
        bpe = reader(path)
        return pd.Series([bpe.decode(",".join(map(str, r))) if r is not None else "" for r in rows])

    return text(ids)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the number of tokens, and the hashes of the ids and of the
    text decoded from them. The ids stay in the task: they are larger than the text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(texts: pd.Series) -> pd.DataFrame:
        bpe = reader(path)
        rows = []
        for part in chunks(texts.fillna("").tolist()):
            for ids in bpe.encode(part):
                rows.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return docs.withColumn("_bpe", of(F.col(text))).withColumns({c: F.col(f"_bpe.{c}") for c in names}).drop("_bpe")
