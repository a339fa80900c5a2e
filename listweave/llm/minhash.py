"""MinHash near-duplicates by a signature-coordinate inverted join (op 7).

Texts are lower-cased (A-Z) and cut at ASCII white space; a text's set holds its
distinct shingles of five words (a shorter text is one shingle). Texts with the
same set are one class. A class is posted under each pair of coordinate and
value of its signature. Two sets with a similarity of 0.85 agree in 27 of 32
coordinates on average and in fewer than 16 less than once in a million
(``matches``; 14 for a similarity of 0.8), so a pair is retained from that many
on. Rare postings come first: two classes that agree in 16 coordinates must
meet in the rarest ``shared - 15`` of each (the prefix), so the long postings are skipped and only looked up for pairs
that met. Retained pairs are confirmed on the full sets.

Before that a sketch sorts out pairs that cannot link: each shingle flips one of
``SKETCH`` bits, so two sketches differ in no more bits than the sets in
shingles, and two sets of together n shingles that link differ in at most
n * (100 - similarity) / (100 + similarity) of them. No link fails this.

A posting is not expanded into pairs. First each of its classes is compared with
its smallest, and so are classes that agree in a whole band of coordinates;
confirmed links form components. Then only classes of different components are
compared, and a posting's largest component only with the rest. A class that is
still open there counts its shingles that no other open class holds: they are in
no intersection, which bounds the similarity of every pair from above, and pairs
below the bound, or whose sketches differ too much, never arise. So no link between components is lost, copies cost
nothing, and a large group of near copies costs its size.

Defined results: null, empty and wordless texts have an empty set and link with
nothing. Rows that share a doc_id are one node. A null doc_id links with nothing
and stays. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash
from .components import components

WORDS = 5
COORDINATES = 32
#: Coordinates of a band of the first comparison.
BAND = 8
#: Links need 100 * intersection >= similarity * union: that of the query, and
#: that of a pipeline's stage.
SIMILARITY, STAGE_SIMILARITY = 85, 80
#: The share of pairs at the very similarity that may agree in too few coordinates.
MISSED = 2e-6
MEMORY = 150_000
#: Bits of a sketch; sets that differ in many more shingles all look alike to it.
SKETCH = 1024
_RNG = np.random.default_rng(20240607)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self):
        self.memory: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memory = self.memory
        new = [w for w in set(words) if w not in memory]
        if len(memory) + len(new) > MEMORY:
            memory.clear()
            new = set(words)
        for w in new:
            memory[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))


hashes = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = hashes(words)
    width = min(WORDS, len(h))
    rolled = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for k in range(width):
        rolled = rolled * _BASE + h[k : len(h) - width + 1 + k]
    return np.unique(mixed(rolled + np.uint64(width)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of coordinates for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDINATES), dtype=np.int64)
    for k in range(COORDINATES):
        x = (flat ^ _SHIFTS[k]) * _MULTIPLIERS[k]
        out[:, k] = np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts).view(np.int64)
    return out


def sketch(found: np.ndarray) -> list[int]:
    """Each of ``SKETCH`` bits as 64-bit words: is it hit by an odd number of shingles?"""
    hit = np.bincount((found * _BASE >> np.uint64(32)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(hit.astype(np.uint8)).view(np.int64).tolist()


def _described(texts: pd.Series) -> pd.DataFrame:
    out = []
    texts = texts.where(texts.notna(), None).tolist()
    for at in range(0, len(texts), 256):
        sets = [shingles(t) for t in texts[at : at + 256]]
        full = [s for s in sets if len(s)]
        rows = iter(signatures(full).tolist() if full else [])
        out += [(len(s), hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None, next(rows) if len(s) else None, sketch(s) if len(s) else None) for s in sets]
    return pd.DataFrame(out, columns=["n_shingles", "set_key", "signature", "sketch"])


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, set_key, signature, sketch) of every row."""
    udf = F.pandas_udf(_described, "n_shingles long, set_key string, signature array<long>, sketch array<long>")
    return docs.select(key, udf(F.col(text)).alias("_d")).select(key, "_d.*")


def matches(similarity: int) -> int:
    """Coordinates that all but MISSED of the pairs of this similarity agree in."""
    p, missed, k = similarity / 100, 0.0, 0
    while k < COORDINATES:
        missed += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if missed > MISSED:
            break
        k += 1
    return max(k, 1)


def _similar(similarity: int):
    def one(x, y):
        x, y = shingles(x), shingles(y)
        both = np.intersect1d(x, y, assume_unique=True).size
        return bool(both) and 100 * both >= similarity * (len(x) + len(y) - both)

    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=bool)

    return F.pandas_udf(of, "boolean")


def _may_link(similarity: int, a: str = "ka", b: str = "kb", na: str = "na", nb: str = "nb") -> Column:
    """Do the sketches differ in no more bits than two sets that link in shingles?"""
    differing = reduce(add, [F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH // 64)])
    return differing * (100 + similarity) <= (F.col(na) + F.col(nb)) * (100 - similarity)


def _retained(pairs: DataFrame, reps: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose signatures agree in enough coordinates, and their sketches in enough bits."""
    of = lambda x: reps.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("signature").alias(f"s{x}"), F.col("sketch").alias(f"k{x}"))
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return pairs.join(of("a"), "a").join(of("b"), "b").filter((same >= matches(similarity)) & _may_link(similarity)).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, similarity: int) -> DataFrame:
    """Pairs that are similar on the full sets."""
    udf = _similar(similarity)
    of = lambda x: docs.select(F.col(key).alias(x), F.col(text).alias(f"t{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(udf("ta", "tb")).select("a", "b").distinct()


def _own_shingles(open_: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(rep, own): shingles of each open class that no other open class holds."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).view(np.int64) for t in texts.where(texts.notna(), None)])

    # ids with several rows may have several texts: no shingle of theirs counts as own
    several = docs.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(F.col(key).alias("rep"))
    rows = docs.join(open_, docs[key] == open_["rep"])
    each = rows.select("rep", F.explode(F.pandas_udf(of, "array<long>")(text)).alias("h"))
    alone = each.groupBy("h").agg(F.count("*").alias("n"), F.min("rep").alias("rep")).filter("n = 1")
    return stash(alone.join(several, "rep", "left_anti").groupBy("rep").agg(F.count("*").alias("own")), "own")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``."""
    least = matches(similarity)
    docs = docs.select(key, text)
    rows = stash(described(docs, key, text), "signatures")
    classes = stash(rows.filter(F.col("set_key").isNotNull() & F.col(key).isNotNull()).groupBy("set_key").agg(F.min(key).alias("rep"), F.count("*").alias("_n")), "classes")
    copies = classes.filter("_n > 1").select("set_key", "rep")
    placed = stash(rows.join(copies, "set_key", "left").withColumn("rep", F.coalesce("rep", F.when(F.col("set_key").isNotNull(), F.col(key)))), "classes")
    reps = placed.filter(F.col(key) == F.col("rep")).select("rep", "n_shingles", "signature", "sketch")

    post = reps.select("rep", "n_shingles", F.posexplode("signature").alias("k", "v")).select("rep", "n_shingles", F.xxhash64("k", "v").alias("post"))
    lengths = stash(post.groupBy("post").agg(F.count("*").alias("n")).filter("n > 1"), "postings")
    met = post.join(lengths, "post")
    # the prefix: of a class's postings that others share, all but the least - 1 longest
    ranked = met.groupBy("rep", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("shared"))  # at most COORDINATES each
    prefix = F.slice("shared", 1, F.greatest(F.size("shared") - (least - 1), F.lit(0)))
    postings = stash(ranked.filter(F.size("shared") >= least).select("rep", "n_shingles", F.explode(prefix["post"]).alias("post")), "prefix")

    smallest = stash(postings.groupBy("post").agg(F.min("rep").alias("b")), "smallest")
    bands = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - BAND), F.lit(BAND)), lambda k: F.xxhash64(F.slice("signature", k + 1, BAND))))
    banded = reps.select("rep", bands.alias("k", "v")).select("rep", F.xxhash64("k", "v").alias("post"))
    closest = stash(banded.groupBy("post").agg(F.min("rep").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n"), "bands")
    stars = postings.select("rep", "post").join(smallest, "post").union(banded.join(closest, "post").select("post", "rep", "b"))
    stars = stars.filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    links = stash(_confirmed(_retained(stars, reps, similarity), docs, key, text, similarity), "links")
    first = components(links)

    of = first.select(F.col("node").alias("rep"), "component")
    grouped = stash(postings.join(of, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "grouped")
    shares = grouped.groupBy("post", "component").agg(F.count("*").alias("n"))
    mixed_posts = stash(shares.groupBy("post").agg(F.max_by("component", F.struct("n", "component")).alias("home"), F.count("*").alias("groups")).filter("groups > 1").drop("groups"), "mixed")
    open_rows = stash(grouped.join(mixed_posts, "post"), "open")
    own = _own_shingles(open_rows.select("rep").distinct(), docs, key, text)
    bounded = open_rows.join(own, "rep", "left").withColumn("common", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
    bounded = bounded.filter(100 * F.col("common") >= similarity * F.col("n_shingles"))
    open_rows = stash(bounded.join(reps.select("rep", "n_shingles", "sketch"), ["rep", "n_shingles"]), "open")
    strays = open_rows.filter("component <> home").select("post", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("n_shingles").alias("na"), F.col("common").alias("ma"), F.col("sketch").alias("ka"))
    others = open_rows.select("post", F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("n_shingles").alias("nb"), F.col("common").alias("mb"), F.col("sketch").alias("kb"), (F.col("component") == F.col("home")).alias("at_home"))
    across = (
        strays.join(others, "post")
        .filter((F.col("ca") != F.col("cb")) & (F.col("at_home") | (F.col("a") < F.col("b"))))
        .filter(100 * F.least("ma", "mb") >= similarity * (F.col("na") + F.col("nb") - F.least("ma", "mb")))
        .filter(_may_link(similarity))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = stash(_confirmed(_retained(across, reps, similarity), docs, key, text, similarity), "links")
    final = components(links.union(more)).select(F.col("node").alias("rep"), "component")
    return (
        placed.join(final, "rep", "left")
        .select(key, "n_shingles", F.coalesce("component", "rep", key).alias("component_id"))
    )


def keep_one(docs: DataFrame, key: str = "doc_id", similarity: int = STAGE_SIMILARITY) -> DataFrame:
    """``docs`` without those that a smaller ``key`` of their component stands for."""
    found = near_duplicates(docs, key, similarity=similarity)
    gone = found.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[key] == F.col("_gone"), "left_anti")
