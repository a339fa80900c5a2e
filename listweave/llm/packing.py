"""Packing into optimal length buckets (op 2).

The global histogram of lengths decides the buckets: dynamic programming over
it finds the ``BUCKETS`` boundaries with the least padding in total. A text
longer than ``MAX_LENGTH`` words is cut into consecutive pieces, so nothing is
dropped and the histogram has at most that many cells, whatever the table.
Inside a bucket, pieces form batches of as many rows as the token budget holds
at the bucket's length. Rows are numbered shard by shard with offsets from the
shards' counts, so a bucket with most of the rows is never one task.

Defined results: a null, empty or wordless text is one piece of length 0 with
no bucket and no batch. Repeated rows are packed each. An empty table gives an
empty result. Rows of a bucket are numbered by hash and key, so equal inputs
give equal batches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

BUCKETS, MAX_LENGTH, TOKEN_BUDGET = 8, 4096, 16_384
#: Rows of a shard, and the most shards.
SHARD_ROWS, MOST_SHARDS = 256, 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper ends of the buckets that minimise the padding of ``histogram``
    (length -> rows); at most ``buckets``, the last one the greatest length."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    rows = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()])]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum([histogram[x] * x for x in lengths.tolist()])]).astype(np.float64)
    n = len(lengths)
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            padded = best[:j] + (rows[j] - rows[:j]) * lengths[j - 1] - (tokens[j] - tokens[:j])
            cut[j] = int(padded.argmin())
            new[j] = padded[cut[j]]
        cuts.append(cut)
        best = new
    out, at = [], n
    for cut in reversed(cuts):
        if at:
            out.append(int(lengths[at - 1]))
            at = int(cut[at])
    return out[::-1]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", max_length: int = MAX_LENGTH) -> DataFrame:
    """(key, piece, start, length): the word ranges of each text that are packed."""
    n = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD))
    counted = docs.select(key, n.alias("_n"))
    last = F.greatest(F.ceil(F.col("_n") / max_length).cast("int") - 1, F.lit(0))
    cut = counted.select(key, "_n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece") * max_length
    return cut.select(key, "piece", start.alias("start"), F.least(F.col("_n") - start, F.lit(max_length)).alias("length"))


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, max_length: int = MAX_LENGTH, budget: int = TOKEN_BUDGET) -> DataFrame:
    """(key, piece, start, length, bucket, batch, slot, padding) of every piece."""
    found = stash(pieces(docs, key, text, max_length), "pieces")
    histogram = {r["length"]: r["n"] for r in found.filter("length > 0").groupBy("length").agg(F.count("*").alias("n")).collect()}
    ends = boundaries(histogram, buckets)
    if not ends:
        none = F.lit(None)
        return found.withColumns({"bucket": none.cast("int"), "batch": none.cast("long"), "slot": none.cast("int"), "padding": F.lit(0)})
    shards = max(1, min(MOST_SHARDS, sum(histogram.values()) // SHARD_ROWS))
    bucket = F.when(F.col("length") > 0, F.array_min(F.filter(F.array(*[F.lit(x) for x in ends]), lambda x: x >= F.col("length"))))
    order = F.xxhash64(F.col(key), F.col("piece"))
    rows = found.withColumn("bucket", bucket).withColumn("_shard", F.pmod(order, F.lit(shards)).cast("int"))
    numbered = rows.withColumn("_row", F.row_number().over(Window.partitionBy("bucket", "_shard").orderBy(order, F.col(key), "piece")) - 1)
    sizes = rows.groupBy("bucket", "_shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("bucket").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    at = numbered.join(offsets, numbered["bucket"].eqNullSafe(offsets["bucket"]) & (numbered["_shard"] == offsets["_shard"])).drop(offsets["bucket"]).drop(offsets["_shard"])
    place = F.col("_row") + F.col("_offset")
    capacity = F.greatest(F.floor(F.lit(budget) / F.col("bucket")), F.lit(1))
    return at.select(
        key, "piece", "start", "length", "bucket",
        F.floor(place / capacity).cast("long").alias("batch"),
        F.when(F.col("bucket").isNotNull(), place % capacity).cast("int").alias("slot"),
        F.coalesce(F.col("bucket") - F.col("length"), F.lit(0)).alias("padding"),
    )
