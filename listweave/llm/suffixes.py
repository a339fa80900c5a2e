"""Suffix-array dedup by column-wise multi-document construction (op 4).

A byte goes if some 400-byte string that covers it also starts elsewhere.

1. Each text is thinned to anchors: the 64-byte strings with the smallest hash
   among those inside some 400-byte string. A 400-byte string has its anchor at
   the same place wherever it stands, so equal strings meet under one anchor, and
   an anchor's context (what the 400-byte strings around it may cover) decides
   about them. Anchors that stand once, about 1 per 170 bytes, end here.
2. Contexts that are equal as a whole decide each other: all their strings
   repeat. One of each such set stays as a partner for the others.
3. For the other contexts of an anchor, aligned at it, the sorted order of their
   suffixes and the common prefixes of neighbours are built column by column
   from the right: each round inserts one byte per context, read from a
   sequential column file; the new order is the old one sorted stably by the new
   byte (the step of a collection's Burrows-Wheeler transform), and a
   new common prefix is one longer than the least old one between two
   neighbours of the same byte. A string starting in this column repeats if a
   neighbour shares 400 bytes.
4. An anchor with more than ``CHUNK`` different contexts is not brought into one
   task. Its range of string starts is halved; contexts are grouped by the bytes
   that all strings of a half share, contexts equal in all that the half covers
   decide each other, and so on until groups are small. Counts are aggregates, so
   no key is hot.

Why not one construction over all bytes: it needs as many rounds as the longest
text has bytes, each passing over the whole transform so far. The anchors cut a
collection of n bytes into columns of at most 736, which keeps the method's step
and its results exact, and leaves the work in proportion to n.

Hashes serve to group; all decisions in step 3 compare bytes, those in steps 2
and 4 two or more 64-bit hashes of the same bytes.

Defined results: null is the empty text; texts under 400 bytes keep everything
and remove nothing elsewhere. Rows equal in id and text repeat each other. Matches never cross
texts; overlapping ones count. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stash, mapped, stash
from .minhash import mixed

LENGTH, GRAM = 400, 64
#: Most places of an anchor within a 400-byte string.
SPAN = LENGTH - GRAM + 1
#: Most contexts of a group that one task builds columns for, and rows of a task.
CHUNK, TASK_ROWS = 256, 4096
#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 19
SPOOL = 64 << 20
_BASE, _BYTES = np.uint64(0xD6E8FEB86659FD93), np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = SEGMENT + 2 * LENGTH + 1
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)])), np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]))


class Prefixes:
    """Hashes of any range of some bytes, from prefix sums modulo 2^64."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers()
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[raw] * up[: len(raw)])])

    def hash(self, start, end):
        length = np.asarray(end - start).astype(np.uint64)
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + length * np.uint64(0x9E3779B97F4A7C15))


def anchors(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of the anchors, their hashes, the hashes of their contexts, and the
    least and most bytes by which a 400-byte string may start before each."""
    n, found = len(raw), []
    for at in range(0, max(0, n - LENGTH + 1), SEGMENT):
        begin, end = max(0, at - LENGTH), min(n, at + SEGMENT + 2 * LENGTH)
        part = Prefixes(raw[begin:end])
        low = at - begin  # strings start in [at, at + SEGMENT)
        starts = min(SEGMENT, n - LENGTH + 1 - at)
        place = np.arange(low, low + starts + SPAN - 1)
        h = part.hash(place, place + GRAM)
        keys = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(keys) // SPAN) * SPAN, np.iinfo(np.uint64).max)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, SPAN)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[SPAN - 1 : SPAN - 1 + starts])
        chosen = np.unique((least & np.uint64((1 << 20) - 1)).astype(np.int64))
        a = chosen + at
        lo, hi = np.maximum(0, a + LENGTH - n), np.minimum(SPAN - 1, a)
        full = part.hash(a - hi - begin, a - lo + LENGTH - begin) + mixed((lo * 1024 + hi).astype(np.uint64))
        found.append((a, h[chosen], full, lo, hi))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    a, h, full, lo, hi = (np.concatenate(x) for x in zip(*found))
    once = np.unique(a, return_index=True)[1]
    return a[once], h[once].view(np.int64), full[once].view(np.int64), lo[once], hi[once]


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _anchor_rows(batch: pa.RecordBatch):
    """Rows of the anchors of a slice of texts."""
    found = [anchors(as_bytes(t)) for t in batch.column("text").to_pylist()]
    of = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
    columns = [np.concatenate(x) for x in zip(*found)]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    arrays = [batch.column(c).take(pa.array(of)) for c in ("doc", "hash")] + [pa.array(c, k) for c, k in zip(columns, kinds)]
    yield pa.RecordBatch.from_arrays(arrays, names=["doc", "hash", "pos", "key", "full", "lo", "hi"])


def _context_rows(batch: pa.RecordBatch):
    """Rows of the open anchors of a slice of texts, with the bytes around them."""
    of, rows, contexts = [], [], []
    for k, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("rows").to_pylist())):
        raw = (text or "").encode("utf-8", "surrogatepass")
        of += [k] * len(found)
        rows += found
        contexts += [raw[r["pos"] - r["hi"] : r["pos"] - r["lo"] + LENGTH] for r in found]
    kinds = {"pos": pa.int32(), "key": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "single": pa.bool_()}
    arrays = [batch.column(c).take(pa.array(of, pa.int64())) for c in ("doc", "hash")]
    arrays += [pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()] + [pa.array(contexts, pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, names=["doc", "hash", *kinds, "bytes"])


def repeated(group: np.ndarray, contexts: list[bytes], lo: np.ndarray, hi: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context the least and the most start distance, within [least,
    most], of a string that another context of its group holds too (-1: none).

    Columns run from the last byte that any string covers to the first start."""
    n = len(contexts)
    first, past = -int(hi.max(initial=0)), LENGTH - int(lo.min(initial=0))
    table = np.full((past - first, n), 256, dtype=np.uint16)  # 256: no byte there
    for k, (context, h) in enumerate(zip(contexts, hi)):
        table[-h - first : -h - first + len(context), k] = np.frombuffer(context, dtype=np.uint8)
    order = np.argsort(group, kind="stable")
    common = np.zeros(n + 1, dtype=np.int64)  # common[i]: of the suffixes at places i - 1 and i
    down, up = np.full(n, -1), np.full(n, -1)
    with tempfile.SpooledTemporaryFile(max_size=SPOOL) as file:  # column after column, the last one first
        file.write(table[::-1].tobytes())
        del table
        file.seek(0)
        for column in range(past - 1, first - 1, -1):
            byte = np.frombuffer(file.read(2 * n), dtype=np.uint16)[order]
            bucket = group[order] * 257 + byte
            moved = np.argsort(bucket, kind="stable")
            same = (np.diff(bucket[moved]) == 0) & (byte[moved][1:] < 256)
            new = np.zeros(n + 1, dtype=np.int64)
            pair = np.flatnonzero(same)
            if len(pair):
                ends = np.stack([moved[pair] + 1, moved[pair + 1] + 1], axis=1).ravel()
                new[pair + 1] = np.minimum.reduceat(common, ends)[::2] + 1
            order, common = order[moved], new
            if column <= 0:
                hit = order[np.maximum(common[:-1], common[1:]) >= LENGTH]
                hit = hit[(least[hit] <= -column) & (-column <= most[hit])]
                down[hit] = np.where(down[hit] < 0, -column, down[hit])
                up[hit] = -column
    return down, up


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeats within the groups of one task."""
    group = np.unique(rows["key"].to_numpy(), return_inverse=True)[1]
    lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
    down, up = repeated(group, rows["bytes"].tolist(), lo, hi, np.maximum(lo, rows["from"].to_numpy()), np.minimum(hi, rows["to"].to_numpy()))
    hit = (down >= 0) & rows["single"].to_numpy()
    out = rows.loc[hit, ["doc", "hash", "pos"]].copy()
    out["start"], out["end"] = out["pos"] - up[hit], out["pos"] - down[hit] + LENGTH
    return out[["doc", "hash", "start", "end"]]


def _halved(contexts: pd.Series, lo: pd.Series, hi: pd.Series, low: pd.Series, high: pd.Series, key: pd.Series) -> pd.Series:
    """Both halves of a range of start distances: the group by what all strings
    of the half share, and the hash of all that they cover."""
    out = []
    np.seterr(over="ignore")  # sums of hashes wrap around
    for raw, a, b, x, y, k in zip(contexts, lo, hi, low, high, key):
        part, middle, found = Prefixes(np.frombuffer(raw, dtype=np.uint8)), (x + y) // 2, []
        for s, e in ((x, middle), (middle + 1, y)):
            if s <= e and s <= b and e >= a:
                core = part.hash(b - s, b - e + LENGTH)
                group = mixed(np.uint64(k % (1 << 64)) + core + np.uint64(s * 1024 + e))
                u, v = min(e, b), max(s, a)
                full = part.hash(b - u, b - v + LENGTH) + mixed(np.uint64(v * 1024 + u))
                found.append({"key": int(group.view(np.int64)), "full": int(np.uint64(full).view(np.int64)), "from": s, "to": e})
        out.append(found)
    return pd.Series(out)


def _split(rows: DataFrame):
    """Rows whose whole covered bytes repeat, and the others that have partners:
    the single ones, and one of each repeating set."""
    tag = F.xxhash64("doc", "hash", "pos")
    tagged = rows.withColumn("tag", tag)
    sets = stash(tagged.groupBy("key", "full").agg(F.count("*").alias("n"), F.min("tag").alias("first")), "sets")
    groups = stash(sets.groupBy("key").agg(F.count("*").alias("sets"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("singles")).filter("n > 1").drop("n"), "groups")
    # an open set: it repeats, or it has partners that may repeat parts of it
    known = stash(sets.join(groups, "key").filter("n > 1 or sets > 1"), "known")
    met = stash(tagged.join(known, ["key", "full"]), "met")
    whole = met.filter("n > 1")
    open_ = met.filter("sets > 1 and singles > 0 and (n = 1 or tag = first)").withColumn("single", F.col("n") == 1)
    drop_stash(sets)
    return whole, open_


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, hash, start, end): byte ranges, possibly overlapping, whose union is
    what repeats in each text of ``docs`` (doc, hash, text)."""
    long_enough = docs.filter(F.octet_length("text") >= LENGTH)
    kind = dict(docs.dtypes)["doc"]
    found = mapped(long_enough.select("doc", "hash", "text"), _anchor_rows, f"doc {kind}, hash long, pos int, key long, full long, lo int, hi int")
    whole, open_ = _split(stash(found, "anchors"))
    ranges = [whole.select("doc", "hash", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + LENGTH).alias("end"))]
    # the open anchors of one text: no more than it has
    per_doc = stash(open_.groupBy("doc", "hash").agg(F.collect_list(F.struct("pos", "key", "lo", "hi", "single")).alias("rows")), "open")
    on = docs["doc"].eqNullSafe(per_doc["doc"]) & (docs["hash"] == per_doc["hash"])
    there = docs.join(per_doc, on).select(docs["doc"], docs["hash"], "text", "rows")
    cut_out = mapped(there, _context_rows, f"doc {kind}, hash long, pos int, key long, lo int, hi int, single boolean, bytes binary", 64)
    live = stash(cut_out.withColumns({"from": F.lit(0), "to": F.lit(SPAN - 1)}), "contexts")
    halves = F.pandas_udf(_halved, "array<struct<key:long,full:long,from:int,to:int>>")
    small = []
    while True:
        sizes = stash(live.groupBy("key").agg(F.count("*").alias("size")), "sizes")
        sized = live.join(sizes, "key")
        small.append(sized.filter(F.col("size") <= CHUNK).drop("size"))
        hot = sized.filter(F.col("size") > CHUNK).drop("size")
        if not sizes.filter(F.col("size") > CHUNK).limit(1).count():
            break
        parts = hot.select("doc", "hash", "pos", "lo", "hi", "single", "bytes", F.explode(halves("bytes", "lo", "hi", "from", "to", "key")).alias("h"))
        whole, live = _split(stash(parts.select("doc", "hash", "pos", "lo", "hi", "single", "bytes", "h.*").withColumnRenamed("single", "was_single"), "halves"))
        most, least = F.least("to", "hi"), F.greatest("from", "lo")
        ranges.append(whole.filter("was_single").select("doc", "hash", (F.col("pos") - most).alias("start"), (F.col("pos") - least + LENGTH).alias("end")))
        live = live.withColumn("single", F.col("single") & F.col("was_single")).select("doc", "hash", "pos", "key", "lo", "hi", "single", "bytes", "from", "to")
    rows = functools.reduce(DataFrame.unionByName, small)
    rows = stash(rows, "small")
    tasks = max(1, rows.count() // TASK_ROWS)
    built = rows.withColumn("task", F.pmod("key", F.lit(tasks))).groupBy("task").applyInPandas(_built, f"doc {kind}, hash long, start int, end int")
    ranges.append(stash(built, "built"))
    return functools.reduce(DataFrame.union, ranges)


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, spans): the byte ranges of each text that repeat, maximal and in order."""
    plain = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    found = repeats(plain).groupBy("doc", "hash").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("found"))  # as many as the text has anchors
    found = stash(found, "ranges")
    on = plain["doc"].eqNullSafe(found["doc"]) & (plain["hash"] == found["hash"])
    joined = plain.join(found, on, "left").select(plain["doc"].alias(key), plain["text"].alias(text), "found")

    def of(rows: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b} for a, b in merged((r["start"], r["end"]) for r in x)] if x is not None else [] for x in rows])

    return joined.withColumn("spans", F.pandas_udf(of, "array<struct<start:int,end:int>>")("found")).drop("found")


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): each text without its repeats, as bytes."""

    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, rows in zip(texts, spans):
            raw, at, parts = t.encode("utf-8", "surrogatepass"), 0, []
            for r in rows:
                parts.append(raw[at : r["start"]])
                at = r["end"]
            out.append(b"".join([*parts, raw[at:]]))
        return pd.Series(out)

    found = with_spans(docs, key, text)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        key, F.octet_length(text).cast("long").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.when(F.size("spans") > 0, F.pandas_udf(kept, "binary")(text, "spans")).otherwise(F.col(text).cast("binary")).alias("kept"),
    )
