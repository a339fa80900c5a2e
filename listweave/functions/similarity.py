"""Token-set similarity: the ratio as a Column and an exact self-join on it.

The ratio works on sets of words. With I the shared words and x, y the joined
sorted leftovers of the two sides it is 100 when one side is contained in the
other, otherwise the best of the normalized insert/delete distance of x and y
(relative to the full lengths) and the two ratios of I against each side.

`similar` joins two sets of texts on it by equality of keys."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listweave.functions.text import _col, bound
from listweave.tables import stash


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-wide bit row per
    character of b."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _lcs_batch(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(
        [
            None if a is None or b is None else _common_subsequence(a, b)
            for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)
        ],
        pa.int32(),
    )


def _lcs(left: Column, right: Column) -> Column:
    """Marked as not deterministic, so that a filter on the ratio is not pushed
    below a `distinct` and the subsequence is computed once per pair."""
    return F.arrow_udf(_lcs_batch, T.IntegerType()).asNondeterministic()(left, right)


def token_set(value: Column | str) -> Column:
    """Sorted distinct words."""
    words = F.split(_col(value), r"(?U)\s+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def canonical(value: Column | str) -> Column:
    """The one string two texts share exactly when their word sets are equal."""
    return F.array_join(token_set(value), " ")


def _parts(a: Column, b: Column) -> tuple[Column, Column, Column, Column]:
    shared = F.array_join(F.array_intersect(a, b), " ")
    x = F.array_join(F.array_except(a, b), " ")
    y = F.array_join(F.array_except(b, a), " ")
    return F.length(shared), x, y, F.when(F.length(shared) > 0, F.lit(1)).otherwise(F.lit(0))


def token_set_ratio(left: Column | str, right: Column | str) -> Column:
    """Ratio 0..100 of two texts, null when either is null. Meant for columns of
    already distinct pairs; the leftovers are the only data sent to Python, and
    only when both sides have some."""
    a, b = token_set(left), token_set(right)
    s, x, y, gap = _parts(a, b)
    contained = (s > 0) & ((x == "") | (y == ""))
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    open_pair = ~contained & ~empty
    lcs = _lcs(F.when(open_pair, x), F.when(open_pair, y))
    ab = s + gap + F.length(x)
    ba = s + gap + F.length(y)
    distance = F.length(x) + F.length(y) - 2 * lcs
    direct = F.lit(100.0) - F.lit(100.0) * distance / F.greatest(ab + ba, F.lit(1))
    side_a = F.lit(100.0) - F.lit(100.0) * (F.length(x) + 1) / F.greatest(s + ab, F.lit(1))
    side_b = F.lit(100.0) - F.lit(100.0) * (F.length(y) + 1) / F.greatest(s + ba, F.lit(1))
    return (
        F.when(_col(left).isNull() | _col(right).isNull(), F.lit(None))
        .when(empty, F.lit(0.0))
        .when(contained, F.lit(100.0))
        .when(s == 0, direct)
        .otherwise(F.greatest(direct, side_a, side_b))
    )


def rated(pairs: DataFrame, threshold: float) -> DataFrame:
    """(ka, kb, ratio) of the pairs of canonical texts (ka, kb) that come to the
    threshold. The parts are columns of their own, computed once; insert/delete
    distance is never below the edit distance, so built-ins cut most pairs before
    the rest go through the exact distance."""
    words = pairs.select("ka", "kb", F.split("ka", " ").alias("a"), F.split("kb", " ").alias("b"))
    join = lambda c: F.array_join(c, " ")
    part = F.struct(F.length(join(F.array_intersect("a", "b"))).alias("s"), join(F.array_except("a", "b")).alias("x"), join(F.array_except("b", "a")).alias("y"))
    parts = words.select("ka", "kb", part.alias("part"))
    near = parts.filter(bound(F.col("part"), lambda p: _best(p, F.levenshtein(p["x"], p["y"]))) >= threshold - 1e-9)
    left = F.length("part.x") + F.length("part.y") - 2 * _lcs(F.col("part.x"), F.col("part.y"))
    exact = near.withColumn("left", left).withColumn("ratio", _best(F.col("part"), F.col("left")))
    return exact.filter(F.col("ratio") >= threshold).select("ka", "kb", "ratio")


def _best(part: Column, distance: Column) -> Column:
    """The ratio for the shared words' length and what is left of either side (s, x, y)."""
    s, x, y = part["s"], F.length(part["x"]), F.length(part["y"])
    gap = (s > 0).cast("int")
    ab, ba = s + gap + x, s + gap + y
    direct = F.lit(100.0) - F.lit(100.0) * distance / (ab + ba)
    side = lambda over, total: F.lit(100.0) - F.lit(100.0) * (over + 1) / (s + total)
    return F.when((s > 0) & ((x == 0) | (y == 0)), F.lit(100.0)).when(s == 0, direct).otherwise(F.greatest(direct, side(x, ab), side(y, ba)))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Distinct rows over all partitions: what follows computes much per row, so
    their number counts and not their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).distinct()


def _once(pairs: DataFrame) -> DataFrame:
    """Distinct pairs as a table: else the bound by built-ins would move below the
    ``distinct`` and into the join before it, and be worked out at every meeting."""
    return stash(pairs.distinct(), "met")


def ratio(left: str, right: str) -> float:
    """``token_set_ratio`` of two plain texts."""
    a, b = set(left.split()), set(right.split())
    if not a or not b:
        return 0.0
    s = len(" ".join(sorted(a & b)))
    x, y = " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if s and not (x and y):
        return 100.0
    ab, ba = s + (s > 0) + len(x), s + (s > 0) + len(y)
    direct = 100.0 - 100.0 * (len(x) + len(y) - 2 * _common_subsequence(x, y)) / (ab + ba)
    if not s:
        return direct
    return max(direct, 100.0 - 100.0 * (len(x) + 1) / (s + ab), 100.0 - 100.0 * (len(y) + 1) / (s + ba))


def _match_keys(threshold: float, left: bool) -> Column:
    """Keys of the canonical text in column ``key`` on which any two texts that
    reach the threshold meet, one's left keys with the other's right ones.

    Either they share a word. Or they share none, and then the threshold bounds
    the inserts and deletes between the two whole texts by c (|a| + |b|), c being
    1 - threshold / 100: cut into one piece more than twice c its length allows,
    the longer text keeps a piece whole, which stands somewhere in the shorter
    one. So the longer one leaves its pieces, and the shorter one its substrings
    of every length that pieces of a longer one can have."""
    c = 1.0 - threshold / 100.0
    cuts = "int(floor({} * " + repr(2 * c) + " + 1e-9))"
    n, k = "length(key)", cuts.format("length(key)")
    pieces = f"transform(sequence(0, {k}), i -> substring(key, i * {n} div ({k} + 1) + 1, (i + 1) * {n} div ({k} + 1) - i * {n} div ({k} + 1)))"
    width = f"m div ({cuts.format('m')} + 1)"
    widths = f"array_distinct(flatten(transform(sequence({n}, int(floor({n} * {(1 + c) / (1 - c)!r} + 1e-6))), m -> array({width}, {width} + 1))))"
    parts = f"flatten(transform(filter({widths}, w -> w between 1 and {n}), w -> transform(sequence(1, {n} - w + 1), p -> substring(key, p, w))))"
    one, two = ("p", "s") if left else ("s", "p")
    return F.expr(f"array_distinct(concat(transform(split(key, ' '), t -> concat('t', t)), transform({parts}, x -> concat('{one}', x)), transform({pieces}, x -> concat('{two}', x))))")


#: A key that more texts of the left side hold is dealt out in parts of so many.
HEAVY = 512


def _sketched(rows: DataFrame, threshold: float, name: str) -> DataFrame:
    """``rows`` (key, ...) with what bounds a pair's ratio by bits: ``n``, the
    length; ``w``, a bit per word; ``c``, per character whether their number is
    odd; ``r``, the most words the text can leave over where its shared part alone
    lets the pair reach the threshold."""
    c = 1.0 - threshold / 100.0
    most = f"({c!r} * (2 * length(key) - 1) - 1) / {1 + c!r} + 1e-6"
    lengths = "array_sort(transform(split(key, ' '), t -> length(t)))"
    left = f"size(filter(sequence(1, size({lengths})), m -> aggregate(slice({lengths}, 1, m), m - 1, (t, n) -> t + n) <= {most}))"
    columns = {
        "n": "length(key)",
        "w": "aggregate(split(key, ' '), 0L, (m, t) -> m | shiftleft(1L, cast(pmod(xxhash64(t), 64L) as int)))",
        "c": "aggregate(sequence(1, length(key)), 0L, (m, p) -> m ^ shiftleft(1L, ascii(substring(key, p, 1)) % 64))",
        "r": left,
    }
    return rows.select("*", *[F.expr(x).alias(f"{n}_{name}") for n, x in columns.items()])


def _may_reach(threshold: float) -> Column:
    """Whether a pair of ``_sketched`` texts may reach the threshold: all but a few
    short words of one side are in the other, or the inserts and deletes that the
    lengths and odd characters call for are within what it allows. Texts that
    share a word meet on that, so a piece only counts where they share none."""
    edits = f"{1.0 - threshold / 100.0!r} * (n_a + n_b) + 1e-6"
    direct = f"(abs(n_a - n_b) <= {edits} AND bit_count(c_a ^ c_b) <= {edits})"
    apart = "((w_a & w_b) = 0 OR NOT arrays_overlap(split(ka, ' '), split(kb, ' ')))"
    words = "bit_count(w_a & ~w_b) <= r_a OR bit_count(w_b & ~w_a) <= r_b"
    return F.expr(f"CASE WHEN meet_ LIKE 't%' THEN {words} OR {direct} ELSE {direct} AND {apart} END")


def _candidates(a: DataFrame, b: DataFrame, threshold: float, on: list[str]) -> DataFrame:
    """(ka, kb) of the rows of ``a`` and ``b`` (*on, key) that share a key of
    ``_match_keys`` and pass the bounds. A key that many texts hold is one of
    several parts of the left side, each of which meets the whole right side."""
    keys = [*on, "meet_"]

    def met(rows: DataFrame, left: bool, name: str) -> DataFrame:
        sketched = _sketched(rows.select(*on, "key"), threshold, name)
        return sketched.select(*on, F.col("key").alias(f"k{name}"), *[f"{c}_{name}" for c in "nwcr"], F.explode(_match_keys(threshold, left)).alias("meet_"))

    left, right = met(a, True, "a"), met(b, False, "b")
    heavy = left.groupBy(*keys).count().filter(F.col("count") > HEAVY).select(*keys, F.ceil(F.col("count") / HEAVY).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    left = left.join(heavy, keys, "left").withColumn("part", F.pmod(F.xxhash64("ka"), parts).cast("int")).drop("parts")
    right = right.join(heavy, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    left = left.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "part")  # by meetings, not bytes
    return left.join(right, [*keys, "part"]).filter(_may_reach(threshold)).select("ka", "kb")


def _grouped(a: DataFrame, b: DataFrame, on: list[str]) -> list[str]:
    """``on``, or nothing if texts recur in so many groups that fewer pairs of
    texts are looked at when each is compared once for all groups."""
    if not on:
        return []
    count = lambda df, *c: df.select(*c).distinct().count()
    within = count(a, *on, "key") * count(b, *on, "key") / max(1, count(b, *on))
    return on if within <= count(a, "key") * count(b, "key") else []


def _keyed(side: DataFrame, name: str, on: list[str]) -> DataFrame:
    """(*on, name, key): the distinct texts of a side with their word sets."""
    rows = side.filter(F.col("text").isNotNull()).select(*on, F.col("text").alias(name)).distinct()
    return stash(rows.withColumn("key", canonical(name)).filter("key <> ''"), "keyed")


def similar(left: DataFrame, right: DataFrame, threshold: float, on: list[str] | None = None) -> DataFrame:
    """(*on, a, b, ratio): every pair of a text of ``left`` (*on, text) and one of
    ``right`` with equal ``on`` whose ratio reaches the threshold. Pairs of distinct
    texts meet by equality of a key; bounds by bits and then by built-ins cut what
    can't reach it before the exact ratio is computed, once per pair of word sets.
    Texts without a word match nothing."""
    on = on or []
    a, b = _keyed(left, "a", on), _keyed(right, "b", on)
    group = _grouped(a, b, on)
    some = lambda rows: _dealt(rows.select(*group, "key"), *group, "key")
    near = rated(_once(_candidates(some(a), some(b), threshold, group)), threshold)
    return a.withColumnRenamed("key", "ka").join(near, "ka").join(b.withColumnRenamed("key", "kb"), [*on, "kb"]).select(*on, "a", "b", "ratio")


#: Word sets up to this size are also looked up by their parts.
PART_WORDS = 12


def _fewer_words() -> Column:
    """The word set in column ``key`` without one or two of its words."""
    without = "array_join(filter(split(key, ' '), (x, k) -> {}), ' ')".format
    n = "size(split(key, ' '))"
    one = f"transform(sequence(0, {n} - 1), i -> {without('k <> i')})"
    two = f"flatten(transform(sequence(0, {n} - 2), i -> transform(sequence(i + 1, {n} - 1), j -> {without('k <> i AND k <> j')})))"
    return F.expr(f"CASE WHEN {n} > 2 THEN concat({one}, {two}) WHEN {n} = 2 THEN {one} ELSE array() END")


def with_similar(left: DataFrame, right: DataFrame, threshold: float, on: list[str] | None = None) -> DataFrame:
    """(*on, a): the texts of ``left`` (*on, text) to which ``similar`` finds one of
    ``right`` at least. One is enough, so a text is settled by an equal word set, or
    by one of its parts, which is contained in it: both are look-ups by equality.
    Only texts that these leave open are compared with others."""
    on = on or []
    keys = [*on, "key"]
    a = _keyed(left, "a", on)
    known = stash(_keyed(right, "b", on).select(*keys).distinct(), "known")
    fresh = stash(a.select(*keys).distinct().join(known, keys, "left_anti"), "fresh")
    parts = fresh.filter(F.size(F.split("key", " ")) <= PART_WORDS).select(*keys, F.explode(_fewer_words()).alias("part"))
    holding = parts.join(known.withColumnRenamed("key", "part"), [*on, "part"], "left_semi").select(*keys).distinct()
    rest = stash(fresh.join(holding, keys, "left_anti"), "rest")
    text = lambda rows: rows.select(*on, F.col("key").alias("text"))
    near = similar(text(rest), text(known), threshold, on).select(*on, F.col("a").alias("key"))
    return a.join(rest.join(near, keys, "left_anti"), keys, "left_anti").select(*on, "a")


def rated_texts(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ratio) of the distinct text pairs (a, b) that reach the threshold."""
    keyed = pairs.select("a", "b", canonical("a").alias("ka"), canonical("b").alias("kb")).filter("ka <> '' AND kb <> ''")
    return keyed.join(rated(_once(keyed.select("ka", "kb")), threshold), ["ka", "kb"]).select("a", "b", "ratio")
