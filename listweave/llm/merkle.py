"""Document fingerprints: Merkle trees over paragraphs and sections (op 8).

A text is cut at blank lines into sections and these at line ends into
paragraphs; nothing is dropped, so the cut can be undone. A paragraph's node is
the SHA-256 of its text, a section's the SHA-256 of its paragraphs' nodes, the
root's (the fingerprint) that of the sections' nodes. Equal roots mean equal
texts; where roots differ, ``differing`` walks down the branches that differ.
``likeness`` compares two trees below that: the share of characters in phrases
that both have, each distinct phrase once.

All on DataFrame functions. Defined results: null is the empty text, a tree of
one empty paragraph; its likeness is 1 to another empty text and 0 to others.
Equal texts have equal fingerprints, whatever their rows. Other columns pass
through; an empty table gives an empty result. ``with_next`` orders rows of the
same key by the text's hash, null keys first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Paragraphs below this many characters, or without punctuation, are cut into
#: words, others at punctuation.
SHORT = 120
PHRASE_END = r"(?<=[.,;:!?|])\s+"
#: Rows of a block of neighbours, and the most blocks (so the bounds and heads
#: that the driver and a broadcast see have a fixed size).
BLOCK_ROWS, MOST_BLOCKS = 512, 1 << 14
LANE = 128


def nodes(text: Column) -> Column:
    """Sections as arrays of paragraph hashes."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n"),
        lambda section: F.transform(F.split(section, "\n"), lambda paragraph: F.sha2(paragraph, 256)),
    )


def section_hashes(tree: Column) -> Column:
    return F.transform(tree, lambda paragraphs: F.sha2(F.concat(F.lit("section:"), F.array_join(paragraphs, ",")), 256))


def root(sections: Column) -> Column:
    """The fingerprint of a text from its sections' hashes."""
    return F.sha2(F.concat(F.lit("text:"), F.array_join(sections, ",")), 256)


def phrases(text: Column) -> Column:
    """Distinct phrases of a text, each a long: 52 bits of hash, then the length (at most 4095)."""
    of = lambda paragraph: F.filter(
        F.split(paragraph, F.when((F.length(paragraph) < SHORT) | ~paragraph.rlike(PHRASE_END), F.lit(r"\s+")).otherwise(F.lit(PHRASE_END))), lambda x: x != ""
    )
    coded = lambda x: F.shiftleft(F.xxhash64(x), 12).bitwiseOR(F.least(F.length(x), F.lit(4095)).cast("long"))
    return F.array_distinct(F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: F.transform(of(p), coded))))


def _weight(coded: Column) -> Column:
    return F.aggregate(coded, F.lit(0).cast("long"), lambda total, x: total + x.bitwiseAND(F.lit(4095).cast("long")))


def likeness(root_a: Column, phrases_a: Column, root_b: Column, phrases_b: Column) -> Column:
    """0 to 1: Dice share of the characters in common phrases; 1 for equal roots."""
    total = _weight(phrases_a) + _weight(phrases_b)
    shared = _weight(F.array_intersect(phrases_a, phrases_b)) * F.lit(2.0)
    return F.when(root_a == root_b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(shared / total)


def differing(sections_a: Column, tree_a: Column, sections_b: Column, tree_b: Column) -> Column:
    """(section, paragraph) places of ``a``, from 0, whose hash ``b`` lacks in
    the section of the same place; sections with equal hashes are not entered."""
    indexed = F.transform(tree_a, lambda paragraphs, s: F.struct(s.alias("s"), paragraphs.alias("p"), F.element_at(sections_a, s + 1).alias("h")))
    other = lambda s: F.coalesce(F.get(tree_b, s), F.array().cast("array<string>"))
    entered = F.filter(indexed, lambda x: ~x["h"].eqNullSafe(F.get(sections_b, x["s"])))
    return F.flatten(
        F.transform(
            entered,
            lambda x: F.filter(
                F.transform(x["p"], lambda h, k: F.when(~F.array_contains(other(x["s"]), h), F.struct(x["s"].alias("section"), k.alias("paragraph")))),
                lambda place: place.isNotNull(),
            ),
        )
    )


def fingerprinted(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the tree, the sections' hashes and the fingerprint of each text."""
    return (
        docs.withColumn(f"{prefix}tree", nodes(F.col(text)))
        .withColumn(f"{prefix}sections", section_hashes(F.col(f"{prefix}tree")))
        .withColumn(f"{prefix}fingerprint", root(F.col(f"{prefix}sections")))
    )


def _block(key: Column, bounds: list) -> Column:
    """How many bounds are at or below the key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    lanes = F.array(*[F.lit(x) for x in bounds[::LANE]])
    lane = F.size(F.filter(lanes, lambda x: x <= key))
    within = F.size(F.filter(F.slice(F.array(*[F.lit(x) for x in bounds]), (lane - 1) * LANE + 1, LANE), lambda x: x <= key))
    return F.when(key.isNull() | (lane == 0), F.lit(0)).otherwise((lane - 1) * LANE + within)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "next_text") -> DataFrame:
    """``docs`` with the text of the row that follows in the order of ``key``;
    the first row follows the last.

    Rows are dealt into blocks of near-equal size by quantiles of the key, each
    block's first row is also dealt to the block before it, and a window within
    each block finds the neighbour: one shuffle of the texts."""
    n = docs.count()
    blocks = max(1, min(MOST_BLOCKS, n // BLOCK_ROWS))
    shares = [k / blocks for k in range(1, blocks)]
    bounds = []
    if shares:
        bounds = docs.agg(F.percentile_approx(key, shares, max(10_000, 20 * blocks)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    placed = docs.withColumn("_block", _block(F.col(key), bounds))
    # at most MOST_BLOCKS rows; the block of the last row is followed by the first
    heads = placed.groupBy("_block").agg(F.min(F.struct(F.col(key).isNotNull(), F.col(key))).alias("_head"))
    order = Window.partitionBy(F.lit(0)).orderBy("_block")
    firsts = heads.withColumn("_before", F.coalesce(F.lag("_block").over(order), F.max("_block").over(Window.partitionBy(F.lit(0)))))
    wraps = F.row_number().over(order) == 1
    firsts = firsts.withColumn("_wraps", wraps)
    joined = placed.join(F.broadcast(firsts), "_block")
    is_head = F.struct(F.col(key).isNotNull(), F.col(key)) == F.col("_head")
    own = F.struct(F.col("_block").alias("block"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("_before").alias("block"), F.when(F.col("_wraps"), 2).otherwise(1).alias("guest"))
    dealt = joined.withColumn("_at", F.explode(F.when(is_head, F.array(own, guest)).otherwise(F.array(own))))
    in_block = Window.partitionBy("_at.block").orderBy(F.col("_at.guest"), F.col(key), F.xxhash64(F.col(text)))
    out = dealt.withColumn("_next", F.lead(F.struct(F.col(text).alias("text"))).over(in_block))
    return out.filter(F.col("_at.guest") == 0).withColumn(name, F.col("_next.text")).drop("_at", "_next", "_block", "_before", "_wraps", "_head")


def edited(text: Column, n_chars: Column, following: Column) -> Column:
    """The text whose second half gives way to the first half of the next one."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.left(text, (n_chars - half).cast("int")), F.left(following, half))
