"""Embedding near-duplicates by a subspace pigeonhole join (op 9).

Equal vectors are one class. Unit vectors are rotated (random signs, then a
Hadamard transform) and split into blocks of eight coordinates. A cosine of at
least ``COSINE`` means a squared distance of at most 2 - 2 * COSINE, so at least
one block has no more than its proportional share of it. Each block is range-
joined under its share: a grid over its first coordinates with cells as wide as
the block's radius, each vector in its own cell and in half of the neighbouring
ones, so a pair meets once in a block. Block distances come first, then the
cosine of the whole vectors in double precision. A pair that several blocks find
counts in the first of them, which both vectors can tell, so that no pairs have
to be shuffled: a task returns one row per vector and cell, with its links
counted and a root of the links found there. Crowded cells are split into
squares of bounded chunks.

Defined results: null or zero vectors, and those with null, NaN or infinite
components, link with nothing; vectors of different lengths never link. Rows
that share a vec_id are one node and their links add up. An empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import stash
from .components import components

COSINE = 0.95
#: Coordinates of a block.
BLOCK = 8
#: Rows of a chunk of a crowded cell, pairs whose blocks are compared at a time,
#: and pairs whose whole vectors are.
CHUNK, PAIRS, EXACT = 8192, 1 << 18, 1 << 15
#: What a row in a cell costs, and a pair that meets there (microseconds), and the
#: share of pairs that stays in neighbouring cells with one more grid coordinate.
ROW_COST, PAIR_COST, STAYING = 3.0, 0.001, 0.67
#: Block distances are compared in single precision, with room for its rounding.
SLACK = 1e-5


def grid_of(vectors: int) -> int:
    """Grid coordinates that cost least for so many vectors: more of them part the
    pairs, but put each vector into more cells. Results do not depend on it."""
    cost = lambda g: ROW_COST * (3**g + 1) / 2 + PAIR_COST * vectors / 2 * STAYING**g
    return min(range(1, BLOCK + 1), key=cost)


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; element by element, so equal in any batch."""
    n, dim = vectors.shape
    width = 1 << max(0, math.ceil(math.log2(dim)))
    x = np.zeros((n, width))
    x[:, :dim] = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    x *= np.random.default_rng(width).choice([-1.0, 1.0], width)
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


def block_slices(width: int) -> list[slice]:
    return [slice(a, min(a + BLOCK, width)) for a in range(0, width, BLOCK)]


def budgets(width: int) -> list[float]:
    """Squared distance that each block may have, with room for rounding."""
    return [(2 - 2 * COSINE) * (s.stop - s.start) / width * (1 + 1e-9) + 1e-12 for s in block_slices(width)]


def forward(grid: int) -> np.ndarray:
    """The zero offset, and one of each pair of opposite neighbour offsets."""
    steps = np.stack(np.meshgrid(*[[-1, 0, 1]] * grid, indexing="ij"), axis=-1).reshape(-1, grid)
    return steps[len(steps) // 2 :]


def _flat(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


_PLACES = T.ArrayType(T.StructType([T.StructField("block", T.IntegerType()), T.StructField("cell", T.LongType()), T.StructField("home", T.BooleanType())]))


def places(grid: int):
    """Cells of each vector in every block: (block, cell, at home)."""

    def of(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        found, order = [], []
        for dim in np.unique(sizes):
            picked = np.flatnonzero(sizes == dim)
            x = rotated(_flat(vectors.take(pa.array(picked))).astype(np.float64))
            blocks, cells, homes = [], [], []
            for b, (s, budget) in enumerate(zip(block_slices(x.shape[1]), budgets(x.shape[1]))):
                g, base = min(grid, s.stop - s.start), 2 * math.ceil(1 / math.sqrt(budget)) + 4
                while base**g >= 1 << 62:  # a cell's number has to fit
                    g -= 1
                cell = np.floor(x[:, s.start : s.start + g] / math.sqrt(budget)).astype(np.int64)
                for step in forward(g):
                    key = np.zeros(len(x), dtype=np.int64)
                    for k in range(g):
                        key = key * base + (cell[:, k] + step[k] + base // 2)
                    cells.append(key)
                    blocks.append(b)
                    homes.append(not step.any())
            n, k = len(x), len(cells)
            items = pa.StructArray.from_arrays(
                [pa.array(np.tile(np.array(blocks, dtype=np.int32), n)), pa.array(np.stack(cells, axis=1).ravel()), pa.array(np.tile(np.array(homes), n))], names=["block", "cell", "home"]
            )
            found.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), items))
            order.append(picked)
        if not found:
            return pa.array([], to_arrow_type(_PLACES))
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(order))))

    return F.arrow_udf(of, _PLACES)


@functools.lru_cache(maxsize=4)
def _rotation(dim: int) -> np.ndarray:
    return rotated(np.eye(dim))


def _linked(a: np.ndarray, b: np.ndarray, block: int):
    """(i, j) of the pairs that link here: within the block's budget, in no
    earlier block's, and with a sufficient cosine."""
    a, b, turn = a.astype(np.float64), b.astype(np.float64), _rotation(a.shape[1])
    slices, most = block_slices(turn.shape[1]), budgets(turn.shape[1])
    norm_a, norm_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    x, y = ((v / n[:, None] @ turn[:, slices[block]]) for v, n in ((a, norm_a), (b, norm_b)))
    # one product gives the squared distances: (x, x.x, 1) times (-2 y, 1, y.y)
    left = np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))]).astype(np.float32)
    right = np.column_stack([-2 * y, np.ones(len(y)), (y * y).sum(axis=1)]).astype(np.float32).T
    bound = np.float32(most[block] + SLACK)
    step = max(1, PAIRS // len(b))
    for at in range(0, len(a), step):
        close = np.flatnonzero(left[at : at + step] @ right <= bound)
        for k in range(0, len(close), EXACT):
            i, j = np.divmod(close[k : k + EXACT], len(b))
            i += at
            good = np.einsum("ij,ij->i", a[i], b[j]) / (norm_a[i] * norm_b[j]) >= COSINE
            i, j = i[good], j[good]
            if not len(i):
                continue
            difference = (rotated(a[i]) - rotated(b[j])) ** 2
            near = np.stack([difference[:, t].sum(axis=1) <= m for t, m in zip(slices[: block + 1], most)], axis=1)
            first = near[:, block] & ~near[:, :block].any(axis=1)
            yield i[first], j[first]


def _cell(key: tuple, rows: pa.Table) -> pa.Table:
    """Links counted and joined within one chunk of a cell."""
    block = key[1].as_py()
    is_left, is_right, home, copies, reps = (rows.column(c).to_numpy() for c in ("is_left", "is_right", "home", "copies", "rep"))
    is_left, is_right = np.flatnonzero(is_left), np.flatnonzero(is_right)
    names, inverse = np.unique(reps, return_inverse=True)
    na, nb = inverse[is_left], inverse[is_right]
    counts, parent = np.zeros(len(names), dtype=np.int64), np.arange(len(names))

    def find(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    if len(na) and len(nb):
        vectors, ca, cb, home = _flat(rows.column("vector").combine_chunks()), copies[is_left], copies[is_right], home[is_left]
        for i, j in _linked(vectors[is_left], vectors[is_right], block):
            good = ~home[i] | (na[i] < nb[j])  # both at home: each pair once
            i, j = i[good], j[good]
            np.add.at(counts, na[i], cb[j])
            np.add.at(counts, nb[j], ca[i])
            for x, y in np.unique(np.stack([parent[na[i]], parent[nb[j]]], axis=1), axis=0) if len(i) else ():
                x, y = find(x), find(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    met = np.flatnonzero(counts)
    roots = names[[find(k) for k in met]] if len(met) else names[:0]
    kind = rows.schema.field("rep").type
    return pa.table({"rep": pa.array(names[met], kind), "links": pa.array(counts[met]), "root": pa.array(roots, kind)})


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id) of every row."""
    vec = F.col(vector)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0) & F.col(key).isNotNull(), F.lit(False))
    rows = table.select(key, F.when(sound, vec).alias("vector"))
    classes = stash(rows.filter("vector is not null").groupBy("vector").agg(F.min(key).alias("rep"), F.count("*").alias("copies")), "vectors")
    grid = grid_of(classes.count())
    dealt = classes.select("rep", "copies", "vector", F.size("vector").alias("dim"), F.explode(places(grid)("vector")).alias("p")).select("rep", "copies", "vector", "dim", "p.*")
    cell = ["dim", "block", "cell"]
    sizes = dealt.groupBy(*cell).agg(F.count("*").alias("n"), F.max("home").alias("lived_in"), F.count("*").alias("rows"))
    # cells where nobody is at home, or only one row is, hold no pair
    sizes = stash(sizes.filter("lived_in and n > 1").select(*cell, F.ceil(F.col("n") / (2 * CHUNK)).cast("int").alias("chunks")), "cells")
    placed = dealt.join(sizes, cell)
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    as_left = F.transform(every, lambda c: F.struct(own.alias("lc"), c.alias("rc"), F.lit(True).alias("is_left"), (F.col("home") & (own == c)).alias("is_right")))
    as_right = F.filter(
        F.transform(every, lambda c: F.struct(c.alias("lc"), own.alias("rc"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right"))),
        lambda x: F.col("home") & (x["lc"] != own),
    )
    chunked = placed.select("rep", "copies", "vector", *cell, "home", F.explode(F.concat(as_left, as_right)).alias("c")).select("rep", "copies", "vector", *cell, "home", "c.*")
    kind = dict(table.dtypes)[key]
    found = stash(chunked.groupBy(*cell, "lc", "rc").applyInArrow(_cell, f"rep {kind}, links long, root {kind}"), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = classes.join(links, "rep", "left").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
    known = stash(known.select("vector", F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.coalesce("component", "rep")).toDF("vector", "n_links", "component_id"), "known")
    return rows.join(known, "vector", "left").select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", key).alias("component_id"))
