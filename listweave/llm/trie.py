"""Prefix tree of conversations, with aggregates of every node.

A conversation is the path of its turns, 16 bytes of hash each, in one row (so
the longest one has to fit there). Equal conversations become one weighted path
first, and the paths are dealt out in sorted order, so a prefix shared by any
number of conversations only means that several tasks see it. Each task cuts
its range into shards of bounded size and packs each into a double-array trie:
the turns of the shard get dense ids, and from the node at slot s the turn i
leads to slot t = BASE[s] + i if CHECK[t] = s. Walking the paths over these two
arrays gives the aggregates. Only prefixes of a shard's first and last path can
stand in other shards, too; these upper nodes are merged by joins and groups,
and their subtrees are summed by doubling the distance to the ancestor.

Defined results: a null role or text is empty; turns are ordered by ``turn``
(null first; ties by role, then hash); rows without ``conv_id`` belong to no
conversation; an empty table has no node, not even a root; other columns are
not read, whatever their names."""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, streamed

#: Bytes of the hash of a turn.
WIDTH = 16
#: A shard is closed once its paths hold so many turns.
SHARD_TURNS = 50_000
#: Ids of equal conversations meet in blocks of 2 to this power.
BLOCK_BITS = 12


def paths_of(turns: DataFrame, family: Column | None = None) -> DataFrame:
    """(family, conv_id, path, sizes) of each conversation: the hashes of its
    turns one after the other and the bytes of their texts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    mark = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct("turn", role.alias("role"), mark.alias("mark"), F.octet_length(text).cast("long").alias("size"))
    rows = turns.filter("conv_id IS NOT NULL").select((F.col("conv_id") if family is None else family).alias("family"), "conv_id", turn.alias("of"))
    listed = rows.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("of")).alias("of"))
    path = F.unhex(F.array_join(F.transform("of", lambda t: t["mark"]), ""))
    return listed.select("family", "conv_id", path.alias("path"), F.transform("of", lambda t: t["size"]).alias("sizes"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """``paths_of`` with the first turns of each conversation c, crc32(c) modulo 9
    of them, replaced by those of conversation c - c % 5. Both lie in the same
    partition."""
    own = paths_of(turns, F.col("conv_id") - F.col("conv_id") % 5)
    family = Window.partitionBy("family")
    first = lambda c: F.max(F.when(F.col("conv_id") == F.col("family"), F.col(c))).over(family)
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    both = own.withColumns({"base": first("path"), "base_sizes": first("sizes")}).withColumn("h", h)
    path = F.concat(F.coalesce(F.substring("base", F.lit(1), F.col("h") * WIDTH), F.lit(b"")), F.expr(f"substring(path, h * {WIDTH} + 1)"))
    head, tail = F.slice("base_sizes", F.lit(1), F.col("h")), F.slice("sizes", F.col("h") + 1, F.greatest(F.size("sizes"), F.lit(1)))
    return both.select("conv_id", path.alias("path"), F.concat(F.coalesce(head, F.array().cast("array<bigint>")), tail).alias("sizes"))


class DoubleArray:
    """The trie of sorted distinct paths. ``order`` lists the slots of its nodes
    with their depths, parents before children."""

    TRIES = 32

    def __init__(self, paths: list[bytes]):
        ids: dict[bytes, int] = {}
        self.ids = [[ids.setdefault(p[k : k + WIDTH], len(ids)) for k in range(0, len(p), WIDTH)] for p in paths]
        self.base, self.check, self._free, self._roomy = [0], [0], [1], 1
        self.order, waiting = [(0, 0)], [(0, 0, len(paths), 0)]
        for slot, lo, hi, depth in waiting:
            if len(self.ids[lo]) == depth:
                lo += 1
            starts = [k for k in range(lo, hi) if k == lo or self.ids[k][depth] != self.ids[k - 1][depth]]
            if not starts:
                continue
            turns = [self.ids[k][depth] for k in starts]
            self.base[slot] = base = self._place(turns)
            for turn, at, end in zip(turns, starts, [*starts[1:], hi], strict=True):
                self.check[base + turn] = slot
                self._free[base + turn] = base + turn + 1
                self.order.append((base + turn, depth + 1))
                waiting.append((base + turn, at, end, depth + 1))

    def _next_free(self, slot: int) -> int:
        """The first free slot from here on; skips shorten themselves."""
        start = slot
        while slot < len(self._free) and self._free[slot] != slot:
            slot = self._free[slot]
        while start < len(self._free) and start < slot:
            self._free[start], start = slot, self._free[start]
        return slot

    def _place(self, turns: list[int]) -> int:
        """A base at which the slots of all these turns are free: near the front,
        else in the youngest stretch, else behind the end."""
        least, most = min(turns), max(turns)
        for floor in (0, self._roomy):
            slot = self._next_free(floor + least)
            for _ in range(self.TRIES):
                base = slot - least
                if base >= 0 and all(base + t >= len(self.check) or self._free[base + t] == base + t for t in turns):
                    return self._grown(base, most)
                slot = self._next_free(slot + 1)
        self._roomy = len(self.check)
        return self._grown(max(len(self.check) - least, 0), most)

    def _grown(self, base: int, most: int) -> int:
        more = range(len(self.check), base + most + 1)
        self.base.extend([0] * len(more))
        self.check.extend([-1] * len(more))
        self._free.extend(more)
        return base

    def walk(self, turns: list[int]):
        """Slots along the path, the root's first."""
        slot = 0
        yield slot
        for turn in turns:
            to = self.base[slot] + turn
            if self.check[to] != slot:
                raise KeyError(turn)
            yield (slot := to)


NODE = ("upper boolean, mark string, parent string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, size bigint, ends string")
_NONE = hashlib.sha256().hexdigest()


def _shard_nodes(paths: list[tuple[bytes, list[int], int, int, str]]):
    """The nodes of sorted paths (path, sizes, members, smallest, hash of the
    ids). Inner nodes are done; of an upper node the inner ones below it count,
    the rest is for the merge."""
    trie = DoubleArray([p[0] for p in paths])
    n = len(trie.check)
    members, least, size, ends = [0] * n, [None] * n, [0] * n, [None] * n
    for (_, sizes, count, smallest, hashed), turns in zip(paths, trie.ids, strict=True):
        for slot, bytes_ in zip(trie.walk(turns), [0, *sizes], strict=True):
            members[slot] += count
            size[slot] = bytes_
            if least[slot] is None or smallest < least[slot]:
                least[slot] = smallest
        ends[slot] = hashed
    marks: dict[int, str] = {}
    for path, turns in ((paths[0][0], trie.ids[0]), (paths[-1][0], trie.ids[-1])):
        mark = hashlib.md5()
        for k, slot in enumerate(trie.walk(turns)):
            if k:
                mark = hashlib.md5(mark.digest() + path[(k - 1) * WIDTH : k * WIDTH])
            marks[slot] = mark.hexdigest()
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for slot, _ in reversed(trie.order):
        if slot not in marks:
            parent = trie.check[slot]
            leaves[slot] += not children[slot]
            saved[slot] += (members[slot] - 1) * size[slot]
            children[parent] += 1
            leaves[parent] += leaves[slot]
            saved[parent] += saved[slot]
    for slot, depth in trie.order:
        parent, upper = trie.check[slot], slot in marks
        above = marks.get(parent) if depth else None
        known = least[parent] if depth and above is None else None
        yield upper, marks.get(slot), above, least[slot], depth, known, members[slot], children[slot], leaves[slot], saved[slot], size[slot], ends[slot] if upper else ends[slot] or _NONE


def _nodes(rows, most: int):
    """Nodes of the shards of a sorted stream of (path, sizes, members, smallest, ids)."""
    shard, turns = [], 0
    for path, those in groupby(rows, itemgetter(0)):
        members, smallest, hashed = 0, None, hashlib.sha256()
        for _, sizes, count, low, ids in those:
            hashed.update(f"{',' if members else ''}{ids}".encode())
            members += count
            smallest = low if smallest is None else min(smallest, low)
        shard.append((bytes(path), sizes, members, smallest, hashed.hexdigest()))
        turns += len(sizes) + 1
        if turns >= most:
            yield from _shard_nodes(shard)
            shard, turns = [], 0
    if shard:
        yield from _shard_nodes(shard)


def _merged(nodes: DataFrame) -> DataFrame:
    """One row per upper node, its subtree's sums complete."""
    parts = nodes.filter("upper").groupBy("mark").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    parts = stash(parts, "upper")
    below = parts.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("mark")).agg(F.count("*").alias("uppers"))
    whole = parts.join(below, "mark", "left").withColumn("n_children", F.col("n_children") + F.coalesce("uppers", F.lit(0)))
    own = {"n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"), "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")}
    state = stash(whole.withColumns(own).withColumn("to", F.col("parent")).drop("uppers"), "upper")
    # sums reach over 1, 2, 4 ... generations; `to` is the ancestor that far up
    while state.filter("to IS NOT NULL").limit(1).count():
        climbing = state.filter("to IS NOT NULL")
        add = climbing.groupBy(F.col("to").alias("mark")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        onward = climbing.select("mark", F.col("to").alias("at")).join(state.select(F.col("mark").alias("at"), F.col("to").alias("next")), "at").drop("at")
        sums = {"n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)), "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))}
        joined = state.join(add, "mark", "left").join(onward, "mark", "left")
        state = stash(joined.withColumns(sums).withColumn("to", F.col("next")).drop("next", "more_leaves", "more_saved"), "upper")
    return state


def trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the prefix tree of ``paths`` (conv_id, path, sizes): its
    smallest member, depth, the parent's smallest member (root: null), members,
    children, leaves below, saved tokens below, and the hash of the ids of the
    members that end there."""
    block = F.shiftright("conv_id", BLOCK_BITS)
    alike = paths.groupBy("path", block.alias("block")).agg(F.first("sizes").alias("sizes"), F.count("*").alias("members"), F.min("conv_id").alias("least"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = alike.repartitionByRange(parts, "path").sortWithinPartitions("path", "block")
    nodes = stash(streamed(ordered.select("path", "sizes", "members", "least", F.array_join("ids", ",").alias("ids")), partial(_nodes, most=shard_turns), NODE), "nodes")
    upper = _merged(nodes)
    names = upper.select(F.col("mark").alias("parent"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    done = nodes.filter("NOT upper AND parent IS NULL").select(*columns)
    below = nodes.filter("NOT upper AND parent IS NOT NULL").drop("parent_conv_id").join(names, "parent", "left").withColumnRenamed("above", "parent_conv_id").select(*columns)
    top = upper.join(names, "parent", "left").withColumnRenamed("above", "parent_conv_id").withColumn("ends", F.coalesce("ends", F.lit(_NONE))).select(*columns)
    return done.unionByName(below).unionByName(top)


_CRC = "xor(list_reduce([4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')], lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
#: DuckDB: every prefix of every rebuilt conversation, grouped.
ORACLE = f"""
WITH own AS (SELECT conv_id AS c, list(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') ORDER BY turn NULLS FIRST, role, text) AS l,
    list(strlen(coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT *, {_CRC} % 9 AS h FROM own),
rebuilt AS (SELECT o.c, list_transform(coalesce(b.l[1:o.h], []) || o.l[o.h + 1:], lambda x: md5(x)) AS l, coalesce(b.s[1:o.h], []) || o.s[o.h + 1:] AS s FROM cut o LEFT JOIN own b ON b.c = o.c - o.c % 5),
marked AS (SELECT *, list_transform(range(0, len(l) + 1), lambda d: md5(array_to_string(l[1:d], ''))) AS m FROM rebuilt),
pre AS (SELECT c, d, m[d + 1] AS p, CASE WHEN d > 0 THEN m[d] END AS pp, m[1:d + 1] AS above, CASE WHEN d > 0 THEN s[d] ELSE 0 END AS size, d = len(l) AS ends FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM marked)),
node AS (SELECT p, any_value(d) AS depth, any_value(pp) AS pp, any_value(above) AS above, any_value(size) AS size, min(c) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM pre GROUP BY p),
kids AS (SELECT pp AS p, count(*) AS k FROM node WHERE pp IS NOT NULL GROUP BY pp),
full_node AS (SELECT n.*, coalesce(k, 0) AS k FROM node n LEFT JOIN kids USING (p)),
sums AS (SELECT a AS p, count(*) FILTER (k = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved FROM (SELECT unnest(above) AS a, k, n_convs, size FROM full_node) GROUP BY a)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.k AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node n JOIN sums s USING (p) LEFT JOIN node q ON q.p = n.pp"""
