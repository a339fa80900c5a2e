"""Connected components by contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stash, stash


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b); the component is the
    smallest node that can be reached.

    Each round points every node at its smallest neighbour, follows the pointers
    once more and contracts the edges, until none is left. Pointers only go down
    and every node that is no local minimum goes, so the edges shrink by a
    factor from round to round. A hub's edges are aggregated before they are
    shuffled, and joins meet a table of one row per node."""
    live = stash(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    of = stash(live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")), "nodes")
    while live.limit(1).count():
        down = live.select(F.col("b").alias("v"), F.col("a").alias("m")).union(live.select(F.col("a").alias("v"), F.col("a").alias("m")))
        points = stash(down.groupBy("v").agg(F.min("m").alias("m")), "points")
        jump = points.select(F.col("v").alias("m"), F.col("m").alias("mm"))
        points2 = stash(points.join(jump, "m").select("v", F.col("mm").alias("m")), "points")
        left, right = points2.select(F.col("v").alias("a"), F.col("m").alias("x")), points2.select(F.col("v").alias("b"), F.col("m").alias("y"))
        shrunk = live.join(left, "a").join(right, "b").filter("x <> y")
        after = stash(shrunk.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        moved = of.join(points2.select(F.col("v").alias("component"), "m"), "component", "left")
        onward = stash(moved.select("node", F.coalesce("m", "component").alias("component")), "nodes")
        for old in (live, of, points, points2):
            drop_stash(old)
        live, of = after, onward
    return of
