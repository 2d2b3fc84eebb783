"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.storage import keep


def _fewer(stars: DataFrame, larger: bool) -> DataFrame:
    """One large-star or small-star step on edges (a, b) with a < b: neighbours hang on the least node around."""
    if larger:
        around = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        linked = around.filter(F.col("b") > F.col("a")).join(least, "a")
        moved = linked.select(F.col("m").alias("a"), "b")
    else:
        lower = stars.select(F.col("b").alias("node"), F.col("a").alias("below"))
        least = lower.groupBy("node").agg(F.min("below").alias("m"))
        linked = lower.join(least, "node")
        moved = linked.select(F.col("m").alias("a"), F.col("below").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("node").alias("b")))
    return moved.filter(F.col("a") < F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge table (a, b): the least node it is connected to.

    Large-star and small-star steps alternate until the edges are stars. Each is a minimum by
    node, combined before its shuffle, and a join with one row a node on one side, so the
    centre of a large star is split like any skewed key. Edges are stored between rounds, and
    only a count and a checksum come to the driver.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    state = keep(ordered.filter(F.col("a") < F.col("b")).distinct(), "edges")
    before = None
    while True:
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
        state = keep(_fewer(_fewer(state, True), False), "edges")
    leaves = state.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
