"""Connected components by alternating stars, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link what a node sees to the least node it sees: its larger neighbours, or itself and its smaller ones."""
    if large:
        seen = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = seen.join(least, "u")
    linked = joined.where("v > u" if large else "true").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        linked = linked.union(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the least node of its component.

    ``edges``: columns u and v of one comparable type; loops and repeated edges do no harm. Each
    round writes its edges to the shared scratch folder; rounds grow with the logarithm of
    the longest path.
    """
    edges = saved(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == state or not mark[0]:
            break
        state = tuple(mark)
        edges = saved(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
