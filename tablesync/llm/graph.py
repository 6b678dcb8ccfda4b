"""Connected components by alternating stars, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.shared import forget, saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of the component.

    Each round first links the larger neighbours of a node to its smallest one, then a node's smaller neighbours and
    itself; minima are found by a pre-aggregated grouping and joined back, so a node with very many neighbours is
    spread over tasks. Rounds grow with the logarithm of the component size; each is a table in the shared folder,
    deleted once the next is written. No edges: no rows. Edges from a node to itself are ignored.
    """
    a, b = F.col("a"), F.col("b")
    now = saved(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    while not _settled(now):
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(a.alias("x"), F.least("a", "m").alias("m"))
        large = both.join(least, a == F.col("x")).where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        small = large.groupBy("a").agg(F.min("b").alias("m")).select(a.alias("x"), "m")
        pairs = large.join(small, a == F.col("x")).where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        rooted = small.select(F.col("x").alias("a"), F.col("m").alias("b"))
        after = saved(pairs.unionByName(rooted).distinct(), "edges")
        forget(now)
        now = after
    roots = now.select(b.alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(a.alias("node"), b.alias("root")).unionByName(roots)


def _settled(edges: DataFrame) -> bool:
    """Every node with a smaller neighbour has one only, and is no one's smaller neighbour itself: all parts are stars."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()
