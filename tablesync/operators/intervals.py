"""Interval labels of a tree: entry and exit numbers of a walk through it, made once and asked often.

A node's descendants are the nodes whose entry lies between its own entry and its exit, so subtrees, counts and tests for ancestors need no rounds.
Ranges meet entries by equality of aligned blocks: a range is cut into blocks of powers of two, and an entry lies in one block of each size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.operators.placement import cut, ordinal
from tablesync.operators.tree import fold_up

DIGITS = 19


def label_tree(nodes: DataFrame, id_col: str, parent_col: str, order: Column | None = None) -> DataFrame:
    """(node_id, parent_id, level, entry, exit): a walk that takes siblings by ``order``, then id. Runs at once.

    Roots are nodes without a parent; nodes below a missing parent or on or below a cycle have no label. A fold over the ancestors gives each
    node its place among all, a second one its exit: the entry before the next sibling's, or the parent's exit.
    """
    rows = nodes.select(F.col(id_col).alias("node_id"), F.col(parent_col).alias("parent_id"), (F.lit("") if order is None else order.cast("string")).alias("_order"))
    among = ordinal(rows, ["parent_id"], ["_order", "node_id"], "_n")
    step = F.concat(F.lpad(F.col("_n").cast("string"), DIGITS, "0"), F.lit("/"))
    folded = fold_up(among, "node_id", "parent_id", {"way": (step, lambda low, up: F.concat(up, low)), "level": (F.lit(1), lambda low, up: low + up)})
    placed = folded.where("reached_root").select("node_id", "way", "level")
    numbered = ordinal(placed, [], ["way"], "entry").select("node_id", "level", "entry")
    labelled = cut(numbered.join(among.select("node_id", "parent_id", "_n"), "node_id"))
    following = labelled.select(F.col("parent_id").alias("_p"), (F.col("_n") - 1).alias("_m"), (F.col("entry") - 1).alias("_until"))
    same = F.col("parent_id").eqNullSafe(F.col("_p")) & (F.col("_n") == F.col("_m"))
    ends = cut(labelled.join(following, same, "left").select("node_id", "parent_id", "level", "entry", "_until"))
    last = labelled.agg(F.max("entry")).first()[0]
    exits = fold_up(ends, "node_id", "parent_id", {"exit": (F.col("_until"), lambda low, up: F.coalesce(low, up))})
    joined = ends.join(exits.select(F.col("node_id").alias("_id"), "exit"), F.col("node_id") == F.col("_id"))
    return cut(joined.select("node_id", "parent_id", "level", "entry", F.coalesce("exit", F.lit(last)).cast("long").alias("exit")))


def _blocks(low: Column, high: Column) -> Column:
    """Aligned blocks (size as a power, number) that make up the numbers from ``low`` to ``high``: two of each size at most."""

    def at(k: Column) -> Column:
        # at size 2^k: the block that begins at an odd place on the left, and the one that ends at an even place on the right
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        first, last = F.ceil(low / size), F.floor((high + 1) / size)  # blocks first .. last - 1 lie inside
        left = F.when((first < last) & (F.pmod(first, F.lit(2)) == 1), F.struct(k.alias("k"), first.cast("long").alias("b")))
        right = F.when((first < last) & (F.pmod(last, F.lit(2)) == 1) & ((last - 1 > first) | (F.pmod(first, F.lit(2)) == 0)), F.struct(k.alias("k"), (last - 1).cast("long").alias("b")))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(40)), at)))


def _outermost(ranges: DataFrame) -> DataFrame:
    """Ranges (entry, exit) that lie in no other one; equal ones once."""
    return ranges.select("entry", "exit").distinct()


def inside(labels: DataFrame, ranges: DataFrame) -> DataFrame:
    """The labelled nodes whose entry lies in one of the ranges (entry, exit)."""
    blocks = cut(_outermost(ranges).select(F.explode(_blocks(F.col("entry"), F.col("exit"))).alias("c")).select("c.k", "c.b").distinct())
    sizes = [r.k for r in blocks.select("k").distinct().collect()]  # at most 41
    if not sizes:
        return labels.limit(0)
    places = F.transform(F.array(*[F.lit(k) for k in sorted(sizes)]), lambda k: F.struct(k.alias("k"), F.floor(F.col("entry") / F.call_function("shiftleft", F.lit(1).cast("long"), k)).cast("long").alias("b")))
    unfolded = labels.select("node_id", F.inline(places))
    hits = unfolded.join(blocks, ["k", "b"], "left_semi").select("node_id").distinct()
    return labels.join(hits, "node_id", "left_semi")


def subtree_by_labels(labels: DataFrame, roots: DataFrame, root_id: str) -> DataFrame:
    """``node_id`` of the roots and all nodes below them."""
    marks = roots.select(F.col(root_id).alias("node_id")).distinct()
    return inside(labels, labels.join(marks, "node_id", "left_semi")).select("node_id")


def counts_by_labels(labels: DataFrame) -> DataFrame:
    """(node_id, n): how many nodes each subtree has, its root counted. No join."""
    return labels.select("node_id", (F.col("exit") - F.col("entry") + 1).alias("n"))


def survivors_by_labels(labels: DataFrame, gone: DataFrame, gone_id: str) -> DataFrame:
    """``node_id`` of the nodes that are not among ``gone`` and have no ancestor among them."""
    below = subtree_by_labels(labels, gone, gone_id)
    return labels.join(below, "node_id", "left_anti").select("node_id")


def move_subtree(labels: DataFrame, root, new_parent) -> DataFrame:
    """Labels after a subtree became the last one below another node: one projection, no rounds.

    Only the labels between the old and the new place change, by fixed amounts. A node cannot move below itself.
    """
    found = {r.node_id: r for r in labels.where(F.col("node_id").isin(root, new_parent)).collect()}
    a, p = found[root], found[new_parent]
    if a.entry <= p.entry <= a.exit:
        raise ValueError("a node cannot move below itself")
    size, low, high = a.exit - a.entry + 1, a.entry, a.exit
    moved = F.col("entry").between(low, high)
    if p.exit >= high:  # to the right: what lies between moves left by the subtree's size
        shift = p.exit - high
        entry = F.when(moved, F.col("entry") + shift).when(F.col("entry").between(high + 1, p.exit), F.col("entry") - size).otherwise(F.col("entry"))
        exit_ = F.when(moved, F.col("exit") + shift).when(F.col("exit").between(high, p.exit - 1), F.col("exit") - size)
        # what ends with the subtree's new parent, the parent itself and its last descendants' ends: the former keep theirs
        holds_parent = (F.col("entry") <= p.entry) & (F.col("exit") >= p.exit)
        exit_ = exit_.when((F.col("exit") == p.exit) & ~holds_parent, F.col("exit") - size).otherwise(F.col("exit"))
    else:  # to the left: what lies between moves right
        shift = low - p.exit - 1
        entry = F.when(moved, F.col("entry") - shift).when(F.col("entry").between(p.exit + 1, low - 1), F.col("entry") + size).otherwise(F.col("entry"))
        holds_parent = (F.col("entry") <= p.entry) & (F.col("exit") >= p.exit)
        exit_ = F.when(moved, F.col("exit") - shift).when(holds_parent & (F.col("exit") < high), F.col("exit") + size)
        exit_ = exit_.when(F.col("exit").between(p.exit + 1, low - 1), F.col("exit") + size).otherwise(F.col("exit"))
    level = F.when(moved, F.col("level") + (p.level + 1 - a.level)).otherwise(F.col("level"))
    parent = F.when(F.col("node_id") == root, F.lit(new_parent)).otherwise(F.col("parent_id"))
    return labels.select("node_id", parent.alias("parent_id"), level.alias("level"), entry.alias("entry"), exit_.alias("exit"))
