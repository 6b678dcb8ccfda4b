"""Levels of a dependency graph, and the members of its cycles, in a number of rounds that grows with the logarithm of its depth.

The first ``PEELED`` levels are taken off one by one: a round is one join, and most graphs end there. In what is left every node points at one of its parents: the one that is known to lie deepest. Following the pointers by doubling gives each node the
length of its path, and shows cycles: what never reaches a root ends in one. Then all cycles are found together (``find_cycles``) and become one
node each; after that, nodes turn to parents that have come to lie deeper, until no link asks for a greater level. Trees take one pass; other graphs
as many as a path has places where the deepest way is not the one first tried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.operators.placement import cut, delete_path, work_path

PEELED = 16
STEPS = 8  # links followed in one round of labels
ROUNDS = 64  # of labels before what is known is put together; doubled each time
BEHIND = 1 << 40  # more than any path has steps: what lies on or behind a cycle


@dataclass(frozen=True)
class Ranked:
    """``levels(node, level)``, NULL on or behind a cycle; ``cycles(cycle, node)``, named by the smallest member."""

    levels: DataFrame
    cycles: DataFrame


def _followed(pointers: DataFrame) -> tuple[DataFrame, bool]:
    """Lengths (v, d) of the pointer paths, and whether there are nodes that never reach the end of one.

    ``pointers(v, p, d)``: p is NULL for roots. Each round doubles the steps looked ahead and writes only what has not arrived.
    Depths have no gaps: a round in which nothing arrives is the last one.
    """
    arrived = [pointers.where("p is null").select("v", "d")]
    going = cut(pointers.where("p is not null").select("v", "p", F.col("p").alias("j"), "d"))
    left = going.count()
    while left:
        ends = arrived[0]
        for more in arrived[1:]:
            ends = ends.unionByName(more)
        ahead = going.select(F.col("v").alias("_v"), F.col("j").alias("_j"), F.col("d").alias("_d"))
        ahead = ahead.unionByName(ends.select(F.col("v").alias("_v"), F.lit(None).cast("string").alias("_j"), F.col("d").alias("_d")))
        step = cut(going.join(ahead, F.col("j") == F.col("_v")).select("v", "p", F.col("_j").alias("j"), (F.col("d") + F.col("_d")).alias("d")))
        arrived.append(step.where("j is null").select("v", "d"))
        going = step.where("j is not null")
        before, left = left, going.count()
        if left == before:
            return arrived[0], True
    ends = arrived[0]
    for more in arrived[1:]:
        ends = ends.unionByName(more)
    return ends, False


def _trimmed(links: DataFrame) -> DataFrame:
    """The links (a, b) without those of nodes that no link leads to or away from, round by round while a round takes off a fifth."""
    left = links.count()
    while left:
        inner = links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        links = cut(inner.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a", "b"))
        before, left = left, links.count()
        if left > 0.8 * before:
            break
    return links


def _shortened(links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) with one link in the place of each path, and the nodes (u, s, t) of the paths from s to t, or None.

    A path has nodes of one link in and one link out. They are on a cycle where s and t are on the same one, or are the same node. What is left
    ahead is doubled at both ends; where nothing arrives, the rest are rings, which stay as they are.
    """
    ends = links.groupBy("a").count().where("count = 1").join(links.groupBy(F.col("b").alias("a")).count().where("count = 1"), "a", "left_semi")
    inner = cut(ends.select(F.col("a").alias("u")))
    if inner.isEmpty():
        return links, None
    ways = links.select(F.lit(True).alias("up"), F.col("a").alias("u"), F.col("b").alias("j")).unionByName(
        links.select(F.lit(False).alias("up"), F.col("b").alias("u"), F.col("a").alias("j"))
    )
    ways = ways.join(inner, "u", "left_semi").join(inner.select(F.col("u").alias("_u")), F.col("j") == F.col("_u"), "left")
    ways = cut(ways.select("up", "u", "j", F.col("_u").isNotNull().alias("open")))
    arrived, going = ways.where("not open"), ways.where("open")
    left = going.count()
    while left:
        ahead = arrived.unionByName(going).select(F.col("up").alias("_up"), F.col("u").alias("_u"), F.col("j").alias("_j"), F.col("open").alias("_open"))
        step = going.join(ahead, (F.col("up") == F.col("_up")) & (F.col("j") == F.col("_u")))
        step = cut(step.select("up", "u", F.col("_j").alias("j"), F.col("_open").alias("open")))
        arrived, going = arrived.unionByName(step.where("not open")), step.where("open")
        before, left = left, going.count()
        if left == before:
            break
    paths = arrived.where("not up").select("u", F.col("j").alias("s")).join(arrived.where("up").select("u", F.col("j").alias("t")), "u")
    paths = cut(paths)
    on = paths.select(F.col("u").alias("_u"))
    direct = links.join(on, F.col("a") == F.col("_u"), "left_anti").join(on, F.col("b") == F.col("_u"), "left_anti")
    return cut(direct.unionByName(paths.select(F.col("s").alias("a"), F.col("t").alias("b")).where("a <> b")).distinct()), paths


def _labels(links: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """(v, up, down): the smallest nodes that v reaches and that reach v by links (a, b), and whether that is the end of it.

    Both ways run as one graph: node v upwards is 2v, downwards 2v + 1. A round follows the labels of what has changed, then ``STEPS`` links, and only
    what has changed goes on. After ``most`` rounds the labels may be too large, but are nodes that v reaches, or that reach v.
    """
    ways = links.select((F.col("a") * 2).alias("v"), (F.col("b") * 2).alias("w"))
    ways = ways.unionByName(links.select((F.col("b") * 2 + 1).alias("v"), (F.col("a") * 2 + 1).alias("w")))
    every = ways.select("v").unionByName(ways.select(F.col("w").alias("v"))).distinct()
    ways = cut(ways.unionByName(every.select("v", F.col("v").alias("w"))))
    known = cut(ways.where("v = w").select("v", F.col("v").alias("f")))
    fresh, settled = known, False
    for _ in range(most):
        there = known.select(F.col("v").alias("_v"), F.col("f").alias("_f"))
        news = fresh.select(F.col("v").alias("_v"), F.col("f").alias("_f"))
        # the label of a new label, and the new label of a label
        moved = fresh.unionByName(fresh.join(there, F.col("f") == F.col("_v")).select("v", F.col("_f").alias("f")))
        moved = moved.unionByName(known.join(news, F.col("f") == F.col("_v")).select("v", F.col("_f").alias("f")))
        for _ in range(STEPS):
            moved = ways.join(moved.select(F.col("v").alias("w"), "f"), "w").groupBy("v").agg(F.min("f").alias("f"))
        joined = known.join(moved.select(F.col("v").alias("_v"), F.col("f").alias("_f")), F.col("v") == F.col("_v"), "left")
        after = cut(joined.select("v", F.coalesce(F.least("f", "_f"), "f").alias("f"), F.coalesce(F.col("_f") < F.col("f"), F.lit(False)).alias("moved")))
        known, fresh = after.select("v", "f"), cut(after.where("moved").select("v", "f"))
        if fresh.isEmpty():
            settled = True
            break
    label = F.shiftright("f", 1)
    sides = [F.max(F.when(F.col("v") % 2 == n, label)).alias(c) for n, c in ((0, "up"), (1, "down"))]
    return cut(known.groupBy(F.shiftright("v", 1).alias("v")).agg(*sides)), settled


def _put(df: DataFrame, col: str, reps: DataFrame) -> DataFrame:
    """``df`` with the nodes of a column replaced by what stands for them in ``reps(v, rep)``."""
    names = reps.select(F.col("v").alias("_v"), F.col("rep").alias("_rep"))
    return df.join(names, F.col(col) == F.col("_v"), "left").withColumn(col, F.coalesce("_rep", col)).drop("_v", "_rep")


def find_cycles(links: DataFrame) -> DataFrame:
    """``cycles(cycle, node)`` of ``links(child, parent)`` without repeats and loops, named by the smallest member. Runs at once.

    Nodes that lie on no cycle are trimmed off at both ends, and paths become one link. Of what is left, a node that reaches and is reached by the
    same smallest node is on one cycle with it; others can only be on cycles with nodes of the same two labels, so the
    links between different ones go. All cycles of a round are found together; numbers in the order of hashes keep the rounds few. Where labels take
    long to settle, what is known to be on a cycle is put together first.
    """
    links = _trimmed(links.select(F.col("child").alias("a"), F.col("parent").alias("b")))
    names = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    ids = cut(names.repartition("node").sortWithinPartitions(F.xxhash64("node")).select(F.monotonically_increasing_id().alias("v"), "node"))
    for end in ("a", "b"):
        links = links.join(ids.select(F.col("v").alias("_v"), F.col("node").alias(end)), end).withColumn(end, F.col("_v")).drop("_v")
    links, paths = _shortened(cut(links.select("a", "b")))
    members = links.sparkSession.createDataFrame([], "v long, rep long")
    most = ROUNDS
    while True:
        links = _trimmed(links)
        if links.isEmpty():
            break
        labels, settled = _labels(links, most)
        reps = labels.where("up = down and v <> up").select("v", F.col("up").alias("rep"))
        if settled:
            same = labels.where("up <> down")
            for end in ("a", "b"):
                links = links.join(same.select(F.col("v").alias(end), F.col("up").alias(f"up_{end}"), F.col("down").alias(f"down_{end}")), end)
            links = cut(links.where("up_a = up_b and down_a = down_b").select("a", "b"))
        else:
            while not reps.join(reps.select(F.col("v").alias("_v")), F.col("rep") == F.col("_v"), "left_semi").isEmpty():
                reps = cut(_put(reps, "rep", reps))
            links = cut(_put(_put(links, "a", reps), "b", reps).where("a <> b").distinct())
            most *= 2
        members = cut(_put(members, "rep", reps).unionByName(reps))
    if paths is not None:
        both = _put(_put(paths, "s", members), "t", members).where("s = t")
        members = members.unionByName(both.select(F.col("u").alias("v"), F.col("s").alias("rep")))
    members = cut(members.unionByName(members.select(F.col("rep").alias("v"), "rep").distinct()))
    named = cut(members.join(ids, "v").select("rep", "node"))
    first = named.groupBy("rep").agg(F.min("node").alias("cycle"))
    return cut(named.join(first, "rep").select("cycle", "node"))


def rank_nodes(nodes: DataFrame, links: DataFrame) -> Ranked:
    """Levels of ``nodes(node)`` by ``links(child, parent)`` among them, both without repeats and without loops. Runs at once."""
    first, links = _peeled(nodes, links)
    if links.isEmpty():
        return Ranked(first, nodes.sparkSession.createDataFrame([], "cycle string, node string"))
    rest = cut(nodes.join(first, "node", "left_anti"))
    deep = _ranked(rest, links)
    return Ranked(first.unionByName(deep.levels.withColumn("level", F.col("level") + PEELED)), deep.cycles)


def _peeled(nodes: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the first ``PEELED`` levels, and the links among the others. A round writes the links that remain, apart from
    those just dissolved, and the new level: the nodes whose last parent went the round before."""
    spark, root = nodes.sparkSession, work_path(nodes.sparkSession, "levels")
    ready = nodes.join(links.select(F.col("child").alias("node")).distinct(), "node", "left_anti")
    for level in range(PEELED):
        ready.select("node").write.parquet(f"{root}/ready/level={level}")
        done = spark.read.schema("node string").parquet(f"{root}/ready/level={level}")
        if done.isEmpty():
            break
        gone = done.select(F.col("node").alias("_g"))
        judged = links.join(gone, F.col("parent") == F.col("_g"), "left").select("child", "parent", F.col("_g").isNotNull().alias("gone"))
        judged.write.partitionBy("gone").parquet(f"{root}/links/{level}")
        if level:
            delete_path(spark, f"{root}/links/{level - 1}")
        round_ = spark.read.schema("child string, parent string, gone boolean").parquet(f"{root}/links/{level}")
        links = round_.where("not gone").select("child", "parent")
        freed = round_.where("gone").select(F.col("child").alias("node")).distinct()
        ready = freed.join(links.select(F.col("child").alias("node")).distinct(), "node", "left_anti")
    return spark.read.schema("node string, level int").parquet(f"{root}/ready"), links


def _ranked(nodes: DataFrame, links: DataFrame) -> Ranked:
    spark = nodes.sparkSession
    members = spark.createDataFrame([], "node string, rep string")  # of cycles that have been put together
    levels = nodes.select(F.col("node").alias("v"), F.lit(0).cast("long").alias("d"))
    tied = spark.createDataFrame([], "rep string")
    while True:
        weight = F.when(F.col("_t").isNotNull(), F.lit(BEHIND)).otherwise(0) + 1
        known = levels.join(tied.select(F.col("rep").alias("_t")), F.col("v") == F.col("_t"), "left")
        known = known.select(F.col("v").alias("_p"), weight.alias("w"), (F.col("d") + weight).alias("reach"))
        reached = links.join(known, F.col("parent") == F.col("_p"))
        deepest = reached.groupBy(F.col("child").alias("_c")).agg(F.max(F.struct("reach", "parent", "w")).alias("m"))
        pointers = cut(levels.join(deepest, F.col("v") == F.col("_c"), "left").select("v", F.col("m.parent").alias("p"), F.coalesce("m.w", F.lit(0)).alias("d"), F.col("d").alias("_d"), F.col("m.reach").alias("reach")))
        if pointers.where("reach > _d").isEmpty():
            break
        levels, stuck = _followed(pointers.select("v", "p", "d"))
        if stuck:  # only once: all cycles are put together
            members = find_cycles(links).select("node", F.col("cycle").alias("rep"))
            reps = members.withColumnRenamed("node", "v")
            links = cut(_put(_put(links, "child", reps), "parent", reps).where("child <> parent").distinct())
            tied = cut(members.select("rep").distinct())
            gone = reps.where("v <> rep").select(F.col("v").alias("_v"))
            levels = cut(pointers.join(gone, F.col("v") == F.col("_v"), "left_anti").select("v", F.lit(0).cast("long").alias("d")))
        else:
            levels = cut(levels)
    of = nodes.join(members, "node", "left").select("node", F.coalesce("rep", "node").alias("v"), F.col("rep").isNotNull().alias("on"))
    found = of.join(levels, "v").select("node", F.when(~F.col("on") & (F.col("d") < BEHIND), F.col("d").cast("int")).alias("level"))
    return Ranked(found, members.select(F.col("rep").alias("cycle"), "node"))
