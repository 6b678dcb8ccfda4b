"""Interval labels against walks through the tree in Python."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import intervals, tree


def grown(n, seed):
    r = random.Random(seed)
    return [(i, None if i % 29 == 0 else r.randrange(max(0, i - 12), i)) for i in range(n)]


def walk(pairs, key=lambda i: i):
    below = {}
    for i, p in pairs:
        below.setdefault(p, []).append(i)
    labels, n = {}, 0

    def visit(i, level):
        nonlocal n
        n += 1
        entry = n
        for c in sorted(below.get(i, []), key=key):
            visit(c, level + 1)
        labels[i] = (level, entry, n)

    for root in sorted(below.get(None, []), key=key):
        visit(root, 1)
    return labels


@pytest.fixture(scope="module")
def made(spark):
    pairs = grown(150, 1)
    extra = [(900, 999), (901, 900), (902, 903), (903, 902)]  # below a missing parent, and a cycle
    nodes = spark.createDataFrame(pairs + extra, "id int, up int")
    return pairs, nodes, intervals.label_tree(nodes, "id", "up")


def test_labels_are_those_of_a_walk(made):
    pairs, _, labels = made
    assert {r.node_id: (r.level, r.entry, r.exit) for r in labels.collect()} == walk(pairs)


def test_siblings_in_an_order_of_their_own(spark):
    pairs = grown(40, 3)
    nodes = spark.createDataFrame([(i, p, f"{(i * 7) % 10:02}") for i, p in pairs], "id int, up int, name string")
    got = intervals.label_tree(nodes, "id", "up", F.col("name"))
    assert {r.node_id: (r.level, r.entry, r.exit) for r in got.collect()} == walk(pairs, key=lambda i: (f"{(i * 7) % 10:02}", i))


def test_subtrees_counts_and_survivors(spark, made):
    pairs, nodes, labels = made
    spans = walk(pairs)
    roots = [3, 4, 17, 100, 149, 5000]
    below = sorted(i for i, (_, e, _) in spans.items() if any(r in spans and spans[r][1] <= e <= spans[r][2] for r in roots))
    marks = spark.createDataFrame([(r,) for r in [*roots, 3]], "id int")
    got = [r[0] for r in values(intervals.subtree_by_labels(labels, marks, "id"))]
    assert sorted(got) == below and sorted(got) == sorted(r[0] for r in values(tree.subtree(nodes.where("id < 900"), "id", "up", marks, "id")) if r[0] != 5000)
    assert dict(values(intervals.counts_by_labels(labels))) == {i: b - a + 1 for i, (_, a, b) in spans.items()}
    assert sorted(r[0] for r in values(intervals.survivors_by_labels(labels, marks, "id"))) == sorted(set(spans) - set(below))
    assert intervals.subtree_by_labels(labels, marks.limit(0), "id").count() == 0


def test_blocks_cover_ranges_once(spark):
    spans = [(a, b) for a in range(1, 20) for b in range(a, 24)] + [(5, 10**12), (2**40, 2**40 + 3)]
    rows = spark.createDataFrame(spans, "a long, b long").select("a", "b", intervals._blocks(F.col("a"), F.col("b")).alias("c")).collect()
    for r in rows:
        blocks = sorted((c.b << c.k, ((c.b + 1) << c.k) - 1) for c in r.c)
        assert blocks[0][0] == r.a and blocks[-1][1] == r.b and all(x[1] + 1 == y[0] for x, y in zip(blocks, blocks[1:], strict=False))


def test_a_moved_subtree_is_relabelled_in_place(spark):
    pairs = grown(60, 5)
    nodes = spark.createDataFrame(pairs, "id int, up int")
    labels = intervals.label_tree(nodes, "id", "up").cache()
    spans, r = walk(pairs), random.Random(9)
    for _ in range(12):
        root, parent = r.choice([i for i, p in pairs if p is not None]), r.randrange(60)
        if spans[root][1] <= spans[parent][1] <= spans[root][2]:
            with pytest.raises(ValueError):
                intervals.move_subtree(labels, root, parent)
            continue
        got = {x.node_id: (x.level, x.entry, x.exit) for x in intervals.move_subtree(labels, root, parent).collect()}
        # the moved node is the last child of its new parent
        moved = [(i, parent if i == root else p) for i, p in pairs]
        assert got == walk(moved, key=lambda i: (i == root, i))
    labels.unpersist()
