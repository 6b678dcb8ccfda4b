import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import integrity, placement, tree
from tablesync.spec import PathRule

NODES = "id int, parent int, name string, area int"
DATA = [
    (1, None, "A", 1), (2, 1, "B", 1), (3, 2, "C", 1), (4, 1, "D", 1), (5, None, "X", 1),
    (6, 99, "lost", 1), (7, 6, "under lost", 1), (8, 9, "ring", 1), (9, 8, "ring", 1), (10, 9, "below ring", 1),
]


@pytest.fixture
def nodes(rows):
    return rows(DATA, NODES)


def test_paths(nodes):
    got = tree.build_paths(nodes, "id", "parent", "name")
    assert values(got) == sorted(
        [(1, "/A", 1), (2, "/A/B", 2), (3, "/A/B/C", 3), (4, "/A/D", 2), (5, "/X", 1)], key=lambda t: str(t[0])
    )


def test_subtree_of_any_root(nodes, rows):
    assert values(tree.subtree(nodes, "id", "parent", rows([(2,), (6,)], "id int"), "id")) == [(2,), (3,), (6,), (7,)]
    assert values(tree.subtree(nodes, "id", "parent", rows([(8,)], "id int"), "id")) == [(10,), (8,), (9,)]
    assert tree.subtree(nodes, "id", "parent", rows([], "id int"), "id").count() == 0


def test_deep_chain_takes_few_rounds(rows):
    df = rows([(i, i - 1 if i else None, "n", 1) for i in range(300)], NODES)
    got = tree.build_paths(df, "id", "parent", "name")
    assert got.agg(F.max("depth").alias("m")).first()["m"] == 300


def test_random_tree_matches_a_walk(rows):
    r = random.Random(3)
    data = [(i, r.randrange(i) if i and r.random() < 0.9 else None, f"n{r.randrange(4)}", 1) for i in range(200)]
    path = {}
    for i, p, n, _ in data:
        path[i] = ("" if p is None else path[p]) + "/" + n
    got = tree.build_paths(rows(data, NODES), "id", "parent", "name")
    assert {x["id"]: x["path"] for x in got.collect()} == path


@pytest.mark.parametrize(
    "path, area, included",
    [
        ("/Customer Center", 1, True), ("/Customer Center/Products", 1, True), ("/Blog", 1, False), ("/Customer Center", 2, False),
        ("/Customer Center2", 1, False), ("/customer center/Products", 1, True), ("/Customer Center/Archive", 1, False),
        ("/Customer Center/Archive/Old", 1, False), ("/Customer Center/Archive2", 1, True), ("/any", 3, True), (None, 1, False),
    ],
)
def test_path_rules(rows, path, area, included):
    rules = [PathRule(1, "/Customer Center", ("/Customer Center/Archive",)), PathRule(3, "/")]
    df = tree.filter_paths(rows([(path, area)], "p string, a int"), "p", "a", rules)
    assert bool(df.count()) == included


def test_filter_tree_needs_every_ancestor(nodes):
    assert tree.filter_tree(nodes, "id", "parent", "name", "area", [PathRule(1, "/A/B")]).count() == 0
    got = tree.filter_tree(nodes, "id", "parent", "name", "area", [PathRule(1, "/a", ("/A/D",))])
    assert values(got) == [(1, "/A"), (2, "/A/B"), (3, "/A/B/C")]


def test_cascade_skip(nodes, rows):
    got = tree.cascade_skip(nodes, "id", "parent", rows([(2,), (3,)], "id int"), "id")
    assert dict(values(got))[2] == "failed" and dict(values(got))[3] == "skipped" and dict(values(got))[4] == "applied"


def test_ordered_tree(rows):
    df = rows([(1, None, "r", 0), (2, 1, "b", 5), (3, 1, "a", 5), (4, 1, "z", -1), (5, 3, "x", 0)], "id int, parent int, name string, sort int")
    got = [r["id"] for r in tree.ordered_tree(df, "id", "parent", "sort", "name").collect()]
    assert got == [1, 4, 3, 5, 2]


def test_tree_keys_do_not_cut(rows):
    wide = 2**62
    df = rows([("root", None, "r", 0), ("x" * 30 + "b", "root", "n", wide), ("x" * 30 + "a", "root", "n", wide), ("c", "root", "n", -wide)], "id string, parent string, name string, sort bigint")
    got = tree.ordered_tree(df, "id", "parent", "sort", "name").collect()
    assert [r["id"] for r in got] == ["root", "c", "x" * 30 + "a", "x" * 30 + "b"] and len({r.tree_key for r in got}) == 4


def test_counts(nodes, rows):
    paras = rows([(1,), (3,), (5,), (None,)], "page int")
    got = tree.tree_counts(nodes, "id", "parent", rows([(1,)], "id int"), "id", {"paragraphs": (paras, "page")})
    assert values(got) == [("nodes", 4), ("paragraphs", 2)]


def test_renumber_equal_sorts_and_hot_page(rows):
    df = rows([(1, 0, i) for i in range(90)] + [(2, 3, 7), (2, 1, 8)], "page int, sort int, id int")
    plain = tree.renumber(df, "page", "sort", "id")
    assert plain.where("page = 1 and id = 4").first()["row_no"] == 5
    assert values(plain.where("page = 2"), "id", "row_no") == [(7, 2), (8, 1)]


def test_layout(rows):
    grid = rows([(1, 11, 0), (1, 12, 0), (2, 21, 5)], "page int, row int, sort int")
    paras = rows([(11, 2, 9, 100), (11, 1, 3, 101), (11, 2, 1, 102), (21, 1, 0, 103)], "r int, c int, s int, p int")
    got = tree.assemble_rows(grid, paras, "page", "row", "sort", "r", "c", "s", "p")
    assert values(got.where("page = 1"), "row", "row_no", "column_id", "para_no", "para_id") == [
        (11, 1, 1, 1, 101), (11, 1, 2, 1, 102), (11, 1, 2, 2, 100), (12, 2, 1, None, None),
    ]


def test_flatten(spark):
    df = spark.sql(
        "select 1 as page, array(named_struct('row', 5, 'columns', array(named_struct('col', 1, 'paragraphs',"
        " array(named_struct('id', 7), named_struct('id', 8))), named_struct('col', 2, 'paragraphs', array(named_struct('id', 9)))))) as rows"
    )
    assert values(tree.flatten_tree(df, ["page"])) == [(1, 5, 1, 7), (1, 5, 1, 8), (1, 5, 2, 9)]


def test_assign_columns(rows):
    columns = rows([(1, 4, 1), (1, 2, 2)], "row int, col int, ord int")
    paras = rows([(1, 2, "known"), (1, 9, "unknown"), (1, None, "none"), (3, 1, "no columns")], "row int, col int, p string")
    got = tree.assign_columns(paras, columns, "row", "col")
    assert values(got, "p", "col") == [("known", 2), ("none", 4), ("unknown", 4)]


def levels(rows, names, edges, **kw):
    got = integrity.dependency_levels(rows([(n,) for n in names], "name string"), rows(edges, "child string, parent string"), **kw)
    return dict(values(got))


def test_levels_are_the_longest_way_up(rows):
    r = random.Random(5)
    names = [f"Node{i}" for i in range(60)]
    pairs = [(i, r.randrange(i)) for i in range(1, 60) for _ in range(r.randrange(3))]
    want = {}
    for i in range(60):
        want[names[i]] = max((want[names[p]] + 1 for c, p in pairs if c == i), default=0)
    edges = [(names[c].upper(), names[p].lower()) for c, p in pairs]
    edges += [(names[7], names[7].upper()), (names[3], "no such node"), ("nor this", names[3])]
    assert levels(rows, names, edges) == want
    assert levels(rows, [], []) == {} and levels(rows, names[:2], []) == {"Node0": 0, "Node1": 0}


def test_a_long_cycle_is_listed_whole(rows, spark):
    ring = [(f"r{i}", f"r{(i + 1) % 80}") for i in range(80)]
    names = [f"r{i}" for i in range(80)] + ["free", "behind"]
    with pytest.raises(integrity.CircularDependencyError, match="81 names") as e:
        levels(rows, names, [*ring, ("behind", "r5")])
    listed = spark.read.parquet(str(e.value).rsplit(" ", 1)[1])
    assert {r.name for r in listed.collect()} == {*names} - {"free"}
    marked = levels(rows, names, [*ring, ("behind", "r5")], on_cycle="mark")
    assert marked["free"] == 0 and {marked[n] for n in names if n != "free"} == {None}
    assert str(e.value).startswith("circular dependency among r0, r1, r10") and listed.where("cycle is null").first().name == "behind"


def strongly_connected(names, edges):
    """Members by smallest member, from the closure of the links; and the longest way up, None on or behind a cycle."""
    up = {n: set() for n in names}
    for c, p in edges:
        if c != p and c in up and p in up:
            up[c].add(p)
    reach = {n: set() for n in names}
    for n in names:
        todo = list(up[n])
        while todo:
            m = todo.pop()
            if m not in reach[n]:
                reach[n].add(m)
                todo.extend(up[m])
    on = {n for n in names if n in reach[n]}
    cycles = sorted((min({m for m in reach[n] if n in reach[m]}), n) for n in on)

    def level(n):
        return None if n in on or reach[n] & on else max((level(p) + 1 for p in up[n]), default=0)

    return cycles, {n: level(n) for n in names}


@pytest.mark.parametrize("seed", (0, 1))
def test_cycles_and_levels_of_random_graphs(rows, seed):
    r = random.Random(seed)
    names = [f"n{i:02}" for i in range(40)]
    edges = [(r.choice(names[5:]), r.choice(names)) for _ in range((20, 35, 50, 80)[seed])]
    cycles, want = strongly_connected(names, edges)
    frames = rows([(n,) for n in names], "name string"), rows(edges, "child string, parent string")
    assert values(integrity.dependency_cycles(*frames), "cycle", "name") == cycles
    assert dict(values(integrity.dependency_levels(*frames, on_cycle="mark"))) == want


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    from tablesync.operators import levels as module

    written = []

    def counted(df):
        written.append(1)
        return placement.cut(df)

    monkeypatch.setattr(module, "cut", counted)

    def chain_of(n):
        name = lambda c: F.concat(F.lit("c"), F.lpad(c.cast("string"), 6, "0"))
        links = spark.range(1, n).select(name(F.col("id")).alias("child"), name(F.col("id") - 1).alias("parent"))
        return spark.range(n).select(name(F.col("id")).alias("name")), links

    n = 100_000
    nodes, chain = chain_of(n)
    got = integrity.dependency_levels(nodes, chain)
    assert got.where("level = cast(substr(name, 2) as int)").count() == n and len(written) <= 2 * n.bit_length()
    nodes, chain = chain_of(2_000)
    written.clear()
    ring = chain.unionByName(spark.createDataFrame([("c001000", "c001999")], "child string, parent string"))
    cycles = integrity.dependency_cycles(nodes, ring)
    assert cycles.count() == 1_000 and cycles.where("cycle <> 'c001000'").isEmpty() and len(written) <= 8 * n.bit_length()


def test_cycles_that_share_nodes_are_found_together(rows, monkeypatch):
    """Rings chained by shared nodes, with bridges between them and tails at both ends: a pass for each ring would take some 600 tables."""
    from tablesync.operators import levels as module

    written = []
    monkeypatch.setattr(module, "cut", lambda df: written.append(1) or placement.cut(df))
    r, edges = random.Random(3), []
    names = [f"n{i:03}" for i in range(240)]
    for i in range(0, 180, 3):
        edges += [(names[i], names[i + 1]), (names[i + 1], names[i + 2]), (names[i + 2], names[i])]
        edges += [(names[i + 3], names[i + r.randrange(3)])]  # from ring to ring
        if i % 4 == 0:
            edges += [(names[i + 1], names[i + 5]), (names[i + 4], names[i])]
    edges += [(names[i + 1], names[i]) for i in range(180, 239)]  # a tail
    cycles, _ = strongly_connected(names, edges)
    r.shuffle(names)
    got = integrity.dependency_cycles(rows([(n,) for n in names], "name string"), rows(edges, "child string, parent string"))
    assert values(got, "cycle", "name") == cycles and len({c for c, _ in cycles}) > 20 and len(written) < 150


@pytest.mark.parametrize("rounds", (1, 64))
def test_paths_between_and_through_cycles(rows, monkeypatch, rounds):
    """A path from a node back to itself is a cycle, one between two cycles is not; labels that have not settled put together only what is sure."""
    from tablesync.operators import levels as module

    monkeypatch.setattr(module, "ROUNDS", rounds)
    monkeypatch.setattr(module, "STEPS", 1)
    edges = [("a", "b"), ("b", "a"), *[(f"p{i}", f"p{i + 1}") for i in range(9)], ("a", "p0"), ("p9", "c"), ("c", "d"), ("d", "c")]
    edges += [("c", "q0"), ("q0", "q1"), ("q1", "c"), *[(f"w{i}", f"w{i + 1}") for i in range(12)], *[(f"w{i + 1}", f"w{i}") for i in range(12)]]
    names = sorted({n for e in edges for n in e})
    got = integrity.dependency_cycles(rows([(n,) for n in names], "name string"), rows(edges, "child string, parent string"))
    assert values(got, "cycle", "name") == strongly_connected(names, edges)[0]


def test_orphans(rows):
    child, parent = rows([(1, 5), (2, 6), (3, None), (4, 6)], "id int, fk int"), rows([(5,), (None,)], "k int")
    assert values(integrity.fk_orphans(child, parent, "fk", "k"), "id") == [(2,), (4,)]
    assert values(integrity.fk_orphans(child, parent, "fk", "k", nulls_are_orphans=True), "id") == [(2,), (3,), (4,)]
    assert values(integrity.orphans_by_group(child, parent, "fk", "k")) == [(6, 2)]


def test_cascade_and_guards(rows):
    pages = rows([(1, 1), (2, 7), (3, None)], "page int, area int")
    victims = integrity.victims_in_orphan_areas(pages, rows([(1,)], "area int"), "page", "area", "area")
    kept = integrity.delete_cascade({"pages": (pages, "page"), "paras": (rows([(2,), (3,), (None,)], "p int"), "p")}, victims, "page")
    assert values(kept["pages"], "page") == [(1,), (3,)] and values(kept["paras"]) == [(None,), (3,)]
    assert integrity.assert_count(pages, 1, 3) == 3 and integrity.assert_count(pages.where("false"), 5) == 0
    with pytest.raises(integrity.CountGuardError):
        integrity.assert_count(pages, 10)
    with pytest.raises(integrity.CountGuardError):
        integrity.assert_count(pages.where("false"), 5, zero_ok=False)


def test_dangling_and_delete_where(rows):
    df = rows([(1, "i1", ""), (2, "i2", "T"), (3, "", None), (4, "i4", None)], "k int, item string, kind string")
    cleared, n = integrity.dangling_pairs(df, "item", "kind")
    assert values(cleared, "k", "item") == [(1, None), (2, "i2"), (3, ""), (4, None)] and n.first()["cleared"] == 2
    assert values(integrity.delete_where(df, F.col("kind") == "T"), "k") == [(1,), (3,), (4,)]
