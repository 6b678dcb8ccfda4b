"""Many fragments and many path rules against plain loops; plans of one size."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import fragments, tree
from tablesync.operators.placement import cut
from tablesync.spec import PathRule


def test_hits_against_a_loop(spark, rows):
    r = random.Random(2)
    signs = "abcAé日 ."
    cells = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(150)] + [None, ""]
    wanted = ["".join(r.choices(signs, k=r.randint(1, 9))) for _ in range(300)] + ["", None, "abca", "ABCA"]
    df = rows([(i, c, (c or "x")[::-1]) for i, c in enumerate(cells)], "id int, a string, b string")
    frame = spark.createDataFrame([(w,) for w in wanted], "fragment string")
    for any_case in (False, True):
        fold = str.lower if any_case else str
        want = {(i, col, w) for i, c in enumerate(cells) for col, t in (("a", c), ("b", (c or "x")[::-1])) for w in wanted if t and w and fold(w) in fold(t)}
        assert set(values(fragments.fragment_hits(df, ["id"], frame, any_case=any_case))) == want
    assert fragments.fragment_hits(df, ["id"], frame.limit(0)).count() == 0
    only = fragments.fragment_hits(df, ["id"], frame, cols=["a"])
    assert {r.col for r in only.select("col").distinct().collect()} == {"a"}


def test_clearing_and_census(rows):
    df = rows([(1, "uses Old.cshtml", "Old.cshtml", 5), (2, "fine", None, 6), (3, None, "NEWER", 7)], "id int, a string, b string, n int")
    frame = rows([("Old.cshtml",), ("NEW",), ("zz",)], "fragment string")
    got = fragments.clear_fragments(df, ["id"], frame, not_null=("B",))
    assert values(got) == [(1, None, "", 5), (2, "fine", None, 6), (3, None, "", 7)] and got.columns == df.columns
    assert values(fragments.clear_fragments(df, ["id"], frame, keep=("a",)), "id", "a") == values(df, "id", "a")
    census = fragments.fragment_census({"t": (df, ["id"])}, frame)
    assert values(census) == [("t", "a", "Old.cshtml", 1), ("t", "b", "NEW", 1), ("t", "b", "Old.cshtml", 1)]


def test_fifty_thousand_fragments(spark):
    df = spark.range(3000).select(F.col("id"), F.concat(F.lit("see tmpl_"), F.col("id") * 37, F.lit("_x and more")).alias("text"))
    many = spark.range(50_000).select(F.concat(F.lit("tmpl_"), F.col("id"), F.lit("_x")).alias("fragment"))
    got = fragments.fragment_hits(df, ["id"], many)
    assert got.count() == len([i for i in range(3000) if i * 37 < 50_000])
    few = spark.range(5).select(F.concat(F.lit("tmpl_"), F.col("id"), F.lit("_x")).alias("fragment"))
    plans = [len(fragments.fragment_hits(df, ["id"], f)._jdf.queryExecution().analyzed().toString().splitlines()) for f in (few, many)]
    assert plans[0] == plans[1]


def test_any_number_of_path_rules(spark):
    paths = spark.range(2000).select(F.concat(F.lit("/Area/P"), F.col("id"), F.lit("/sub")).alias("p"), F.lit(1).alias("a"))

    def rules(n):
        includes = spark.range(n).select(F.col("id").alias("rule"), F.lit(1).cast("long").alias("area"), F.concat(F.lit("/area/p"), F.col("id") * 2).alias("path"))
        return includes, spark.range(0, n, 3).select(F.col("id").alias("rule"), F.concat(F.lit("/AREA/P"), F.col("id") * 2, F.lit("/SUB")).alias("path"))

    got, few = (tree.filter_paths(paths, "p", "a", rules(n)) for n in (100_000, 2))
    assert got.count() == len([i for i in range(0, 2000, 2) if (i // 2) % 3])
    size = lambda df: len(df._jdf.queryExecution().analyzed().toString().splitlines())
    assert size(got) == size(few)


def test_rules_against_a_loop(spark):
    r = random.Random(6)
    part = lambda: "".join(r.choices("ab", k=r.randint(0, 1)))
    paths = sorted({"/".join(["", *[part() for _ in range(r.randint(0, 4))]]) for _ in range(200)} | {"", "a", "a/b"})
    rules = [PathRule(r.randint(1, 2), r.choice(paths), tuple(r.choices(paths, k=r.randint(0, 2)))) for _ in range(12)]

    def under(path, base):
        return path.startswith("/") if base == "/" else path == base or path.startswith(base + "/")

    df = spark.createDataFrame([(p.upper(), a) for p in paths for a in (1, 2, None)] + [(None, 1)], "p string, a int")
    want = sorted((p.upper(), a) for p in paths for a in (1, 2) if any(a == x.area and under(p, x.path) and not any(under(p, e) for e in x.excludes) for x in rules))
    assert values(tree.filter_paths(df, "p", "a", rules)) == want


def test_runs_that_fragments_share_by_chance_are_not_written(spark, monkeypatch):
    """Cells full of the same short runs: only whole runs of a fragment's own length may be written."""
    text = F.concat(F.lit("the theme then there "), F.col("id"), F.lit(" other mothers bathe; breathe there " * 5))
    df = spark.range(200).select("id", text.alias("text"))
    frame = df.select(F.concat(F.lit("e "), F.col("id") + 150, F.lit(" other m")).alias("fragment"))
    written = []
    monkeypatch.setattr(fragments, "cut", lambda x: written.append(cut(x)) or written[-1])
    hits = fragments.fragment_hits(df, ["id"], frame)
    assert values(hits, "id", "fragment") == sorted(((i, f"e {i} other m") for i in range(150, 200)), key=lambda t: [(True, str(v)) for v in t])
    assert max(t.count() for t in written if "id" in t.columns) <= 3 * 50
    monkeypatch.setattr(fragments, "WORDS", 1)
    assert fragments.fragment_hits(df, ["id"], frame).count() == 50  # a sieve that lets nearly all pass


def test_common_fragments_are_counted_not_written(spark, monkeypatch):
    """Every cell holds every fragment: the census may write a row a fragment, never a row a hit, and fragments that are their own run are searched in no text."""
    df = spark.range(400).select("id", F.concat(F.lit("alpha beta gamma delta "), F.col("id"), F.lit(" alpha beta gamma")).alias("text"))
    frame = spark.range(20).select(F.substring(F.lit("alpha beta gamma delta "), F.col("id").cast("int"), F.lit(7)).alias("fragment")).where("length(fragment) = 7").distinct()
    written = []
    monkeypatch.setattr(fragments, "cut", lambda x: written.append(cut(x)) or written[-1])
    census = fragments.fragment_census({"t": (df, ["id"])}, frame)
    wanted = sorted(r.fragment for r in frame.collect())
    assert len(wanted) > 10 and values(census) == [("t", "text", w, 400) for w in wanted]
    assert max(t.count() for t in written) <= len(wanted)
    assert "Contains" not in fragments.fragment_hits(df, ["id"], frame)._jdf.queryExecution().optimizedPlan().toString()


def test_census_agrees_with_hits_on_odd_rows(spark, rows):
    """Keys that are null or come twice, fragments shorter and longer than a run, characters of one to four bytes, bytes that are no text."""
    long = "a fragment of more than sixteen characters é日𝄞"
    cells = [(1, "é日𝄞 x", long), (1, "é日𝄞 y", "é日𝄞"), (1, "é日𝄞 x", None), (2, f"-{long}-{long}", "É日"), (None, long, long), (3, "", "é日"), (4, "x" * 1_200_000 + "é日𝄞", "x")]
    df = rows(cells, "id int, a string, b string").unionByName(spark.range(9, 10).selectExpr("cast(id as int) id", "cast(unhex('78FFC3A9E697A5') as string) a", "'x' b"))
    frame = rows([(long,), (long[5:25],), ("é日",), ("é日𝄞",), ("x",), ("no such thing, nowhere to be found",)], "fragment string")
    hits = fragments.fragment_hits(df, ["id"], frame)
    census = fragments.fragment_census({"t": (df, ["id"])}, frame)
    assert values(census, "col", "fragment", "n") == values(hits.groupBy("col", "fragment").count())
    got = {(r.col, r.fragment): r.n for r in census.collect()}
    assert got[("a", "é日𝄞")] == 9 + 1 + 1 and got[("a", "é日")] == 9 + 1 + 1 + 1 and got[("a", "x")] == 4 + 1 + 1 + 1  # three rows of key 1, two of them with an x
    assert got[("a", long)] == 1 and got[("b", long)] == 1 and (("b", "É日") not in got)


def test_runs_in_small_steps(monkeypatch):
    """Runs across the places, texts and blocks where the work is cut."""
    r = random.Random(5)
    texts = ["".join(r.choices("ab日𝄞", k=r.randint(0, 30))) for _ in range(60)]
    want = {(i, t[k : k + n]) for i, t in enumerate(texts) for n in (1, 3, 16) for k in range(len(t) - n + 1)}
    full = np.full(4, -1, np.int64).view(np.uint64)
    for chunk, made, block in ((5, 7, 40), (1 << 14, 1 << 20, 1 << 20)):
        for name, size in (("CHUNK", chunk), ("MADE", made), ("BLOCK", block)):
            monkeypatch.setattr(fragments, name, size)
        found = fragments._runs_held(pa.array(texts), [1, 3, 16], full).to_pylist()
        assert len(found) == len(want) and {(f["text"], f["gram"]) for f in found} == want
        batch = pa.record_batch({"id": pa.array(range(60)), "col": pa.array(["a"] * 60), "text": pa.array(texts), "_apart": pa.array([None, True] * 30)})
        pairs = [p for b in fragments._finder(SimpleNamespace(value=full), [3], ["id"], True)(iter([batch, batch.slice(0, 0)])) for p in b.to_pylist()]
        threes = {(i, g) for i, g in want if len(g) == 3}
        assert {(p["id"], p["gram"]) for p in pairs if p["id"] is not None} == {(i, g) for i, g in threes if i % 2}
        assert sum(p["_n"] for p in pairs if p["id"] is None) == len({(i, g) for i, g in threes if i % 2 == 0})
