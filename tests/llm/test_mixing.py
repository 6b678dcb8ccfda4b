from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesync.llm.mixing import mix, mixed, source_targets, uniform

SCHEMA = "doc_id long, text string, source string, size int, target string"


def fill(sizes, cycle=(1, 2, 3), most=3):
    """Targets by sharing again and again what is over a cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_are_those_of_sharing_again(rows):
    for sizes in ({"b": 10, "a": 1, "é": 500, "z": 7, None: 80}, {"a": 5}, {"a": 0, "b": 9, "c": 1}, {"a": 1, "b": 1, "c": 1, "d": 10_000, "B": 3}):
        got = source_targets(rows(list(sizes.items()), "source string, source_size long")).collect()
        want = fill(sizes)
        assert {r.source: pytest.approx(want[r.source]) for r in got} == {r.source: r.target for r in got}


def corpus(n=3000):
    out = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else None if k % 31 == 0 else f"s{k % 7}"
        out.append((k, "w " * (1 + k * 7919 % 90 + (900 if k % 97 == 0 else 0)), source, 1, "t"))
    return out + [(n, None, "hot", 1, "t"), (n + 1, "", "only empty", 1, "t"), (n + 2, "a\x0bb\x1cc d", "s1", 1, "t")]


def test_sources_come_near_their_targets_and_reruns_agree(spark, rows):
    docs = rows(corpus(), SCHEMA)
    got = mix(docs).collect()
    words, taken = Counter(), Counter()
    for r in got:
        words[r.source] += r.size
        taken[r.source] += r.taken
        assert r.copies <= 3 and r.taken == r.copies * r.size
    want = fill(words)
    for s in words:
        assert taken[s] == pytest.approx(want[s], rel=0.01, abs=5)
    assert {r.source: r.source_size for r in got} == dict(words)
    assert sum(want.values()) == pytest.approx(sum(words.values()))
    again = mix(docs.repartition(13)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    assert {r.size for r in got if r.doc_id == 3002} == {2}
    assert len({r.copies for r in got if r.source == "hot"}) <= 2


@pytest.mark.parametrize("long, gap", [(150_000, 45_000), (75_000, 70_000)])
def test_short_documents_close_the_gap_of_a_very_long_one(spark, long, gap):
    """The long text comes late in the sample and does not fit: thousands of short ones take its place."""
    need, other = 400_000, 1_200_000 - 19_999 * 30 - long
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"))
    at = ids.orderBy(uniform(F.col("doc_id"))).collect()[(need - gap) // 30].doc_id
    text = F.repeat(F.lit("w "), F.when(F.col("doc_id") == at, long).otherwise(30).cast("int"))
    docs = ids.select("doc_id", text.alias("text"), F.lit("a").alias("source"))
    docs = docs.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("doc_id"), F.repeat(F.lit("w "), other).alias("text"), F.lit("b").alias("source")))
    got = mix(docs).where("source = 'a'").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).first()
    assert got.target == need and got.taken == pytest.approx(need, abs=30)


def test_the_sql_beside_the_query_with_thousands_of_fillers(spark, tmp_path):
    """The query's SQL states the same rule: here some 1,500 short documents close a gap."""
    import duckdb

    from tablesync.llm.queries import CASES

    need, gap, long = 400_000, 45_000, 150_000
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"))
    at = ids.orderBy(uniform(F.col("doc_id"))).collect()[(need - gap) // 30].doc_id
    docs = ids.select("doc_id", F.repeat(F.lit("w "), F.when(F.col("doc_id") == at, long).otherwise(30).cast("int")).alias("text"), F.lit("a").alias("source"))
    other = F.repeat(F.lit("w "), 1_200_000 - 19_999 * 30 - long)
    docs = docs.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("doc_id"), other.alias("text"), F.lit("b").alias("source")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    case = CASES["op9_source_mixing"]
    want = sorted(con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({case.sql}) q").fetchall())
    got = sorted(tuple(r) for r in case.run(spark, str(tmp_path)).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == want and sum(r[4] for r in got if r[0] >= 0) > need - 60


def test_documents_are_repeated_as_often_as_taken(rows):
    docs = rows(corpus(300), SCHEMA)
    want = Counter({r.doc_id: r.copies for r in mix(docs).collect() if r.copies})
    got = mixed(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "target"]
    assert Counter(r.doc_id for r in got.collect()) == want


def test_edges(rows):
    assert mix(rows([], SCHEMA)).count() == 0
    empty = mix(rows([(1, None, "a", 1, ""), (2, "", None, 1, "")], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2
    one = mix(rows([(None, "a b", "a", 1, "")] * 3, SCHEMA)).collect()
    assert [(r.target, r.taken) for r in one] == [(6.0, 2)] * 3


def test_only_built_in_operators_run(rows):
    plan = mix(rows(corpus(30), SCHEMA)).select(F.col("taken"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
