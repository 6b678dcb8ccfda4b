from collections import defaultdict

from conftest import values
from pyspark.sql import functions as F

from tablesync.llm.exact import LOWER, UPPER, exact_duplicates

SCHEMA = "doc_id long, text string, digest int, body string, salt string"


def brute(rows):
    groups = defaultdict(list)
    low = str.maketrans(UPPER, LOWER)
    for i, text, *_ in rows:
        groups[(text or "").translate(low)].append(i)
    out = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=str)


ROWS = [
    (1, "Same", 1, "a", "b"), (2, "sAME", 1, None, "b"), (5, "same", 1, "a", "b"), (3, "same ", 1, "a", "b"), (4, "É", 0, "", ""),
    (6, "é", 0, "", ""), (7, None, 0, "", ""), (8, "", 0, "", ""), (None, "same", 0, "", ""), (None, "alone", 0, "", ""),
    (9, "x" * 300_000, 0, "", ""), (10, "X" * 300_000, 0, "", ""), (10, "X" * 300_000, 0, "", ""),
]


def test_groups(rows):
    got = exact_duplicates(rows(ROWS, SCHEMA)).drop("digest")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_content_decides_where_digests_clash(rows):
    # a digest that many texts share: their lengths
    got = exact_duplicates(rows(ROWS, SCHEMA), digest=lambda t: F.length(t).cast("string")).drop("digest")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_a_large_group_over_many_tasks(spark):
    docs = spark.range(0, 20_000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "Copy").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_duplicates(docs)
    assert got.where("kept").count() == 6667 + 1
    assert values(got.where("group_size > 1").select("keep_id", "group_size").distinct()) == [(19_999, 13_333)]


def test_no_documents(rows):
    assert exact_duplicates(rows([], SCHEMA)).count() == 0


def test_only_built_in_operators_run(rows):
    plan = exact_duplicates(rows(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
