"""Tables in files: the same rows as the plain merges, and only touched files read and written."""

import hashlib
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import digests, merge, quality
from tablesync.operators.identity import row_checksum
from tablesync.sources.filetable import FileTable
from tablesync.spec import TableSpec

SPEC = TableSpec("t", ("k", "s"))
SCHEMA = "k int, s string, v string, n int"


def made(spark, keys, note="old", n=0):
    return spark.createDataFrame([(k, f"S{k % 3} ", f"{note}{k}", n) for k in keys], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return FileTable.create(made(spark, range(400)), f"{tmp_path}/t", SPEC, rows_per_file=20)


def test_merges_equal_the_plain_ones(spark, table):
    want, rnd = made(spark, range(400)), random.Random(4)
    for step in range(4):
        picked = rnd.sample(range(500), 12)
        incoming = made(spark, picked, f"new{step}-", 7).withColumn("s", F.lower(F.rtrim("s"))).withColumn("k", F.col("k").cast("long"))
        if step == 3:
            incoming = incoming.unionByName(incoming).select("v", "k", "s")
        change = (table.upsert, table.seed_fill)[step % 2](incoming)
        want = merge.upsert(want, incoming, SPEC) if step % 2 == 0 else merge.seed_fill(want, incoming, SPEC).select(*want.columns)
        want = spark.createDataFrame(want.collect(), SCHEMA)
        assert values(table.read()) == values(want) and change.version == step + 1 and change.files_read <= 14
    assert table.versions() == [0, 1, 2, 3, 4] and values(table.read(0)) == values(made(spark, range(400)))
    table.update_subset(made(spark, [5, 999], "patched"), ["v"])
    gone = made(spark, [6, 1000, 7]).select("k", F.upper("s").alias("s"))
    table.remove(gone)
    left = {r.k: r.v for r in table.read().collect()}
    assert left[5] == "patched5" and 999 not in left and 6 not in left and 7 not in left and len(left) == want.count() - 2
    before = values(table.read())
    assert table.compact(1).files_read > 0 and values(table.read()) == before
    counts = table.files().groupBy("bucket").count()
    assert counts.where("count > 1").isEmpty()
    table.expire(1)
    assert len(table.versions()) == 1 and values(table.read()) == before


def test_a_thousand_rows_touch_few_files_of_a_large_table(spark, tmp_path):
    rows = spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    spec = TableSpec("big", ("k",))
    table = FileTable.create(rows, f"{tmp_path}/big", spec, rows_per_file=100)
    total = table.files().count()
    # keys that lie in 40 of the buckets: known ones and new ones
    near = F.pmod(F.xxhash64("k"), F.lit(table.buckets)) < 40
    known = rows.where(near).limit(500).withColumn("v", F.lit("changed"))
    new = spark.range(100_000, 1_000_000).select(F.col("id").alias("k"), F.lit("added").alias("v")).where(near).limit(500)
    incoming = known.unionByName(new)
    read = []
    change = table.change(incoming, lambda old: read.append(old.count()) or merge.upsert(old, incoming, spec))
    assert total > 900 and change.files_read <= 40 and change.files_written <= 40 and change.files_kept == total - change.files_read
    assert read[0] <= 40 * 200
    got = table.read()
    assert got.count() == 100_500 and got.where("v = 'changed'").count() == 500 and got.where("v = 'added'").count() == 500
    # only new keys: hardly a file is read
    fresh = spark.range(2_000_000, 2_000_200).select(F.col("id").alias("k"), F.lit("late").alias("v"))
    change = table.upsert(fresh)
    assert change.files_read <= 40 and table.read().count() == 100_700


def test_broken_off_merges_are_not_read(spark, table):
    before = values(table.read())
    made(spark, [1]).write.parquet(f"{table.root}/data/broken")
    made(spark, [1]).limit(0).write.parquet(f"{table.root}/versions/00000001")
    success = spark._jvm.org.apache.hadoop.fs.Path(f"{table.root}/versions/00000001/_SUCCESS")
    success.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(success, False)
    assert table.versions() == [0] and values(FileTable(spark, table.root).read()) == before
    assert table.upsert(made(spark, [1], "new")).version == 1 and {r.v for r in table.read().where("k = 1").collect()} == {"new1"}


def test_empty_tables_and_no_incoming_rows(spark, tmp_path):
    table = FileTable.create(made(spark, range(3)).limit(0), f"{tmp_path}/e", SPEC)
    assert table.read().count() == 0 and table.read().schema.names == ["k", "s", "v", "n"]
    assert table.upsert(made(spark, range(0)).limit(0)).files_written == 0
    assert table.upsert(made(spark, [1, 2])).files_written == 1 and table.read().count() == 2
    assert table.remove(made(spark, [1, 2])).files_written == 0 and table.read().count() == 0
    with pytest.raises(ValueError):
        FileTable.create(made(spark, [1]), f"{tmp_path}/x", TableSpec("t", ("k",), name_col="v"))


def test_reconciliation_reads_in_proportion_to_the_difference(spark, tmp_path, table):
    other = FileTable.create(made(spark, range(400)), f"{tmp_path}/o", SPEC, rows_per_file=20)
    counts, read = table.reconcile(other)
    assert read == 0 and counts.first().asDict() == dict.fromkeys(digests.COUNTS, 0) | dict.fromkeys(digests.COUNTS[:3], 400)
    other.upsert(made(spark, [3, 4], "changed"))
    other.remove(made(spark, [9]))
    other.upsert(made(spark, [777]))
    counts, read = table.reconcile(other)
    plain = quality.reconcile(table.read(), other.read(), SPEC)
    assert values(counts, *digests.COUNTS) == values(plain, *digests.COUNTS) and read <= 10
    by_digest = digests.reconcile_by_digest(table.read(), other.read(), SPEC, buckets=5000)
    assert values(by_digest, *digests.COUNTS) == values(plain, *digests.COUNTS)


def test_digests_do_not_depend_on_order_and_add_up(spark):
    rows = made(spark, range(50))
    one = values(digests.key_digests(rows, SPEC, rows.columns, 7))
    parts = digests.key_digests(rows.where("k < 20"), SPEC, rows.columns, 7).unionByName(digests.key_digests(rows.where("k >= 20"), SPEC, rows.columns, 7))
    assert one == values(parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in digests.SUMS])) == values(digests.key_digests(rows.orderBy("v"), SPEC, rows.columns, 7))
    root = digests.digest_tree(digests.key_digests(rows, SPEC, rows.columns, 7), 7).where("level = 0").first()
    assert root["rows"] == 50 and digests.unequal_buckets(*[digests.digest_tree(digests.key_digests(rows, SPEC, rows.columns, 7), 7)] * 2).isEmpty()


def largest_job(spark, group, run):
    """The number of tasks of the largest stage that ``run`` starts, and what it returns."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        got = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds]
    return max((i.numTasks for i in map(sc.statusTracker().getStageInfo, stages) if i), default=0), got


def test_many_files_are_listed_by_few_tasks_and_many_keys_name_their_files_early(spark, tmp_path, monkeypatch):
    spec, rows = TableSpec("t", ("k",)), spark.range(6000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    table = FileTable.create(rows, f"{tmp_path}/many", spec, rows_per_file=100)
    files, before = table.files().count(), spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    most, read = largest_job(spark, "listing", table.read)
    assert files == 60 > 32 >= most and read.count() == 6000
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    asked, plain = [], FileTable._named
    monkeypatch.setattr(FileTable, "_named", staticmethod(lambda keys, *rest: asked.append(keys.count()) or plain(keys, *rest)))
    # all keys: every file is named at last, some by a few keys; what is looked up first is a small part
    assert table.candidates(rows).count() == 60 and 0 < asked[0] < 6000 / 20
    # one key that is not among those looked up first still names its file
    later = rows.where(F.pmod(F.xxhash64(F.xxhash64("k"), F.lit("first")), F.lit(64)) != 0).limit(1).select("k")
    own = table.read().select("k", F.col("_metadata.file_path").alias("path")).join(later, "k").first()["path"]
    assert any(own.endswith(r.file) for r in table.candidates(later).collect())
    # keys to be removed are computed once
    computed = spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            computed.add(len(p))
            yield p

    table.remove(rows.select("k").where("k < 500").mapInPandas(counted, "k long"))
    assert computed.value == 500 and table.read().count() == 5500 and table.read().where("k < 500").isEmpty()


def test_ranges_of_keys_need_no_sort_and_hold_rows_without_a_key(spark, tmp_path):
    days = spark.createDataFrame([(None, "a"), ("2020-01-02", "b"), ("2021-01-02", "c")], "d string, v string").select(F.col("d").cast("date").alias("d"), "v")
    numbers = spark.createDataFrame([(None, "a"), (-3, "b"), (7, "c")], "n long, v string")
    # dates have no default: rows without one stay, and match no other
    for rows, key, low, values_ in ((days, "d", None, ["a", "b", "c", "new"]), (numbers, "n", -3, ["b", "c", "new"])):
        table = FileTable.create(rows, f"{tmp_path}/{key}", TableSpec("t", (key,)))
        assert table.files().first()["low"][0] == low
        table.upsert(rows.where(F.col(key).isNull()).withColumn("v", F.lit("new")))
        assert sorted(r.v for r in table.read().collect()) == values_
    plan = numbers.groupBy("v").agg(*table._ranges(numbers))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_sums_of_digests_are_exact(spark):
    sums = ["f" * 32, "f" * 32, "8" + "0" * 15 + "7" + "f" * 15, "0" * 32, "0123456789abcdef" * 2]
    got = spark.createDataFrame([(s,) for s in sums], "m string").agg(*digests.digest_sums(F.col("m"))).first()
    assert [int(v) for v in got] == [5, sum(int(s[:16], 16) for s in sums), sum(int(s[16:], 16) for s in sums)]


def test_blank_cells_and_numbers_in_checksums(spark):
    rows = spark.createDataFrame([(None, None, None), (0, " 　\t", 1.5), (5, " a ", float("nan"))], "n int, s string, x double")
    got = [r[0] for r in rows.select(row_checksum(rows, TableSpec("t", ("n",)))).collect()]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("N=|S=|X=", "N=0|S=|X=1.5", "N=5|S= a |X=NaN")]
