import json
import time

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators import placement
from tablesync.operators.integrity import dependency_levels
from tablesync.operators.merge import dedupe_incoming
from tablesync.plans.apply import apply_snapshot
from tablesync.sources import rowfiles, tables
from tablesync.spec import SyncSpec, TableSpec

FILE = (
    '\ufeff"Code": "B-7"\r\nlabel: \'it\'\'s: fine\'\r\n"Rank": 12\r\n"Live": true\r\n"Icon": \r\n"Blank": ""\r\n'
    '"Text": |-\r\n  one\r\n    two\r\n\r\n  "three": 3\r\n"Quote": "say \\"hi\\" \\\\ bye"\r\n"Gone": ~\r\n"Other": x\r\n'
)


def test_row_files(spark, tmp_path):
    folder = tmp_path / "rows" / "Badge"
    folder.mkdir(parents=True)
    (folder / "a.yml").write_text(FILE, encoding="utf8", newline="")
    (folder / "b.yml").write_text('"Code": "C-8"\n"Rank": many\n"Label":\n  nested: 1\n  more: 2\n"Icon": [1, 2]\n')
    (folder / "_meta.yml").write_text('"Code": "none"\n')
    goal = T.StructType()
    for name, kind in (("Code", "string"), ("Label", "string"), ("Rank", "integer"), ("Live", "boolean"), ("Icon", "string"), ("Blank", "string"), ("Text", "string"), ("Quote", "string"), ("Gone", "string")):
        goal = goal.add(name, kind)
    df, rejects = rowfiles.read_row_files(spark, str(folder.parent), goal)
    a = df.where("Code = 'B-7'").first()
    assert tuple(a)[1:] == ("B-7", "it's: fine", 12, True, None, "", 'one\n  two\n\n"three": 3', 'say "hi" \\ bye', None)
    assert df.count() == 2 and sorted(r.col for r in rejects.collect()) == ["Rank", "icon", "label"]
    assert dedupe_incoming(df, ["Code"], "_path").count() == 2


def test_run_logs(spark, tmp_path):
    summary = {"operation": "apply", "timestamp": "2026-01-02T03:04:05", "dryRun": True, "totalCreated": 3,
               "predicates": [{"name": "p", "table": "T", "created": 3}], "advice": ["do it"]}
    (tmp_path / "old.log").write_text("plain text\n")
    time.sleep(1.1)
    (tmp_path / "new.log").write_text(f"=== RUN SUMMARY ===\n{json.dumps(summary, indent=2)}\n=== END SUMMARY ===\n[t] line 1\nline 2\n")
    got = rowfiles.read_run_logs(spark, str(tmp_path)).collect()
    assert [r["file_name"] for r in got] == ["new.log", "old.log"]
    assert got[0]["summary"]["totalCreated"] == 3 and got[0]["summary"]["predicates"][0]["table"] == "T"
    assert got[1]["summary"] is None
    lines = rowfiles.read_log_lines(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in lines) == [("new.log", 1, "[t] line 1"), ("new.log", 2, "line 2"), ("old.log", 1, "plain text")]


def test_a_long_log_stays_lines_in_order(spark, tmp_path):
    (tmp_path / "long.log").write_text("=== RUN SUMMARY ===\n{}\n" + "".join(f"line {i}\n" for i in range(30_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        lines = rowfiles.read_log_lines(spark, str(tmp_path)).collect()
        assert rowfiles.read_run_logs(spark, str(tmp_path)).first()["summary"] is None  # never closed
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    text = {r.line_no: r.line for r in lines}
    assert len(lines) == 30_002 and text[3] == "line 0" and all(text[i + 3] == f"line {i}" for i in range(30_000))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_round_trip_is_identical(spark, rows, tmp_path, fmt):
    df = rows([("a", "<S><A>1</A><Secret>x</Secret></S>", 1, 5), ("b", None, None, 6)], "k string, x string, n int, drop_me int")
    spec = SyncSpec(TableSpec("T", ("k",)), exclude=("DROP_ME",), xml_text_cols=("x",), drop_elements=("secret",))
    tables.write_snapshot(df, spec, f"{tmp_path}/one", fmt)
    first = tables.read_snapshot(spark, f"{tmp_path}/one", fmt)
    assert values(first, "k", "n") == [("a", 1), ("b", None)] and "Secret" not in first.where("k = 'a'").first()["x"]
    empty = df.where("false").drop("drop_me")
    applied = apply_snapshot(empty, first, spec)
    assert {r["column_name"] for r in applied.warnings.collect()} == {"_identity"}
    tables.write_snapshot(applied.table, spec, f"{tmp_path}/two", fmt)
    assert values(tables.read_snapshot(spark, f"{tmp_path}/two", fmt)) == values(first)
    _, table = tables.read_schema(spark, f"{tmp_path}/one/_meta")
    assert table == TableSpec("T", ("k",))


def test_read_table_pushes_the_condition(spark, rows, tmp_path):
    rows([(1, "a"), (2, "b")], "k int, v string").write.parquet(f"{tmp_path}/t")
    df = tables.read_table(spark, f"{tmp_path}/t", "k = 2")
    assert values(df) == [(2, "b")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,2)" in plan


def test_backup_and_purge(spark, rows, tmp_path):
    paths = {n: f"{tmp_path}/{n}" for n in ("parent", "child")}
    for p in paths.values():
        rows([(1,), (2,)], "k int").write.parquet(p)
    report = tables.backup_tables(spark, {n: spark.read.parquet(p) for n, p in paths.items()}, f"{tmp_path}/bak", "d1")
    assert values(report) == [("child", 2, 2), ("parent", 2, 2)]
    edges = rows([("child", "parent")], "child string, parent string")
    levels = dependency_levels(rows([("parent",), ("child",)], "name string"), edges)
    assert tables.purge_tables(spark, paths, levels) == ["child", "parent"]
    assert spark.read.parquet(paths["child"]).count() == 0 and spark.read.parquet(f"{tmp_path}/bak/child_d1").count() == 2


def test_cut_goes_to_the_shared_folder(spark, rows):
    df = placement.cut(rows([(1, {"a": None})], "k int, m map<string,string>"))
    folder = placement.work_dir(spark)
    assert df.first()["m"] == {"a": None} and all(folder.split(":")[-1] in f for f in df.inputFiles())
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert not shared or folder.startswith(shared)
    assert placement.cut(df.where(F.lit(False))).count() == 0


def test_many_small_files_take_few_tasks(spark, tmp_path):
    from checks.tables import one_file_per_row

    text = spark.range(3_000, numPartitions=1).select(F.format_string("k: %d", "id").alias("value"))
    folder = one_file_per_row(spark, text)
    written = spark.read.text(folder).select(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).alias("task"))
    assert written.distinct().count() > 8  # tasks that wrote
    got = rowfiles.read_row_files(spark, folder, T.StructType().add("k", "long"), "*.txt")[0]
    assert got.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism < 3_000 / 32
    assert got.agg(F.sum("k")).first()[0] == 3_000 * 2_999 // 2
