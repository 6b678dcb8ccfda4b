import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.unset import is_unset
from tablesync.operators import merge, selection
from tablesync.plans.apply import apply_snapshot
from tablesync.plans.content import apply_by_guid
from tablesync.spec import DESTINATION_WINS, SyncSpec, TableSpec

FLOW = "id string, name string, note string"
FLOW_SPEC = TableSpec("flow", ("id",), "name", auto_cols=("id",))


def outcomes(df):
    return values(df, "id", "outcome")


def test_upsert_updates_inserts_and_keeps(rows):
    target = rows([(1, "a", "x"), (2, "b", "y")], "id int, name string, note string")
    incoming = rows([(2, "B"), (3, "c")], "ID int, NAME string")
    got = merge.upsert(target, incoming, TableSpec("t", ("id",)))
    assert values(got) == [(1, "a", "x"), (2, "B", "y"), (3, "c", None)]


def test_upsert_can_null_a_column(rows):
    target = rows([(1, "a")], "id int, name string")
    got = merge.upsert(target, rows([(1, None)], "id int, name string"), TableSpec("t", ("id",)))
    assert values(got) == [(1, None)]


def test_upsert_null_text_key_is_empty_text(rows):
    target = rows([("", "a")], "id string, name string")
    got = merge.upsert(target, rows([(None, "b")], "id string, name string"), TableSpec("t", ("id",)))
    assert values(got) == [("", "b")]


def test_upsert_auto_number_is_not_written_unless_key(rows):
    target = rows([("a", 1, "x")], "k string, auto int, v string")
    incoming = rows([("a", 50, "y"), ("b", 60, "z")], "k string, auto int, v string")
    got = merge.upsert(target, incoming, TableSpec("t", ("k",), auto_cols=("auto",)))
    assert values(got) == [("a", 1, "y"), ("b", None, "z")]
    got = merge.upsert(target, incoming, TableSpec("t", ("auto",), auto_cols=("auto",)))
    assert len(values(got)) == 3


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_upsert_same_with_small_and_large_incoming(rows, spark, limit):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        target = rows([(i, f"t{i}") for i in range(50)], "id int, v string")
        incoming = rows([(i, f"s{i}") for i in range(40, 60)], "id int, v string")
        got = dict(values(merge.upsert(target, incoming, TableSpec("t", ("id",)))))
        assert len(got) == 60 and got[39] == "t39" and got[40] == "s40" and got[59] == "s59"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "target, incoming, outcome, result, filled",
    [
        (("1", "Flow", None), ("1", "Flow", "seed"), "updated", ("1", "Flow", "seed"), "note"),
        (("1", "Flow", "mine"), ("1", "Flow", "seed"), "skipped", ("1", "Flow", "mine"), ""),
        (("1", "Flow", ""), ("1", "Flow", "seed"), "updated", ("1", "Flow", "seed"), "note"),
        (("1", "Flow", " "), ("1", "Flow", "seed"), "skipped", ("1", "Flow", " "), ""),
        (("1", "Flow", "same"), ("1", "Flow", "same"), "skipped", ("1", "Flow", "same"), ""),
    ],
)
def test_seed_fill_known_row(rows, target, incoming, outcome, result, filled):
    # A separate name column, and a key that is the name: both ways give the same answer.
    for spec in (TableSpec("flow", ("id",), "name"), TableSpec("flow", ("name",), "name"), TableSpec("flow", ("id",))):
        got = merge.seed_fill(rows([target], FLOW), rows([incoming], FLOW), spec).collect()
        assert len(got) == 1 and tuple(got[0])[:3] == result and got[0]["filled"] == filled
        if spec.goes_by_key:
            assert got[0]["outcome"] == outcome


def test_seed_fill_unknown_identity_with_known_key_overwrites(rows):
    target = rows([("1", "Old name", "mine")], FLOW)
    got = merge.seed_fill(target, rows([("1", "New name", "seed")], FLOW), TableSpec("flow", ("id",), "name"))
    assert values(got, "id", "name", "note", "outcome") == [("1", "New name", "seed", "updated")]


def test_seed_fill_by_name_writes_to_the_named_row(rows):
    target = rows([("1", "Flow", ""), ("2", "Other", "x")], FLOW)
    got = merge.seed_fill(target, rows([("9", "flow", "seed")], FLOW), TableSpec("flow", ("id",), "name"))
    assert values(got, "id", "name", "note") == [("1", "Flow", "seed"), ("2", "Other", "x")]


def test_seed_fill_inserts_unmatched(rows):
    got = merge.seed_fill(rows([("1", "a", "x")], FLOW), rows([("2", "b", "y")], FLOW), TableSpec("flow", ("id",)))
    assert values(got, "id", "note", "outcome") == [("1", "x", "kept"), ("2", "y", "created")]


def test_seed_fill_counts_an_empty_seed_as_fill(rows):
    target = rows([("1", "a", None)], FLOW)
    got = merge.seed_fill(target, rows([("1", "b", "")], FLOW), TableSpec("flow", ("id",)))
    assert got.first()["outcome"] == "updated" and got.first()["filled"] == "note"


def test_would_fill_lists_cells(rows):
    schema = "id string, xml string, note string"
    got = values(merge.would_fill(rows([("1", "", "")], schema), rows([("1", "<a/>", "hello")], schema), TableSpec("t", ("id",))))
    assert got == [("1", "note", "hello"), ("1", "xml", "<a/>")]


def test_seed_fill_fills_struct_members(rows):
    schema = "id int, seo struct<title:string,descr:string>"
    target = rows([(1, ("", "own")), (2, None), (3, ("t", "d")), (4, (None, ""))], schema)
    seed = rows([(1, ("T", "D")), (2, ("T", "D")), (3, ("T", "D")), (4, None)], schema)
    got = {r.id: (r.seo and tuple(r.seo), r.outcome) for r in merge.seed_fill(target, seed, TableSpec("t", ("id",))).collect()}
    assert got == {1: (("T", "own"), "updated"), 2: (("T", "D"), "updated"), 3: (("t", "d"), "skipped"), 4: ((None, ""), "skipped")}


REPEATED = [(1, "a", "2.yml"), (1, "b", "3.yml"), (1, "c", "1.yml"), (5, "e", "9.yml"), (5, "d", "8.yml")]


@pytest.mark.parametrize("shuffled", [0, 1, 2])
def test_repeated_incoming_keys_do_not_multiply_rows(rows, shuffled):
    data = list(REPEATED)
    random.Random(shuffled).shuffle(data)
    target, inc = rows([(1, "old"), (2, "kept")], "id int, v string"), rows(data, "id int, v string, path string")
    spec = TableSpec("t", ("id",))
    assert values(merge.upsert(target, inc, spec, "path")) == [(1, "b"), (2, "kept"), (5, "e")]
    assert values(merge.update_subset(target, inc, ["id"], ["v"], "path")) == [(1, "b"), (2, "kept")]
    assert values(merge.seed_fill(rows([(1, "")], "id int, v string"), inc, spec, "path"), "id", "v") == [(1, "b"), (5, "e")]
    by_name = TableSpec("t", ("id",), "v")
    assert values(merge.merge_rows(target, inc, by_name, order="path"), "id", "v") == [(1, "b"), (2, "kept"), (5, "e")]
    for s in (spec, by_name):
        done = apply_snapshot(target, inc, SyncSpec(s), order="path")
        total = done.summary().where("table_name = '(total)'").first()
        assert (total["created"], total["updated"], total["skipped"]) == (1, 1, 3)
        assert values(done.table) == [(1, "b"), (2, "kept"), (5, "e")]
    # without an order the content decides, always in the same way
    assert values(merge.upsert(target, inc, spec)) == values(merge.upsert(target, rows(REPEATED, "id int, v string, path string"), spec))


def test_many_rows_of_one_key_are_counted(spark, rows):
    inc = spark.range(25_001).selectExpr("1 as id", "cast(id as string) as v")
    done = apply_snapshot(rows([], "id int, v string"), inc, SyncSpec(TableSpec("t", ("id",))))
    assert done.table.count() == 1 and done.outcomes.count() == 25_001


def test_replace_all_keeps_auto_numbers(rows):
    target = rows([(1, "old", "z")], "auto int, v string, other string")
    assert values(merge.replace_all(target, rows([(7, "new")], "AUTO int, v string"))) == [(7, "new", None)]


def test_update_subset(rows):
    target = rows([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    patch = rows([(2, None, "n")], "id int, V string, w string")
    assert values(merge.update_subset(target, patch, ["id"], ["v"])) == [(1, "a", "x"), (2, None, "y")]
    assert merge.update_subset(target, patch, ["id"], []) is target


def test_diff_rows(rows):
    target = rows([(1, "a", 5), (2, "b", None)], "id int, v string, n int")
    incoming = rows([(1, "A", 5), (2, "b", 7), (3, "c", 1)], "id int, v string, n int")
    got = merge.diff_rows(target, incoming, TableSpec("t", ("id",)))
    assert values(got) == [(1, "v", "a", "A"), (2, "n", None, "7")]


def test_dedupe_last_path_wins(rows):
    df = rows([(1, "a.yml", "x"), (1, "b.yml", None), (2, "a.yml", "z")], "id int, path string, v string")
    assert values(merge.dedupe_incoming(df, ["id"], "path")) == [(1, "b.yml", None), (2, "a.yml", "z")]


def test_unset_rules(rows):
    schema = (
        "s string, i int, l bigint, d decimal(9,2), f double, b boolean, day date, ts timestamp, bin binary, guid string"
    )
    unset = rows([("", 0, 0, 0, 0.0, False, None, None, None, None)], schema.replace("decimal(9,2)", "int"))
    unset = unset.withColumn("d", F.col("d").cast("decimal(9,2)"))
    unset = unset.withColumn("day", F.expr("date'0001-01-01'")).withColumn("ts", F.expr("timestamp'0001-01-01 00:00:00'"))
    unset = unset.withColumn("guid", F.lit("00000000-0000-0000-0000-000000000000"))
    kinds = {f.name: f.dataType for f in unset.schema.fields}
    flags = [is_unset(F.col(c), kinds[c], "uniqueidentifier" if c == "guid" else None).alias(c) for c in kinds]
    assert all(unset.select(*flags).first())
    filled = rows([(" ", 1, -1, 1, 0.5, True, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), b"", "x")], schema.replace("decimal(9,2)", "int"))
    filled = filled.withColumn("d", F.col("d").cast("decimal(9,2)"))
    assert not any(filled.select(*flags).first())


def test_unset_offset_date_only_null(rows):
    df = rows([(1,)], "x int").select(F.expr("timestamp'0001-01-01 00:00:00'").alias("t"))
    assert df.select(is_unset(F.col("t"), T.TimestampType(), "datetimeoffset").alias("u")).first()["u"] is False


def test_fields_overwrite_and_fill(rows):
    schema = "id int, f map<string,string>"
    target = rows([(1, {"a": "1", "b": "2", "keep": "k", "Id": "7"}), (2, {"z": "1"})], schema)
    source = rows([(1, {"a": "9", "Sort": "5", "new": "n"})], schema)
    got = {r["id"]: r["f"] for r in selection.overwrite_fields(target, source, ["id"], "f", exclude=["KEEP"]).collect()}
    assert got == {1: {"a": "9", "new": "n", "b": None, "keep": "k", "Id": "7"}, 2: {"z": "1"}}
    target = rows([(1, {"a": "", "b": "2", "c": None})], schema)
    source = rows([(1, {"a": "A", "b": "B", "c": "C", "d": "D", "e": "E", "id": "9"})], schema)
    r = selection.fill_fields(target, source, ["id"], "f", exclude=["E"]).first()
    assert r["f"] == {"a": "A", "b": "2", "c": "C", "d": "D"} and (r["n_filled"], r["n_left"]) == (3, 1)


def test_fill_fields_into_missing_map(rows):
    schema = "id int, f map<string,string>"
    r = selection.fill_fields(rows([(1, None)], schema), rows([(1, {"a": "A"})], schema), ["id"], "f").first()
    assert r["f"] == {"a": "A"} and (r["n_filled"], r["n_left"]) == (1, 0)
    r = selection.fill_fields(rows([(1, {"a": ""})], schema), rows([], schema), ["id"], "f").first()
    assert r["f"] == {"a": ""} and (r["n_filled"], r["n_left"]) == (0, 0)


PAGE = (
    "guid string, parent int, menu string, active boolean, active_from date, "
    "seo struct<title:string,noindex:boolean>, nav struct<use:boolean,groups:string,shop:string>"
)


def test_fill_scalars(rows):
    day = dt.date(2024, 1, 1)
    target = rows(
        [
            ("a", 1, "", False, None, ("T", False), None),
            ("b", 1, "m", True, day, None, (True, "", "S")),
            ("c", 1, "", False, None, None, None),
        ],
        PAGE,
    )
    source = rows(
        [
            ("A", 5, "M", True, None, ("X", True), (True, "g", "s")),
            ("b", 6, "M", True, day, None, (True, "g", "s")),
            ("d", 7, "n", True, None, None, None),
        ],
        PAGE,
    )
    got = merge.fill_scalars(
        target, source, ["guid"], ["menu", "active"], {"seo": ["title", "noindex"], "nav": ["groups", "shop"]},
        always=["parent"], when_present=["active_from"], whole_if_missing=("nav",), enabled_by={"nav": "use"},
    )
    r = {x["guid"]: x for x in got.collect()}
    assert (r["a"]["menu"], r["a"]["active"], tuple(r["a"]["seo"]), tuple(r["a"]["nav"])) == ("M", True, ("T", True), (True, "g", "s"))
    assert (r["a"]["n_filled"], r["a"]["n_left"], r["a"]["parent"], r["a"]["outcome"]) == (4, 1, 5, "updated")
    assert tuple(r["b"]["nav"]) == (True, "g", "S") and r["b"]["seo"] is None
    assert (r["b"]["n_filled"], r["b"]["n_left"]) == (1, 4)
    assert r["c"]["outcome"] == "kept" and r["c"]["n_filled"] == 0 and "d" not in r


def test_apply_snapshot_end_to_end(rows):
    target = rows([(1, "a", 5, "<A />"), (2, "b", 6, "<A />")], "id int, name string, n int, x string")
    incoming = rows(
        [
            ("1", "a", "5", "<A />", "?", "1.yml"),
            ("2", "see Default.aspx?ID=3#4", "oops", "<A><B>1</B></A>", "?", "2.yml"),
            ("3", "first", "1", None, "?", "3.yml"),
            ("3", "last", "1,000", None, "?", "4.yml"),
            ("", "no key", "1", None, "?", "5.yml"),
        ],
        "ID string, name string, n string, x string, drifted string, path string",
    )
    spec = SyncSpec(TableSpec("t", ("id",)), link_cols=("name",))
    ids = lambda *p: rows(list(p), "source_id int, target_id int")
    got = apply_snapshot(target, incoming, spec, page_map=ids((3, 33)), para_map=ids((4, 44)), order="path")
    assert values(got.table) == [
        (0, "no key", 1, None),
        (1, "a", 5, "<A />"),
        (2, "see Default.aspx?ID=33#44", None, "<A><B>1</B></A>"),
        (3, "last", None, None),
    ]
    total = got.summary().where("table_name = '(total)'").first()
    assert (total["created"], total["updated"], total["skipped"], total["failed"]) == (2, 1, 2, 0)
    assert {r["col"] for r in got.rejects.collect()} == {"n"}
    assert [r["column_name"] for r in got.warnings.collect()] == ["drifted"]


def test_apply_fails_rows_whose_key_has_no_value(rows):
    target = rows([], "day date, v string")
    got = apply_snapshot(target, rows([("junk", "a"), ("2024-01-02", "b")], "day string, v string"), SyncSpec(TableSpec("t", ("day",))))
    total = got.summary().where("table_name = '(total)'").first()
    assert (total["created"], total["failed"]) == (1, 1) and values(got.table, "v") == [("b",)]


def test_apply_keyless_replaces(rows):
    got = apply_snapshot(rows([("x",)], "v string"), rows([("a",), ("b",)], "v string"), SyncSpec(TableSpec("t")))
    assert values(got.table) == [("a",), ("b",)] and got.summary().first()["created"] == 2


def test_apply_keyless_rewrites_links(rows):
    spec = SyncSpec(TableSpec("t"), link_cols=("v",))
    ids = rows([(3, 33)], "source_id int, target_id int")
    got = apply_snapshot(rows([("x",)], "v string"), rows([("Default.aspx?ID=3",), ("Default.aspx?ID=3",), ("3",)], "v string"), spec, page_map=ids)
    assert values(got.table) == [("33",), ("Default.aspx?ID=33",), ("Default.aspx?ID=33",)]


def _random_pair(rows, seed):
    r = random.Random(seed)
    cell = lambda: r.choice([None, "", " ", "x", "y", "Z"])
    make = lambda n: [(k, cell(), r.choice([None, 0, 1]), r.choice([None, True, False])) for k in r.sample(range(20), n)]
    schema = "id int, s string, n int, b boolean"
    return rows(make(12), schema), rows(make(12), schema)


@pytest.mark.parametrize("seed", range(4))
def test_law_second_apply_skips_everything(rows, seed):
    target, incoming = _random_pair(rows, seed)
    spec = SyncSpec(TableSpec("t", ("id",)))
    once = apply_snapshot(target, incoming, spec).table
    twice = apply_snapshot(once, incoming, spec)
    assert {r["outcome"] for r in twice.outcomes.collect()} == {"skipped"}
    assert values(twice.table) == values(once)


@pytest.mark.parametrize("seed", range(4))
def test_law_seed_fill_never_changes_a_set_cell(rows, seed):
    target, incoming = _random_pair(rows, seed + 100)
    got = {r["id"]: r for r in apply_snapshot(target, incoming, SyncSpec(TableSpec("t", ("id",))), DESTINATION_WINS).table.collect()}
    for r in target.collect():
        for c in ("s", "n", "b"):
            if r[c] not in (None, "", 0, False):
                assert got[r["id"]][c] == r[c]


def test_content_apply_by_guid(rows):
    schema = "id int, parent int, guid string, area int, name string"
    target = rows([(50, None, "AA", 1, "old"), (51, None, "bb", 2, "other area")], schema)
    incoming = rows([(1, None, "aa", 1, "root"), (2, 1, "bb", 1, "child"), (3, 2, "cc", 1, "leaf")], schema)
    table, ids = apply_by_guid(target, incoming, "id", "guid", "area", "parent")
    got = {(r["area"], r["name"]): r for r in table.collect()}
    known = {r["source_id"]: r["target_id"] for r in ids.collect()}
    assert known[1] == 50 and sorted(known.values()) == [50, 52, 53]
    assert got[1, "root"]["outcome"] == "updated" and got[1, "root"]["id"] == 50
    assert got[1, "child"]["parent"] == 50 and got[1, "leaf"]["parent"] == got[1, "child"]["id"]
    assert got[2, "other area"]["outcome"] == "kept"


def test_content_seed_keeps_set_fields_but_moves(rows):
    schema = "id int, parent int, guid string, area int, name string, note string"
    target = rows([(50, None, "aa", 1, "mine", ""), (60, None, "rr", 1, "root", "")], schema)
    incoming = rows([(9, None, "rr", 1, "root", ""), (1, 9, "aa", 1, "seed", "seed")], schema)
    table, _ = apply_by_guid(target, incoming, "id", "guid", "area", "parent", strategy=DESTINATION_WINS)
    r = table.where("id = 50").first()
    assert (r["name"], r["note"], r["parent"]) == ("mine", "seed", 60)


def test_repeated_incoming_keys_leave_one_row_per_target_row(rows):
    target = rows([(1, {"a": "x", "b": ""}), (2, {"a": "y"}), (1, {"b": None})], "id int, f map<string,string>")
    source = rows([(1, {"a": "old", "b": "old"}, 1), (1, {"a": "new", "b": "new"}, 2), (3, {"a": "z"}, 1)], "id int, f map<string,string>, at int")
    got = selection.overwrite_fields(target, source, ["id"], "f", order="at")
    assert sorted((r.id, sorted(r.f.items())) for r in got.collect()) == [
        (1, [("a", "new"), ("b", "new")]), (1, [("a", "new"), ("b", "new")]), (2, [("a", "y")]),
    ]
    got = selection.fill_fields(target, source, ["id"], "f", order="at")
    assert sorted((r.id, sorted(r.f.items()), r.n_filled) for r in got.collect()) == [
        (1, [("a", "new"), ("b", "new")], 2), (1, [("a", "x"), ("b", "new")], 1), (2, [("a", "y")], 0),
    ]
    assert selection.fill_fields(target, source.drop("at"), ["id"], "f").count() == 3
    pages = rows([(1, "")], "id int, title string")
    seeds = rows([(1, "first", 1), (1, "last", 2)], "id int, title string, at int")
    assert [r.title for r in merge.fill_scalars(pages, seeds, ["id"], ["title"], {}, order="at").collect()] == ["last"]
    assert [r.new_value for r in merge.diff_rows(pages, seeds, TableSpec("t", ("id",)), order="at").collect()] == ["last"]


def test_an_apply_leaves_the_callers_schema_alone(rows):
    from tablesync.plans.apply import apply_snapshot
    from tablesync.spec import SyncSpec

    target = rows([(1, "a")], "k int, v string")
    before = target.schema.json()
    apply_snapshot(target, rows([(1, "b")], "k int, v string"), SyncSpec(TableSpec("t", ("k",), not_null=("v",))))
    assert target.schema.json() == before
