import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import permissions, quality, selection
from tablesync.spec import TableSpec


def test_assets(rows):
    pages = rows([("home", "a.cshtml", "T"), ("HOME", "a.cshtml", ""), ("b", "A.cshtml", None)], "u string, layout string, item string")
    got = quality.asset_refs([(pages, "page-layout", "layout", "u"), (pages, "item-type", "item", "u")])
    assert [tuple(r) for r in got.collect()] == [
        ("item-type", "T", "home"), ("page-layout", "A.cshtml", "b"), ("page-layout", "a.cshtml", "HOME"),
    ]


@pytest.mark.parametrize(
    "path, safe",
    [
        ("Design/Page.cshtml", True), ("with space-1_a.b", True), ("../x", False), ("a/../b", False), ("a\\b", False), ("/etc", False),
        ("a|b", False), ("", False),
    ],
)
def test_safe_paths(rows, path, safe):
    df = rows([(path,)], "p string")
    assert df.select(quality.is_safe_path(F.col("p")).alias("s")).first()["s"] is safe


def test_missing_assets_list_every_user(rows):
    refs = rows([("item-type", "X", f"p{i}") for i in range(7)] + [("item-type", "ok", "p"), ("item-type", "..", "p")], "kind string, path string, referenced_by string")
    got = quality.missing_assets(refs, rows([("item-type", "ok")], "kind string, path string"))
    assert values(got, "path", "problem", "referenced_by") == [("..", "unsafe path", "p"), *[("X", "missing", f"p{i}") for i in range(7)]]
    assert values(quality.users_per_asset(got), "path", "n_users") == [("..", 1), ("X", 7)]


def test_strict_gate_counts_and_lists_all_warnings(spark, rows):
    w = spark.range(25_000).select(F.concat(F.lit("warning "), F.col("id").cast("string")).alias("warning"))
    assert quality.assert_no_warnings(w, strict=False) == 0 and quality.assert_no_warnings(w.where("false")) == 0
    with pytest.raises(quality.StrictModeError, match="^25000 warning") as e:
        quality.assert_no_warnings(w)
    assert spark.read.parquet(str(e.value).rsplit(" ", 1)[1]).distinct().count() == 25_000


def test_advice(rows):
    errors = [
        ("T", "conflict with FOREIGN KEY"), ("T", "foreign key again"), ("T", "Group 'x' not found"), ("T", "Duplicate entry"),
        ("T", "boom"), ("T", " "), ("T", None), (None, "no connection"),
    ]
    got = quality.advice(rows(errors, "table_name string, error string"))
    assert sorted(r["kind"] for r in got.collect()) == ["again", "duplicate key", "foreign key", "missing group", "other", "run"]
    assert quality.advice(rows([("T", None)], "table_name string, error string")).count() == 0


def test_secrets(rows):
    df = rows([(1, "x", "my password: 1"), (2, "", "fine"), (3, " ", None)], "k int, ApiKey string, note string")
    assert values(quality.secret_scan(df, ["k"])) == [(1, "ApiKey", "name"), (1, "note", "text")]


def test_reconcile_and_post_checks(rows):
    a, b = rows([(1, "x"), (2, "y"), (3, "z")], "k int, v string"), rows([(1, "x"), (2, "Y"), (4, "w")], "k int, v string")
    assert tuple(quality.reconcile(a, b, TableSpec("t", ("k",))).first()) == (3, 3, 1, 1, 1, 1)
    got = quality.verify_post({"left": a, "none": a.where("false")})
    assert values(got) == [("left", 3, False), ("none", 0, True)]


def test_summary_of_nothing_has_a_total(rows):
    got = quality.run_summary(rows([("t", "created"), ("t", "failed")], "table_name string, outcome string"))
    assert values(got) == [("(total)", 1, 0, 0, 1), ("t", 1, 0, 0, 1)]


GROUPS = [(7, "Dealers"), (8, "dealers"), (9, ""), (10, "VIP")]


def test_export_permissions(rows):
    perms = rows([(1, "anonymous", 1), (1, "7", 4), (1, "9", 20), (1, "77", 1364), (1, "odd", 5)], "page_id int, owner_id string, level_value int")
    got = permissions.export_permissions(perms, rows(GROUPS, "group_id int, name string"))
    assert values(got, "owner", "owner_type", "owner_id", "level") == [
        ("77", "group", "77", "all"), ("9", "group", "9", "edit"), ("Dealers", "group", "7", "read"),
        ("anonymous", "role", None, "none"), ("odd", "group", "odd", "5"),
    ]


def test_import_permissions(rows):
    schema = "page_id int, owner string, owner_type string, level string, level_value int, n int"
    perms = rows(
        [
            (1, "Anonymous", "role", "read", 4, 1), (1, "VIP", "Group", "ALL", 0, 2), (1, "vip", "group", "none", 0, 3),
            (2, "gone", "group", "read", 4, 1), (2, "Anonymous", "role", "all", 1364, 2), (2, "DEALERS", "group", "strange", 55, 3),
        ],
        schema,
    )
    got, warnings = permissions.import_permissions(perms, rows(GROUPS, "group_id int, name string"), "n")
    assert values(got) == [(1, "10", 1), (1, "Anonymous", 4), (2, "7", 55), (2, "Anonymous", 1)]
    assert values(warnings, "group_name", "n") == [("gone", 1)]


def test_select_and_exclude(rows):
    df = rows([(1, "a", 5), (2, None, 6)], "UrlPathId int, UrlPathPath string, UrlPathVisitsCount int")
    assert selection.select_rows(df, "UrlPathPath is null").count() == 1 and selection.select_rows(df, " ") is df
    assert selection.exclude_columns(df, ("urlpathpath",), "URLPATH").columns == ["UrlPathId"]
    assert selection.exclude_columns(df, (), "UrlPath", ("urlpathvisitscount",)).columns == df.columns
    with pytest.raises(Exception, match="nope"):
        selection.select_rows(df, "nope = 1")


@pytest.mark.parametrize(
    "flat, by_type, kept",
    [
        ([], {}, ["A", "b", "c"]), (["a"], {}, ["b", "c"]), ([], {"t1": ["B"]}, ["A", "c"]), (["A"], {"T1": ["b"]}, ["c"]),
        ([], {"other": ["A"]}, ["A", "b", "c"]),
    ],
)
def test_field_exclusions(rows, flat, by_type, kept):
    df = rows([("T1", {"A": "1", "b": "2", "c": "3"})], "t string, f map<string,string>")
    got = selection.exclude_fields_by_type(df, "f", "t", flat, by_type).first()["f"]
    assert sorted(got) == kept


def test_live_rows_and_compact(rows):
    df = rows([(3, True, None), (1, True, False), (2, False, False), (4, True, True)], "id int, a boolean, d boolean")
    assert [r["id"] for r in selection.live_rows(df, "a", "d", "id").collect()] == [1, 3]
    got = selection.compact_fields(rows([({"A": "1", "b": None, "Held": "x"},)], "f map<string,string>"), "f", ("held",))
    assert got.first()["f"] == {"A": "1"}
