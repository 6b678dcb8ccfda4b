import datetime as dt
import hashlib

import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import identity as ident
from tablesync.spec import TableSpec


def one(df, col):
    return df.select(col.alias("v")).first()["v"]


def test_identity_name_column_is_trimmed(rows):
    df = rows([(1, "  Checkout\t ")], "id int, name string")
    assert one(df, ident.row_identity(df, TableSpec("t", ("id",), "NAME"))) == "Checkout"


def test_identity_composite_key_in_name_order(rows):
    df = rows([("Y", "X")], "b string, A string")
    assert one(df, ident.row_identity(df, TableSpec("t", ("b", "A")))) == "X$$Y"


def test_identity_keyless_uses_all_columns_and_null_is_empty(rows):
    df = rows([("1", None, "3")], "c string, b string, a string")
    assert one(df, ident.row_identity(df, TableSpec("t"))) == "3$$$$1"


def test_checksum_layout(rows):
    df = rows([(7, True, "  ", None, "x")], "id int, flag boolean, blank string, gone string, Name string")
    text = "BLANK=|FLAG=true|GONE=|NAME=x"
    got = one(df, ident.row_checksum(df, TableSpec("t", ("id",), auto_cols=("ID",))))
    assert got == hashlib.md5(text.encode()).hexdigest()


def test_checksum_compare_columns_and_absent_column(rows):
    df = rows([(7, "x")], "id int, name string")
    got = one(df, ident.row_checksum(df, TableSpec("t", ("id",), compare_cols=("name", "extra"))))
    assert got == hashlib.md5(b"EXTRA=|NAME=x").hexdigest()


def test_underscore_sorts_after_letters(rows):
    df = rows([("1", "2")], "a_b string, aZ string")
    assert one(df, ident.row_checksum(df, TableSpec("t"))) == hashlib.md5(b"AZ=2|A_B=1").hexdigest()


def test_classify_by_case_insensitive_identity(rows):
    target = rows([("ab", "1"), ("cd", "2")], "k string, v string")
    incoming = rows([("AB", "1"), ("cd", "9"), ("ef", "3")], "k string, v string")
    spec = TableSpec("t", ("k",), compare_cols=("v",))
    got = ident.classify_changes(incoming, target, spec)
    assert values(got, "k", "outcome") == [("AB", "skipped"), ("cd", "updated"), ("ef", "created")]


def test_classify_excluded_column_looks_changed_unless_shared(rows):
    target = rows([(1, "a", "runtime")], "k int, v string, visits string")
    incoming = rows([(1, "a")], "k int, v string")
    spec = TableSpec("t", ("k",))
    assert ident.classify_changes(incoming, target, spec).first()["outcome"] == "updated"
    assert ident.classify_changes(incoming, target, spec, compare="shared").first()["outcome"] == "skipped"


def test_classify_name_column_duplicates_last_key_wins(rows):
    target = rows([(1, "n", "old"), (2, "N ", "new")], "k int, name string, v string")
    spec = TableSpec("t", ("k",), "name", compare_cols=("v",))
    incoming = rows([(1, "n", "new"), (9, "n", "old")], "k int, name string, v string")
    assert values(ident.classify_changes(incoming, target, spec), "k", "outcome") == [(1, "skipped"), (9, "created")]


def test_resolve_guid(rows):
    dim = rows([(5, "g5")], "id int, guid string")
    got, warnings = ident.resolve_guid(rows([(5,), (0,), (-1,), (None,), (6,), (6,)], "ref int"), "ref", dim, "id", "guid", "g")
    assert values(got) == [(None, None), (-1, None), (0, None), (5, "g5"), (6, None), (6, None)]
    assert values(warnings, "id", "rows") == [(6, 2)]


def test_id_map_drops_null_and_unmatched(rows):
    source = rows([(1, "A"), (None, "b"), (3, "c")], "id int, guid string")
    target = rows([(10, "a"), (20, "b"), (40, "d")], "id int, guid string")
    assert values(ident.build_id_map(source, target)) == [(1, 10)]


def test_union_of_id_maps_first_run_wins(rows):
    a = rows([(1, 10)], "source_id int, target_id int")
    b = rows([(1, 99), (2, 20)], "source_id int, target_id int")
    assert values(ident.union_id_maps([a, b])) == [(1, 10), (2, 20)]


def test_allocate_ids_keeps_known_and_is_dense(rows):
    target = rows([(5, "A"), (9, "b")], "id int, guid string")
    incoming = rows([(g,) for g in ("a", "x", "y", "z", "B")], "guid string")
    got = ident.allocate_ids(incoming, target)
    ids = {r["guid"]: r["target_id"] for r in got.collect()}
    assert ids["a"] == 5 and ids["B"] == 9 and sorted(ids[g] for g in "xyz") == [10, 11, 12]


def test_allocate_ids_into_empty_target(rows):
    got = ident.allocate_ids(rows([("x",)], "guid string"), rows([], "id int, guid string"))
    assert got.first()["target_id"] == 1


def test_allocate_ids_sets_rows_without_guid_aside(rows):
    got = ident.allocate_ids(rows([("x", 1), (None, 2), ("X", 3)], "guid string, k int"), rows([], "id int, guid string"))
    assert values(got, "k", "target_id", "is_new") == [(1, 1, True), (2, None, None), (3, 1, True)]


def test_manifest_and_stale_keys(rows, spark):
    spec = TableSpec("t", ("k",))
    before = ident.snapshot_manifest(rows([("A", 1), ("b", 2)], "k string, v int"), spec)
    now = ident.snapshot_manifest(rows([("a", 1)], "k string, v int"), spec)
    stale = ident.stale_keys(before, now)
    assert values(stale, "identity") == [("b",)]
    kept = ident.drop_stale(rows([("A", 1), ("b", 2)], "k string, v int"), spec, stale)
    assert values(kept) == [("A", 1)]


def _names(df, **kw):
    return {r["k"]: r["file_name"] for r in ident.row_file_names(df, "i", ["k"], **kw).collect()}


def test_file_names(rows):
    df = rows([(1, "Widget"), (2, "widget"), (3, "Widget"), (4, " a/b "), (5, ""), (6, None), (7, "")], "k int, i string")
    h = lambda s: hashlib.md5(s.encode()).hexdigest()[:6]
    want = {
        1: "Widget", 2: f"widget [{h('widget')}-1]", 3: f"Widget [{h('Widget')}-1]", 4: "a_b",
        5: "_unnamed", 6: f"_unnamed [{h('')}-1]", 7: f"_unnamed [{h('')}-2]",
    }
    assert _names(df) == want


def test_file_names_of_a_hot_identity(rows):
    df = rows([(k, "" if k % 3 else f"n{k}") for k in range(200)], "k int, i string")
    assert len(set(_names(df).values())) == 200


def test_file_names_that_look_numbered(rows):
    h = hashlib.md5(b"a").hexdigest()[:6]
    df = rows([(1, "a"), (2, "a"), (3, f"a [{h}-1]"), (4, f"A [{h}-1]"), (5, "a [1-2]")], "k int, i string")
    got = _names(df)
    assert len({n.lower() for n in got.values()}) == 5 and got[1] == "a" and got[5] == "a [1-2]"


def test_folder_names(rows):
    df = rows([(1, 0, "A", "{AABBCCDD-1}"), (2, 0, "a", "{11223344-1}"), (3, 1, "A", "ff")], "k int, p int, n string, g string")
    got = ident.sibling_folder_names(df, "p", "n", "g", ["k"])
    assert values(got, "k", "folder") == [(1, "A"), (2, "a [112233]"), (3, "A")]
    rowsdf = rows([(1, 0, 4, "aabbccdd"), (2, 0, 4, "11223344"), (3, None, 4, "ff")], "k int, p int, n int, g string")
    got = ident.sibling_folder_names(rowsdf, "p", "n", "g", ["k"], style="row")
    assert values(got, "k", "folder") == [(1, "grid-row-4"), (2, "grid-row-4-112233"), (3, "grid-row-4")]


def test_duplicate_identities(rows):
    df = rows([(1, "a "), (2, "a"), (3, "b"), (4, "Red"), (5, "RED"), (6, "red")], "k int, n string")
    assert values(ident.duplicate_identities(df, TableSpec("t", ("k",), "n"))) == [("RED", 3), ("a", 2)]


def test_keys_keep_leading_blanks(rows):
    target = rows([("a", 1), (" a", 2)], "k string, v int")
    incoming = rows([("A ", 9)], "k string, v int")
    from tablesync.operators.merge import upsert

    assert values(upsert(target, incoming, TableSpec("t", ("k",)))) == [(" a", 2), ("a", 9)]


def test_unknown_spec_column_is_refused(rows):
    from tablesync.sources.tables import snapshot_rows
    from tablesync.spec import SyncSpec

    with pytest.raises(ValueError, match="nope"):
        snapshot_rows(rows([(1,)], "k int"), SyncSpec(TableSpec("t", ("k",), compare_cols=("nope",))))


def test_ordinal_numbers_typed_and_null_groups(rows):
    from tablesync.operators.placement import ordinal

    data = [(None if i % 2 else i % 5, i % 7, i) for i in range(500)]
    got = {r.id: r.n for r in ordinal(rows(data, "g int, s int, id int"), ["g"], ["s", "id"], "n").collect()}
    want, seen = {}, {}
    for g, _, i in sorted(data, key=lambda r: (r[1], r[2])):
        seen[g] = want[i] = seen.get(g, 0) + 1
    assert got == want


def test_ordinal_parts_timestamps_a_microsecond_apart(rows):
    from tablesync.operators.placement import ordinal

    at = [dt.datetime(2024, 5, 5, 5, 5, 5, k) for k in (1, 2)]
    got = ordinal(rows([(at[i % 2], i) for i in range(40)], "g timestamp, id int"), ["g"], ["id"], "n")
    assert sorted((r.g, r.n) for r in got.collect()) == [(g, n + 1) for g in at for n in range(20)]


def test_ordinal_of_all_rows(rows):
    from tablesync.operators.placement import ordinal

    got = ordinal(rows([(i * 37 % 101,) for i in range(101)], "id int"), [], ["id"], "n")
    assert values(got) == sorted(((i, i + 1) for i in range(101)), key=lambda t: [(True, str(v)) for v in t])


def test_last_per_takes_columns_of_any_type(rows):
    df = rows([(1, "a", {"x": "1"}), (1, "b", {"x": "2"}), (2, None, None), (2, None, {"y": None})], "k int, o string, m map<string,string>")
    got = {r.k: r.m for r in ident.last_per(df, ["k"], ["o"]).collect()}
    assert got[1] == {"x": "2"} and 2 in got and len(got) == 2


def test_numbering_shuffles_its_rows_once(rows):
    """Groups of several ranges, NULL groups and repeats of a sort value; the rows that were written are not shuffled again to be numbered."""
    from tablesync.operators.placement import ordinal

    df = rows([(None if g == 3 else g, k % 7, k) for g in range(4) for k in range(40)], "g int, s int, k int")
    for group in ([], ["g"]):
        got = ordinal(df, group, ["s", "k", F.coalesce("g", F.lit(9))], "n")
        want = {}
        for g, s, k in sorted(((r.g, r.s, r.k) for r in df.collect()), key=lambda r: (r[1], r[2], 9 if r[0] is None else r[0])):
            of = want.setdefault(g if group else 0, [])
            of.append((g, s, k, len(of) + 1))
        assert {tuple(r) for r in got.collect()} == {r for of in want.values() for r in of}
        assert "row_number" not in got._jdf.queryExecution().executedPlan().toString()
