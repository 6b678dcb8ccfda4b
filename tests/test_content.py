import pytest
from conftest import values

from tablesync.operators.placement import cut
from tablesync.operators.quality import StrictModeError, run_summary
from tablesync.plans import content as c
from tablesync.plans.apply import apply_all
from tablesync.spec import DESTINATION_WINS, PathRule, SyncSpec, TableSpec

PAGES = (
    "page_id int, guid string, parent_id int, area_id int, menu_text string, sort int, item_type string, layout string, "
    "shortcut string, fields map<string,string>"
)
ROWS = "row_id int, guid string, page_id int, sort int, definition_id string"
PARAS = (
    "para_id int, guid string, page_id int, row_id int, column_id int, sort int, item_type string, "
    "module_settings string, module string, fields map<string,string>"
)
PERMS = "page_id int, owner_id string, level_value int"
GROUPS = [(7, "Dealers")]


@pytest.fixture(scope="module")
def source(rows):
    return c.Content(
        rows(
            [
                (1, "g1", None, 1, "Home", 0, "Page", "home.cshtml", None, {"Title": "Hi", "Secret": "x", "gone": None}),
                (2, "g2", 1, 1, "Shop", 5, "Page", "", "Default.aspx?ID=1#20", {"Link": "2"}),
                (3, "g3", 1, 1, "Draft", 6, "Page", "", "Default.aspx?ID=99", {}),
                (4, "g4", 3, 1, "Below draft", 0, "", "", None, {}),
            ],
            PAGES,
        ),
        rows([(10, "r1", 1, 0, "1Column"), (11, "r2", 1, 0, "1Column"), (12, "r3", 3, 4, "x")], ROWS),
        rows(
            [
                (20, "p1", 1, 11, 1, 0, "Text", "<S><a>1</a><sort>9</sort></S>", "Mod", {"Text": 'x <a href="Default.aspx?ID=2">y</a>'}),
                (21, "p2", 3, 12, 1, 0, "Text", None, "", {}),
            ],
            PARAS,
        ),
        rows([(1, "7", 4), (1, "Anonymous", 1), (3, "7", 4)], PERMS),
        rows([(1, "Main", "en"), (9, "Unused", "de")], "area_id int, title string, culture string"),
    )


@pytest.fixture(scope="module")
def groups(rows):
    return rows(GROUPS, "group_id int, name string")


SPEC = c.ContentSpec(
    (PathRule(1, "/Home", ("/Home/Draft",)),), exclude_fields=("SECRET",), xml_cols={"module_settings": "module"},
    elements_by_type={"mod": ["sort"]}, exclude_area_cols=("Culture",),
)


def written(content):
    """The tables as a reader of the snapshot finds them."""
    return c.Content(*[cut(t) if t is not None else None for t in (content.pages, content.rows, content.paragraphs, content.permissions, content.areas)])


@pytest.fixture(scope="module")
def snapshot(source, groups):
    return written(c.snapshot_content(source, SPEC, groups))


def test_snapshot(snapshot):
    assert values(snapshot.pages, "page_id", "path") == [(1, "/Home"), (2, "/Home/Shop")]
    assert values(snapshot.rows, "row_id", "sort") == [(10, 1), (11, 2)]
    assert snapshot.pages.where("page_id = 1").first()["fields"] == {"Title": "Hi"}
    assert snapshot.paragraphs.first()["module_settings"] == "<S><a>1</a></S>"
    assert values(snapshot.permissions, "page_id", "owner", "level") == [(1, "Anonymous", "none"), (1, "Dealers", "read")]


def test_sweep_and_assets(snapshot, source):
    unresolved, resolved = c.sweep_content(snapshot)
    assert unresolved.count() == 0 and resolved.first()["resolved"] == 2
    unresolved, _ = c.sweep_content(source, acknowledged=[99])
    assert values(unresolved, "owner_id", "field", "missing_id", "severity") == [(3, "shortcut", 99, "warning")]
    assert values(c.content_assets(snapshot)) == [
        ("grid-row", "1Column", "Home"), ("item-type", "Page", "Home"), ("item-type", "Page", "Shop"),
        ("item-type", "Text", "Home"), ("page-layout", "home.cshtml", "Home"),
    ]


@pytest.fixture(scope="module")
def target(rows):
    return c.Content(
        rows([(501, "G1", None, 1, "Mine", 0, "Page", "own.cshtml", "", {"Title": "Own", "Stale": "s", "Secret": "kept"})], PAGES),
        rows([], ROWS),
        rows([(900, "p1", 501, None, 1, 0, "Text", "<S><own>1</own></S>", "Mod", {"Text": "old"})], PARAS),
        rows([(501, "Administrator", 1364), (77, "9", 4)], PERMS),
        rows([(1, "", "fr"), (3, "Third", "")], "area_id int, title string, culture string"),
    )


def test_apply_source_wins(snapshot, target, groups):
    got = c.apply_content(target, snapshot, groups=groups, keep_fields=("secret",))
    pages = {r["guid"].lower(): r for r in got.content.pages.collect()}
    assert pages["g1"]["page_id"] == 501 and pages["g1"]["menu_text"] == "Home" and pages["g1"]["outcome"] == "updated"
    assert pages["g1"]["fields"] == {"Title": "Hi", "Stale": None, "Secret": "kept"}
    new = pages["g2"]
    assert (new["page_id"], new["parent_id"], new["outcome"]) == (502, 501, "created")
    assert new["shortcut"] == "Default.aspx?ID=501#900" and new["fields"] == {"Link": "502"}
    para = got.content.paragraphs.first()
    assert para["para_id"] == 900 and para["fields"]["Text"] == 'x <a href="Default.aspx?ID=502">y</a>'
    assert para["module_settings"] == "<S><a>1</a></S>" and para["page_id"] == 501
    grid = {r["guid"]: r["row_id"] for r in got.content.rows.collect()}
    assert para["row_id"] == grid["r2"] and got.content.rows.select("page_id").distinct().first()[0] == 501
    assert values(got.content.permissions) == [(501, "7", 4), (501, "Anonymous", 1), (77, "9", 4)]
    total = run_summary(c.content_outcomes(got)).where("table_name = '(total)'").first()
    assert (total["created"], total["updated"]) == (3, 3)
    assert values(got.content.areas) == [(1, "Main", "fr", "updated"), (3, "Third", "", "kept")]
    assert got.failed.count() == 0


def test_rows_without_a_place_fail(rows, source, target):
    pages = source.pages.unionByName(rows([(8, "g8", 77, 1, "Lost", 0, "", "", None, {}), (9, "g9", 8, 1, "Below", 0, "", "", None, {}), (7, None, 1, 1, "?", 0, "", "", None, {})], PAGES))
    grid = source.rows.unionByName(rows([(30, "r30", 404, 0, "x"), (31, "r31", 9, 0, "x"), (32, None, 1, 0, "x"), (33, "r33", None, 0, "x")], ROWS))
    paras = source.paragraphs.unionByName(rows([(40, "p40", 404, 30, 1, 0, "", None, "", {}), (41, "p41", 8, None, 1, 0, "", None, "", {})], PARAS))
    got = c.apply_content(target, c.Content(pages, grid, paras))
    assert values(got.failed) == [
        ("pages", 7, "failed", "no GUID"), ("pages", 8, "failed", "unknown parent 77"), ("pages", 9, "skipped", None),
        ("paragraphs", 40, "failed", "unknown page 404"), ("paragraphs", 41, "skipped", None),
        ("rows", 30, "failed", "unknown page 404"), ("rows", 31, "skipped", None), ("rows", 32, "failed", "no GUID"), ("rows", 33, "failed", "unknown page NULL"),
    ]
    assert got.content.rows.where("page_id = 0 or page_id is null").count() == 0 and got.content.rows.count() == 3
    total = run_summary(c.content_outcomes(got)).where("table_name = '(total)'").first()
    assert (total["failed"], total["skipped"]) == (6, 3)


def test_dry_run_of_pages(snapshot, target):
    got = values(c.content_diffs(target, snapshot), "guid", "col", "old_value", "new_value")
    assert ("G1", "menu_text", "Mine", "Home") in got and ("G1", "fields[Title]", "Own", "Hi") in got
    assert values(c.content_diffs(target, snapshot, DESTINATION_WINS), "guid", "col") == [("G1", "shortcut"), ("G1", "sort")]


def test_apply_destination_wins_reaches_pages_only(snapshot, target, groups):
    got = c.apply_content(target, snapshot, DESTINATION_WINS, groups)
    pages = {r["guid"].lower(): r for r in got.content.pages.collect()}
    assert (pages["g1"]["menu_text"], pages["g1"]["layout"]) == ("Mine", "own.cshtml")
    assert pages["g1"]["fields"] == {"Title": "Own", "Stale": "s", "Secret": "kept"}
    assert pages["g2"]["outcome"] == "created"
    assert got.content.paragraphs.first()["fields"]["Text"].startswith("x <a")
    assert values(got.content.permissions) == [(501, "Administrator", 1364), (77, "9", 4)]


def test_second_apply_changes_nothing(snapshot, target, groups):
    first = written(c.apply_content(target, snapshot, groups=groups).content)
    again = c.Content(*[getattr(first, n).drop("outcome") for n in ("pages", "rows", "paragraphs")], first.permissions, first.areas.drop("outcome"))
    twice = c.apply_content(again, snapshot, groups=groups)
    second = written(twice.content)
    assert values(second.permissions) == values(first.permissions)
    for n, key in (("pages", "page_id"), ("rows", "row_id"), ("paragraphs", "para_id")):
        assert values(getattr(second, n), key, "guid") == values(getattr(first, n), key, "guid")
        # Only the page with a field of its own, and the paragraph with XML of its own, differ from the snapshot.
        assert getattr(second, n).where("outcome not in ('skipped', 'kept')").count() <= 1


def test_tables_follow_the_content_through_one_gate(rows, snapshot, target, groups):
    content = c.apply_content(target, snapshot, groups=groups)
    old = rows([(1, "x")], "k int, link string")
    new = rows([("1", "Default.aspx?ID=1#20", "?"), ("2", "2", "?"), ("z", "", "?")], "k string, link string, drifted string")
    specs = [SyncSpec(TableSpec("t", ("k",)), link_cols=("link",)), SyncSpec(TableSpec("no snapshot", ("k",)))]
    got = apply_all({"t": old}, {"t": new}, specs, content=content)
    assert values(got.results["t"].table) == [(0, ""), (1, "Default.aspx?ID=501#900"), (2, "502")]
    assert sorted(r.table_name for r in got.warnings.collect()) == ["t", "t"]
    total = got.summary().where("table_name = 't'").first()
    assert (total["created"], total["updated"]) == (2, 1)
    with pytest.raises(StrictModeError, match="^2 warning"):
        apply_all({"t": old}, {"t": new}, specs, content=content, strict=True)
    with pytest.raises(ValueError, match="no table"):
        apply_all({"t": old}, {}, specs)
