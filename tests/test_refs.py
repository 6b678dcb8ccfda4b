import pytest
from conftest import values
from pyspark.sql import functions as F

from tablesync.operators import refs

# Pages 300 to 309 move up by 4000, paragraphs 70 and 71 by 600; 30 is a page too, a prefix of all others.
PAGES = [(30, 41), *[(300 + i, 4300 + i) for i in range(10)]]
PARAS = [(70, 670), (71, 671)]


@pytest.fixture
def maps(rows):
    return rows(PAGES, "source_id int, target_id int"), rows(PARAS, "source_id int, target_id int")


def link(page, anchor=None, prefix="Default.aspx?ID="):
    return f"{prefix}{page}" + (f"#{anchor}" if anchor is not None else "")


def picked(page, gap=""):
    return f'{{"SelectedValue":{gap}"{page}"}}'


CASES = [
    *[(f"to {link(300 + i)}.", f"to {link(4300 + i)}.") for i in range(10)],
    (link(30) + link(301) + " " + link(305), link(41) + link(4301) + " " + link(4305)),
    *[(f"{link(302, a)}|", f"{link(4302, b)}|") for a, b in ((70, 670), (71, 671), (72, 72), ("x", "x"), ("", ""))],
    (link(555, 70), link(555, 70)),
    (link(303, prefix="dEFAULT.ASPX?id="), link(4303, prefix="dEFAULT.ASPX?id=")),
    (link("0303"), link(4303)),
    *[(f"{pad}304{pad}", "4304") for pad in ("", " ", "\t", "\u00a0", "\u2003")],
    ("+304", "4304"),
    ("304 of 305", "304 of 305"),
    ("556", "556"),
    (picked(306), picked(4306)),
    (picked(306, " ") + link(307) + picked(70), picked(4306, " ") + link(4307) + picked(70)),
    (picked(306).replace("V", "v"), picked(306).replace("V", "v")),
    (link(10**12), link(10**12)),
    ("", ""),
    ("prose", "prose"),
    (None, None),
]


def test_rewrite(rows, maps):
    df = rows([(i, text) for i, (text, _) in enumerate(CASES)], "k int, body string")
    got = dict(values(refs.rewrite_links(df, ["k"], ["body"], *maps)))
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_rewrite_fields_returns_changed_rows_only(rows, maps):
    schema = "k int, f map<string,string>"
    df = rows([(1, {"a": link(300), "b": None}), (2, {"a": link(999)}), (3, {"a": "x"}), (4, None)], schema)
    got = refs.rewrite_links_in_fields(df, ["k"], "f", *maps).collect()
    assert [(r["k"], r["f"]) for r in got] == [(1, {"a": link(4300), "b": None})]
    assert refs.rewrite_links_in_fields(df, ["k"], "f", *maps, only_changed=False).count() == 4


def test_rewrite_a_page_that_everything_links_to(rows, maps):
    df = rows([(i, link(30 if i % 3 else 1000 + i)) for i in range(300)], "k int, t string")
    got = refs.rewrite_links(df, ["k"], ["t"], *maps)
    assert got.where(F.col("t") == link(41)).count() == 200


def test_rewrite_without_paragraphs(rows, maps):
    got = refs.rewrite_links(rows([(1, link(300, 70))], "k int, t string"), ["k"], ["t"], maps[0])
    assert values(got) == [(1, link(4300, 70))]


def test_extract(rows):
    df = rows([(1, 'Default.aspx?ID=5#6 default.aspx?id=7 {"SelectedValue": "8"}', None)], "k int, a string, b string")
    got = values(refs.extract_links(df, ["k"], ["a", "b"]), "col", "kind", "target_id", "anchor_id")
    assert set(got) == {("a", "link", 5, 6), ("a", "link", 7, None), ("a", "selected", 8, None)} and len(got) == 3


def test_sweep(rows):
    pages = rows([(1,), (2,), (None,)], "id int")
    paras = rows([(50,), (None,)], "id int")
    df = rows(
        [
            (1, "Default.aspx?ID=1"), (2, "Default.aspx?ID=1#50"), (3, "Default.aspx?ID=1#51"), (4, "Default.aspx?ID=9#50"),
            (5, '{"SelectedValue":"50"}'), (6, '{"SelectedValue":"2"}'), (7, '{"SelectedValue":"77"}'), (8, "121"),
            (9, "Default.aspx?ID=99999999999"), (10, None), (11, "Default.aspx?ID=2#99999999999"),
        ],
        "k int, t string",
    )
    unresolved, resolved = refs.link_sweep(df, ["k"], ["t"], pages, "id", paras, "id")
    assert values(unresolved, "k", "missing_id") == [(3, 51), (4, 9), (7, 77)]
    assert resolved.first()["resolved"] == 5
    got = refs.split_acknowledged(unresolved, [9])
    assert values(got, "k", "severity") == [(3, "fatal"), (4, "warning"), (7, "fatal")]
    got = refs.split_acknowledged(unresolved, rows([(51,), (51,)], "id int"))
    assert values(got, "k", "severity") == [(3, "warning"), (4, "fatal"), (7, "fatal")]


def test_sweep_of_clean_snapshot(rows):
    ids = rows([(1,)], "id int")
    unresolved, resolved = refs.link_sweep(rows([(1, "no links")], "k int, t string"), ["k"], ["t"], ids, "id", ids, "id")
    assert unresolved.count() == 0 and resolved.first()["resolved"] == 0


def test_stats(rows, maps):
    df = rows([(f"{link(300, 70)} {link(301, 99)} {link(999, 70)}",), ("302",), ("9",), (picked(303),)], "t string")
    assert tuple(refs.link_stats(df, ["t"], *maps).first()) == (3, 1, 1, 1)


def test_clear_orphans(rows):
    df = rows(
        [(1, f"{link(31)} {link(314, 3)} {link(3)}", 31, 7), (2, " 314 ", 5, 8), (3, None, None, 31), (4, link(3141), 314, 314)],
        "k int, t string, n int, big bigint",
    )
    gone = rows([(31,), (314,), (314,), (None,)], "id int")
    got = refs.clear_orphan_refs(df, ["k"], gone, keep=("BIG",))
    assert values(got) == [(1, f" #3 {link(3)}", None, 7), (2, "", 5, 8), (3, None, None, 31), (4, link(3141), None, 314)]
    assert values(refs.clear_orphan_refs(df, ["k"], gone.limit(0))) == values(df)


def test_clear_a_million_orphans(spark, rows):
    df = rows([(i, link(i * 7)) for i in range(500)], "k int, t string")
    got = refs.clear_orphan_refs(df, ["k"], spark.range(1, 1_000_000, 2))
    assert got.where("t = ''").count() == 250


def test_clear_stale(rows):
    df = rows([(1, "use 1ColumnEmail now", "1ColumnEmail"), (2, "fine", None)], "k int, a string, b string")
    got = refs.clear_stale_values(df, ["1ColumnEmail", "x.cshtml"], not_null=("B",))
    assert values(got) == [(1, None, ""), (2, "fine", None)]


def test_census(rows):
    df = rows([("a.b", "axb"), ("a.b", None)], "p string, q string")
    got = refs.value_census({"t": df}, {"literal": refs.contains_any(["a.b"])})
    assert values(got) == [("t", "p", "literal", 2)]


def test_texts_are_scanned_once(rows, maps, spark, tmp_path):
    rows([(1, link(300))], "k int, t string").write.parquet(f"{tmp_path}/texts")
    df = spark.read.parquet(f"{tmp_path}/texts")
    plan = refs.rewrite_links(df, ["k"], ["t"], *maps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [k#") - plan.count("_kind") <= 1 and plan.count("/texts") == 1
