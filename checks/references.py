"""References in text (F). The texts are the whole documents with references of all kinds woven in."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import case, table
from checks.identities import MAP_SQL, customer_map
from tablesync.operators import fragments, refs
from tablesync.operators.placement import work_path
from tablesync.sources.refindex import ReferenceIndex

# Per document: a page link with anchor, a page link in lower case, a JSON selection, and a second
# column that is a bare number for every document below 500 characters.
TEXT_SQL = """SELECT doc_id, text AS body, CAST(n_chars % 1500 AS INT) AS a, CAST(doc_id % 1700 AS INT) AS b,
  CAST(n_chars % 50 AS INT) AS p, lang, CASE WHEN n_chars < 500 THEN CAST(n_chars AS VARCHAR) ELSE lang END AS short FROM documents"""

_NOTE = "body || ' <a href=\"Default.aspx?ID=' || {a} || '#' || {p} || '\">x</a> default.aspx?id=' || {b} || '&x=1 {{\"SelectedValue\": \"' || {s} || '\"}}'"
NOTES_SQL = f"SELECT doc_id, a, b, p, short, {_NOTE.format(a='a', p='p', b='b', s='a')} AS note FROM ({TEXT_SQL}) t"

PARA_SQL = "SELECT CAST(p_partkey AS INT) AS source_id, CAST(p_partkey + 900 AS INT) AS target_id FROM part WHERE p_size > 20"


def notes(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "text", "lang", "n_chars",
        (F.col("n_chars") % 1500).cast("int").alias("a"),
        (F.col("doc_id") % 1700).cast("int").alias("b"),
        (F.col("n_chars") % 50).cast("int").alias("p"),
    )
    note = F.concat(
        "text", F.lit(' <a href="Default.aspx?ID='), "a", F.lit("#"), "p", F.lit('">x</a> default.aspx?id='), "b",
        F.lit('&x=1 {"SelectedValue": "'), "a", F.lit('"}'),
    )
    short = F.when(F.col("n_chars") < 500, F.col("n_chars").cast("string")).otherwise(F.col("lang"))
    return docs.select("doc_id", "a", "b", "p", short.alias("short"), note.alias("note"))


def para_map(spark, d):
    parts = table(spark, d, "part").where("p_size > 20")
    return parts.select(F.col("p_partkey").cast("int").alias("source_id"), (F.col("p_partkey") + 900).cast("int").alias("target_id"))


REFS_SQL = f"""SELECT doc_id, 'note' AS col, 'link' AS kind, a AS target_id, p AS anchor_id, 'Default.aspx?ID=' || a || '#' || p AS ref FROM ({NOTES_SQL}) n
  UNION ALL SELECT doc_id, 'note', 'link', b, NULL, 'default.aspx?id=' || b FROM ({NOTES_SQL}) n
  UNION ALL SELECT doc_id, 'note', 'selected', a, NULL, '"SelectedValue": "' || a || '"' FROM ({NOTES_SQL}) n"""


@case("f1_extract_links", REFS_SQL)
def _(spark, d):
    return refs.extract_links(notes(spark, d), ["doc_id"], ["note", "short"])


_MAPPED = f"""WITH m AS ({MAP_SQL}), q AS ({PARA_SQL}), t AS ({TEXT_SQL}) SELECT t.doc_id,
  {_NOTE.format(a="coalesce(ma.target_id, a)", p="CASE WHEN ma.target_id IS NULL THEN p ELSE coalesce(q.target_id, p) END",
                b="coalesce(mb.target_id, b)", s="coalesce(ma.target_id, a)").replace("body", "t.body")} AS note,
  coalesce(CAST(ms.target_id AS VARCHAR), short) AS short
  FROM t LEFT JOIN m ma ON ma.source_id = a LEFT JOIN m mb ON mb.source_id = b LEFT JOIN q ON q.source_id = p
  LEFT JOIN m ms ON ms.source_id = TRY_CAST(short AS INT)"""


@case("f2_rewrite_links", _MAPPED)
def _(spark, d):
    rows = notes(spark, d).select("doc_id", "note", "short")
    return refs.rewrite_links(rows, ["doc_id"], ["note", "short"], customer_map(spark, d), para_map(spark, d))


_SWEEP = f"""WITH r AS ({REFS_SQL}), pg AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal >= 0),
  pa AS (SELECT source_id AS id FROM ({PARA_SQL}) x),
  j AS (SELECT *, target_id IN (SELECT id FROM pg) AS page_ok, anchor_id IN (SELECT id FROM pa) AS anchor_ok,
        target_id IN (SELECT id FROM pa) AS para_ok FROM r),
  u AS (SELECT doc_id, col, kind, CASE WHEN kind = 'link' AND page_ok THEN anchor_id ELSE target_id END AS missing_id, ref FROM j
        WHERE CASE WHEN kind = 'link' THEN NOT page_ok OR (anchor_id IS NOT NULL AND NOT anchor_ok) ELSE NOT (page_ok OR para_ok) END)"""


def sweep(spark, d):
    pages = table(spark, d, "customer").where("c_acctbal >= 0")
    return refs.link_sweep(notes(spark, d), ["doc_id"], ["note", "short"], pages, "c_custkey", para_map(spark, d), "source_id")


@case("f3_link_sweep", f"{_SWEEP} SELECT * FROM u")
def _(spark, d):
    return sweep(spark, d)[0]


@case("f3_link_sweep_resolved", f"{_SWEEP} SELECT (SELECT count(*) FROM r) - (SELECT count(*) FROM u) AS resolved")
def _(spark, d):
    return sweep(spark, d)[1]


@case(
    "f4_split_acknowledged",
    f"""{_SWEEP} SELECT u.*, CASE WHEN missing_id IN (SELECT p_size FROM part) THEN 'warning' ELSE 'fatal' END AS severity FROM u""",
)
def _(spark, d):
    known = table(spark, d, "part").select(F.col("p_size").alias("id"))
    return refs.split_acknowledged(sweep(spark, d)[0], known)


@case(
    "f5_link_stats",
    f"""WITH r AS ({REFS_SQL}), m AS ({MAP_SQL}), q AS ({PARA_SQL}), n AS ({NOTES_SQL}),
        l AS (SELECT target_id IN (SELECT source_id FROM m) AS ok, anchor_id, anchor_id IN (SELECT source_id FROM q) AS aok FROM r WHERE kind = 'link')
        SELECT (SELECT count(*) FROM l WHERE ok) + (SELECT count(*) FROM n WHERE TRY_CAST(short AS INT) IN (SELECT source_id FROM m)) AS resolved,
        (SELECT count(*) FROM l WHERE NOT ok) AS unresolved,
        (SELECT count(*) FROM l WHERE ok AND anchor_id IS NOT NULL AND aok) AS paragraph_resolved,
        (SELECT count(*) FROM l WHERE ok AND anchor_id IS NOT NULL AND NOT aok) AS paragraph_unresolved""",
)
def _(spark, d):
    return refs.link_stats(notes(spark, d), ["note", "short"], customer_map(spark, d), para_map(spark, d))


@case(
    "f6_rewrite_links_in_fields",
    f"""WITH x AS ({_MAPPED}), t AS ({NOTES_SQL})
        SELECT t.doc_id, x.note, x.short FROM x JOIN t USING (doc_id) WHERE x.note <> t.note OR x.short <> t.short""",
)
def _(spark, d):
    rows = notes(spark, d)
    fields = F.create_map(F.lit("note"), "note", F.lit("short"), "short", F.lit("none"), F.lit(None).cast("string"))
    rows = rows.select("doc_id", fields.alias("fields"))
    done = refs.rewrite_links_in_fields(rows, ["doc_id"], "fields", customer_map(spark, d), para_map(spark, d))
    return done.select("doc_id", F.col("fields")["note"].alias("note"), F.col("fields")["short"].alias("short"))


# The pages of debtors are gone.
_CLEARED = "CASE WHEN {x} IN (SELECT id FROM gone) THEN '' ELSE {p} || {x} END"


@case(
    "f7_clear_orphan_refs",
    f"""WITH gone AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal < 0), t AS ({TEXT_SQL})
        SELECT doc_id, CASE WHEN a NOT IN (SELECT id FROM gone) THEN a END AS a,
        CASE WHEN TRY_CAST(short AS INT) IN (SELECT id FROM gone) THEN '' ELSE short END AS short,
        body || ' <a href="' || {_CLEARED.format(x="a", p="'Default.aspx?ID='")} || '#' || p || '">x</a> '
          || {_CLEARED.format(x="b", p="'default.aspx?id='")} || '&x=1 {{"SelectedValue": "' || a || '"}}' AS note FROM t""",
)
def _(spark, d):
    gone = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))
    return refs.clear_orphan_refs(notes(spark, d).drop("b", "p"), ["doc_id"], gone)


@case(
    "f8_clear_stale_values",
    """SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%widget%' THEN NULL ELSE p_name END AS p_name,
       CASE WHEN p_type LIKE '%ring%' THEN '' ELSE p_type END AS p_type, p_brand FROM part""",
)
def _(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return refs.clear_stale_values(rows, ["ring", "widget"], not_null=("p_type",))


@case(
    "f9_value_census",
    r"""SELECT * FROM (SELECT 'documents' AS table_name, 'text' AS col, 'mail' AS pattern, count(*) FILTER (WHERE regexp_matches(text, '[a-z]+@[a-z]+')) AS n FROM documents
        UNION ALL SELECT 'documents', 'text', 'license', count(*) FILTER (WHERE regexp_matches(text, 'License|Copyright')) FROM documents
        UNION ALL SELECT 'documents', 'lang', 'license', count(*) FILTER (WHERE regexp_matches(lang, 'License|Copyright')) FROM documents
        UNION ALL SELECT 'pages', 'html', 'mail', count(*) FILTER (WHERE regexp_matches(html, '[a-z]+@[a-z]+')) FROM pages
        UNION ALL SELECT 'pages', 'html', 'license', count(*) FILTER (WHERE regexp_matches(html, 'License|Copyright')) FROM pages
        UNION ALL SELECT 'pages', 'url', 'mail', count(*) FILTER (WHERE regexp_matches(url, '[a-z]+@[a-z]+')) FROM pages) c WHERE n > 0""",
)
def _(spark, d):
    patterns = {"mail": "[a-z]+@[a-z]+", "license": refs.contains_any(["License", "Copyright"])}
    return refs.value_census({n: table(spark, d, n) for n in ("documents", "pages")}, patterns)


# A fragment per document: twelve characters from its middle, which other documents may hold too.
FRAGMENTS_SQL = "SELECT DISTINCT substr(text, CAST(floor(length(text) / 2.0) AS INTEGER), 12) AS fragment FROM documents WHERE length(text) > 40"


def document_fragments(spark, d):
    texts = table(spark, d, "documents").where(F.length("text") > 40)
    return texts.select(F.substring("text", F.floor(F.length("text") / 2).cast("int"), F.lit(12)).alias("fragment")).distinct()


@case(
    "f8_clear_fragments",
    f"""WITH f AS (SELECT fragment FROM ({FRAGMENTS_SQL}) x WHERE fragment LIKE '%e%e%e%')
        SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM f WHERE contains(text, fragment)) THEN NULL ELSE text END AS text, lang FROM documents""",
)
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", "lang")
    return fragments.clear_fragments(rows, ["doc_id"], document_fragments(spark, d).where("fragment like '%e%e%e%'"))


@case(
    "f9_fragment_census",
    f"""WITH f AS ({FRAGMENTS_SQL}) SELECT 'documents' AS table_name, 'text' AS col, fragment, count(*) AS n
        FROM documents JOIN f ON contains(text, fragment) GROUP BY fragment""",
)
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", "lang")
    return fragments.fragment_census({"documents": (rows, ["doc_id"])}, document_fragments(spark, d))


@case("f3_link_sweep_index", f"{_SWEEP} SELECT * FROM u")
def _(spark, d):
    """Half of the notes are indexed as they were, then changed and joined by the others; the sweep reads no text again."""
    now, half = notes(spark, d), F.col("p") < 25
    before = now.where(half).withColumn("note", F.regexp_replace("note", "ID=", "ID=1"))
    index = ReferenceIndex(spark, work_path(spark, "index"), ["doc_id"], ["note", "short"])
    index.update(0, None, before)
    index.update(1, before, now.where(half))
    index.update(2, None, now.where(~half))
    index.fold()
    pages = table(spark, d, "customer").where("c_acctbal >= 0")
    return index.sweep(pages, "c_custkey", para_map(spark, d), "source_id")[0]
