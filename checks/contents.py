"""Content plans: pages from the part tree, one grid row and one paragraph per order."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.base import TREE_SQL, case, part_tree, table
from tablesync.operators.placement import cut
from tablesync.plans import content as c
from tablesync.spec import PathRule


def site(spark, d):
    nodes = part_tree(spark, d)
    pages = nodes.select(
        F.col("id").alias("page_id"), F.md5(F.col("id").cast("string")).alias("guid"), F.col("parent").alias("parent_id"),
        F.when(F.col("sort") == 50, 2).otherwise(1).alias("area_id"), F.col("name").alias("menu_text"), "sort",
        F.col("kind").alias("item_type"), F.concat(F.lit("Default.aspx?ID="), F.col("sort").cast("string")).alias("shortcut"),
        F.create_map(F.lit("Title"), "name", F.lit("Kind"), "kind").alias("fields"),
    )
    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    rows = orders.select(
        F.col("o_orderkey").alias("row_id"), F.md5(F.concat(F.lit("r"), key)).alias("guid"), F.col("o_custkey").alias("page_id"),
        F.month("o_orderdate").alias("sort"), F.col("o_orderpriority").alias("definition_id"),
    )
    text = F.concat(F.lit("see Default.aspx?ID="), F.col("o_custkey").cast("string"), F.lit("#"), key)
    paras = orders.select(
        F.col("o_orderkey").alias("para_id"), F.md5(F.concat(F.lit("p"), key)).alias("guid"), F.col("o_custkey").alias("page_id"),
        F.col("o_orderkey").alias("row_id"), F.lit(1).alias("column_id"), F.lit(0).alias("sort"),
        F.col("o_orderstatus").alias("item_type"), F.create_map(F.lit("Text"), text).alias("fields"),
    )
    return c.Content(pages, rows, paras)


# The area of a page is 2 where its sort value is 50; such pages and all below them stay out.
KEPT_SQL = f"""WITH RECURSIVE nodes AS ({TREE_SQL}), p AS (SELECT id, '/' || name AS path FROM nodes WHERE parent IS NULL AND sort <> 50
  UNION ALL SELECT n.id, p.path || '/' || n.name FROM nodes n JOIN p ON n.parent = p.id WHERE n.sort <> 50)"""


@case(
    "e11_snapshot_content",
    f"""{KEPT_SQL}, r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY month(o_orderdate), o_orderkey) AS n FROM orders)
        SELECT r.o_orderkey AS row_id, p.path, CAST(r.n AS INT) AS sort FROM r JOIN p ON p.id = r.o_custkey""",
)
def _(spark, d):
    snap = c.snapshot_content(site(spark, d), c.ContentSpec((PathRule(1, "/"),)))
    paths = snap.pages.select(F.col("page_id").alias("_page"), "path")
    return snap.rows.join(paths, F.col("page_id") == F.col("_page")).select("row_id", "path", "sort")


def partly_known(spark, d):
    """Pages with a sort value above 15 exist already, under other ids; on them the rows and paragraphs of finished orders."""
    all_of_it = site(spark, d)
    pages = all_of_it.pages.where("sort > 15").withColumn("page_id", F.col("page_id") + 7000000)
    pages = pages.withColumn("parent_id", F.lit(None).cast("long")).withColumn("menu_text", F.lit("old"))
    known = pages.select((F.col("page_id") - 7000000).alias("_page"))
    finished = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("_order"))

    def there(df, key):
        df = df.join(known, F.col("page_id") == F.col("_page"), "left_semi").join(finished, F.col(key) == F.col("_order"), "left_semi")
        return df.withColumn("page_id", F.col("page_id") + 7000000).withColumn(key, F.col(key) + 5000000)

    rows = there(all_of_it.rows, "row_id").withColumn("definition_id", F.lit("old"))
    paras = there(all_of_it.paragraphs, "para_id").withColumn("fields", F.create_map(F.lit("Text"), F.lit("old")))
    return c.Content(pages, rows, paras)


def stored(content):
    """The content with its rows and paragraphs as tables, as an environment has them: an apply reads them several times."""
    return replace(content, rows=cut(content.rows), paragraphs=cut(content.paragraphs))


def incoming(spark, d):
    """The whole site; pending orders stand on pages that do not exist."""
    whole = site(spark, d)
    pending = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("_order"))

    def astray(df, key):
        page = F.when(F.col("_order").isNotNull(), F.col("page_id") + 90000000).otherwise(F.col("page_id"))
        return df.join(pending, F.col(key) == F.col("_order"), "left").withColumn("page_id", page).drop("_order")

    return c.Content(whole.pages, astray(whole.rows, "row_id"), astray(whole.paragraphs, "para_id"))


IDS_SQL = f"""WITH nodes AS (SELECT id, parent, name, sort, kind, CASE WHEN sort = 50 THEN '2|' ELSE '1|' END || md5(CAST(id AS VARCHAR)) AS guid FROM ({TREE_SQL}) x),
  tgt AS (SELECT id + 7000000 AS id, guid FROM nodes WHERE sort > 15),
  fresh AS (SELECT guid, row_number() OVER (ORDER BY md5(guid), guid) AS n FROM nodes WHERE guid NOT IN (SELECT guid FROM tgt)),
  pg AS (SELECT nodes.id AS source_id, coalesce(tgt.id, (SELECT max(id) FROM tgt) + fresh.n) AS target_id, tgt.id IS NOT NULL AS old
         FROM nodes LEFT JOIN tgt USING (guid) LEFT JOIN fresh USING (guid)),
  sc AS (SELECT o_orderkey, o_custkey, t.target_id AS page, t.target_id || '|' || md5('r' || o_orderkey) AS r, t.target_id || '|' || md5('p' || o_orderkey) AS p,
         t.old AND o_orderstatus = 'F' AS known, (SELECT max(o_orderkey) + 5000000 FROM orders JOIN pg ON pg.source_id = o_custkey WHERE pg.old AND o_orderstatus = 'F') AS top
         FROM orders JOIN pg t ON t.source_id = o_custkey WHERE o_orderstatus <> 'P'),
  rw AS (SELECT o_orderkey, CASE WHEN known THEN o_orderkey + 5000000 ELSE top + row_number() OVER (PARTITION BY known ORDER BY md5(r), r) END AS row_id FROM sc),
  pa AS (SELECT o_orderkey, CASE WHEN known THEN o_orderkey + 5000000 ELSE top + row_number() OVER (PARTITION BY known ORDER BY md5(p), p) END AS para_id FROM sc)"""


@case(
    "e11_apply_content_pages",
    f"""{IDS_SQL} SELECT s.target_id AS page_id, p.target_id AS parent_id, n.name AS menu_text,
        'Default.aspx?ID=' || l.target_id AS shortcut, n.kind AS kind,
        CASE WHEN n.sort > 15 THEN 'updated' ELSE 'created' END AS outcome
        FROM nodes n JOIN pg s ON s.source_id = n.id LEFT JOIN pg p ON p.source_id = n.parent JOIN pg l ON l.source_id = n.sort""",
)
def _(spark, d):
    done = c.apply_content(stored(partly_known(spark, d)), incoming(spark, d))
    return done.content.pages.select("page_id", "parent_id", "menu_text", "shortcut", F.col("fields")["Kind"].alias("kind"), "outcome")


@case(
    "e11_apply_content_paragraphs",
    f"""{IDS_SQL} SELECT pa.para_id, sc.page AS page_id, rw.row_id, 'see Default.aspx?ID=' || sc.page || '#' || pa.para_id AS text,
        CASE WHEN known THEN 'updated' ELSE 'created' END AS outcome
        FROM sc JOIN rw USING (o_orderkey) JOIN pa USING (o_orderkey)""",
)
def _(spark, d):
    done = c.apply_content(stored(partly_known(spark, d)), incoming(spark, d))
    return done.content.paragraphs.select("para_id", "page_id", "row_id", F.col("fields")["Text"].alias("text"), "outcome")


@case(
    "e11_apply_content_failed",
    """SELECT t AS table_name, o_orderkey AS source_id, 'failed' AS outcome, 'unknown page ' || (o_custkey + 90000000) AS warning
       FROM orders, (VALUES ('rows'), ('paragraphs')) k(t) WHERE o_orderstatus = 'P'""",
)
def _(spark, d):
    return c.apply_content(stored(partly_known(spark, d)), incoming(spark, d)).failed


@case(
    "e11_content_diffs",
    f"""SELECT CASE WHEN sort = 50 THEN 2 ELSE 1 END AS area_id, md5(CAST(id AS VARCHAR)) AS guid, 'menu_text' AS col, 'old' AS old_value, name AS new_value
        FROM ({TREE_SQL}) x WHERE sort > 15""",
)
def _(spark, d):
    return c.content_diffs(partly_known(spark, d), incoming(spark, d))
