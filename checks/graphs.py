"""Integrity (G) and trees (H)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import TREE_SQL, case, part_tree, table
from tablesync.operators import integrity, intervals, tree
from tablesync.spec import PathRule

GOOD = "SELECT * FROM customer WHERE c_acctbal >= 0"


def solvent(spark, d):
    return table(spark, d, "customer").where("c_acctbal >= 0")


@case("g1_fk_orphans", f"SELECT o.* FROM orders o WHERE o_custkey NOT IN (SELECT c_custkey FROM ({GOOD}) c)")
def _(spark, d):
    return integrity.fk_orphans(table(spark, d, "orders"), solvent(spark, d), "o_custkey", "c_custkey")


@case(
    "g2_delete_cascade",
    f"""WITH v AS (SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM ({GOOD}) c))
        SELECT 'orders' AS table_name, count(*) AS n, sum(o_orderkey) AS keys FROM orders WHERE o_orderkey NOT IN (SELECT * FROM v)
        UNION ALL SELECT 'lineitem', count(*), sum(l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM v)""",
)
def _(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    victims = integrity.victims_in_orphan_areas(orders, solvent(spark, d), "o_orderkey", "o_custkey", "c_custkey")
    kept = integrity.delete_cascade({"orders": (orders, "o_orderkey"), "lineitem": (lines, "l_orderkey")}, victims, "o_orderkey")
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    parts = [
        df.agg(F.count("*").alias("n"), F.sum(keys[n]).alias("keys")).select(F.lit(n).alias("table_name"), "n", "keys")
        for n, df in kept.items()
    ]
    return reduce(DataFrame.unionByName, parts)


EDGES_SQL = f"""SELECT id AS child, parent FROM ({TREE_SQL}) t WHERE parent IS NOT NULL
  UNION SELECT id, CAST(floor(id / 3.0) AS BIGINT) FROM ({TREE_SQL}) t"""


@case(
    "g3_dependency_levels",
    f"""WITH RECURSIVE e AS (SELECT * FROM ({EDGES_SQL}) x WHERE child <> parent),
        w AS (SELECT id, 0 AS level FROM ({TREE_SQL}) t UNION SELECT e.child, w.level + 1 FROM e JOIN w ON e.parent = w.id)
        SELECT 'T' || id AS name, max(level) AS level FROM w GROUP BY id""",
)
def _(spark, d):
    nodes = part_tree(spark, d)
    name = lambda c: F.concat(F.lit("T"), c.cast("string"))
    edges = nodes.where("parent is not null").select("id", "parent")
    edges = edges.unionByName(nodes.select("id", F.floor(F.col("id") / 3).alias("parent")))
    # Parents in another spelling, and one outside the set.
    edges = edges.select(name(F.col("id")).alias("child"), F.lower(name(F.col("parent"))).alias("parent"))
    edges = edges.unionByName(nodes.select(name(F.col("id")).alias("child"), F.lit("elsewhere").alias("parent")))
    return integrity.dependency_levels(nodes.select(name(F.col("id")).alias("name")), edges)


@case(
    "g4_dangling_pairs",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS item_id,
       CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS item_type FROM orders""",
)
def _(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("item_id"), kind.alias("item_type"))
    return integrity.dangling_pairs(rows, "item_id", "item_type")[0]


@case("g4_dangling_pairs_count", "SELECT count(*) AS cleared FROM orders WHERE o_orderstatus = 'F'")
def _(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderpriority"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("item_id"), kind.alias("item_type"))
    return integrity.dangling_pairs(rows, "item_id", "item_type")[1]


@case("g5_assert_count", "SELECT * FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')")
def _(spark, d):
    rows = table(spark, d, "orders")
    stale = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    total = rows.count()
    found = integrity.assert_count(rows.where(stale), 1, total // 2, "before", zero_ok=False)
    kept = integrity.delete_where(rows, stale)
    integrity.assert_count(kept, total - found, stage="after")
    return kept


@case("g6_delete_where", "SELECT * FROM orders WHERE NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P')")
def _(spark, d):
    stale = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_orderstatus") == "P")
    return integrity.delete_where(table(spark, d, "orders"), stale)


@case(
    "g7_orphans_by_group",
    f"SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM ({GOOD}) c) GROUP BY 1",
)
def _(spark, d):
    return integrity.orphans_by_group(table(spark, d, "orders"), solvent(spark, d), "o_custkey", "c_custkey")


PATH_SQL = f"""WITH RECURSIVE nodes AS ({TREE_SQL}), p AS (SELECT id, '/' || name AS path, 1 AS depth FROM nodes WHERE parent IS NULL
  UNION ALL SELECT n.id, p.path || '/' || n.name, p.depth + 1 FROM nodes n JOIN p ON n.parent = p.id)"""


@case("h1_build_paths", f"{PATH_SQL} SELECT id, path, depth FROM p")
def _(spark, d):
    return tree.build_paths(part_tree(spark, d), "id", "parent", "name")


DOWN_SQL = f"""WITH RECURSIVE nodes AS ({TREE_SQL}), down AS (SELECT id FROM nodes WHERE kind = 'SMALL' AND sort > 30
  UNION SELECT n.id FROM nodes n JOIN down ON n.parent = down.id)"""


@case("h2_subtree", f"{DOWN_SQL} SELECT id FROM down")
def _(spark, d):
    nodes = part_tree(spark, d)
    return tree.subtree(nodes, "id", "parent", nodes.where("kind = 'SMALL' and sort > 30"), "id")


@case(
    "h3_filter_tree",
    f"""WITH RECURSIVE nodes AS ({TREE_SQL}), p AS (SELECT id, '/' || name AS path FROM nodes WHERE parent IS NULL AND kind IN (SELECT kind FROM nodes)
        UNION ALL SELECT n.id, p.path || '/' || n.name FROM nodes n JOIN p ON n.parent = p.id
        WHERE NOT (p.path || '/' || n.name || '/' LIKE (SELECT '/' || name FROM nodes WHERE id = 0) || '/' || (SELECT name FROM nodes WHERE id = 1) || '/%')
          AND n.sort <> 50) SELECT id, path FROM p""",
)
def _(spark, d):
    nodes = part_tree(spark, d).withColumn("area", F.when(F.col("sort") == 50, 2).otherwise(1))
    root, child = (nodes.where(F.col("id") == i).first()["name"] for i in (0, 1))  # two names, for a rule
    nodes = nodes.withColumn("area", F.when(F.col("parent").isNull(), 1).otherwise(F.col("area")))
    rules = [PathRule(1, "/", (f"/{root}/{child}".upper(),))]
    return tree.filter_tree(nodes, "id", "parent", "name", "area", rules)


@case(
    "h4_assemble_rows",
    """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY month(o_orderdate), o_orderkey) AS row_no FROM orders),
       l AS (SELECT l_orderkey, l_linenumber, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey AS para_id,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_quantity AS INT),
               ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) AS para_no FROM lineitem)
       SELECT o_custkey, o_orderkey, row_no, coalesce(l_linenumber, 1) AS column_id, para_no, para_id
       FROM r LEFT JOIN l ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.month("o_orderdate").alias("sort"))
    para_id = ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 1000 + F.col("l_suppkey")
    paras = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("psort"), para_id.alias("pid")
    )
    return tree.assemble_rows(rows, paras, "o_custkey", "o_orderkey", "sort", "l_orderkey", "l_linenumber", "psort", "pid")


@case(
    "h5_flatten_tree",
    """WITH s AS (SELECT doc_id, lang, string_split(text, chr(10)) AS parts FROM documents)
       SELECT doc_id, lang AS row_id, 1 AS column_id, unnest(range(1, len(parts) + 1)) AS para_no, unnest(parts) AS content FROM s""",
)
def _(spark, d):
    lines = F.split("text", "\n", -1)
    paras = F.transform(lines, lambda t, i: F.struct((i + 1).cast("long").alias("para_no"), t.alias("content")))
    columns = F.array(F.struct(F.lit(1).alias("column_id"), paras.alias("paragraphs")))
    nested = table(spark, d, "documents").select("doc_id", F.array(F.struct(F.col("lang").alias("row_id"), columns.alias("columns"))).alias("rows"))
    return tree.flatten_tree(nested, ["doc_id"])


@case(
    "h6_renumber",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY month(o_orderdate), o_orderkey) AS row_no FROM orders",
)
def _(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.month("o_orderdate").alias("sort"))
    return tree.renumber(rows, "o_custkey", "sort", "o_orderkey").drop("sort")


@case(
    "h7_assign_columns",
    """WITH c AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O'),
       f AS (SELECT l_orderkey, min(l_linenumber) AS first FROM c GROUP BY 1)
       SELECT l.l_orderkey, coalesce(c.l_linenumber, f.first) AS l_linenumber, l.l_partkey FROM
         (SELECT l_orderkey, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS l_linenumber, l_partkey FROM lineitem) l
       JOIN f ON f.l_orderkey = l.l_orderkey LEFT JOIN c ON c.l_orderkey = l.l_orderkey AND c.l_linenumber = l.l_linenumber""",
)
def _(spark, d):
    lines = table(spark, d, "lineitem")
    column = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    paras = lines.select("l_orderkey", column.alias("l_linenumber"), "l_partkey")
    columns = lines.where("l_linestatus = 'O'").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("ord")).distinct()
    return tree.assign_columns(paras, columns, "l_orderkey", "l_linenumber")


@case(
    "h8_tree_counts",
    f"""{DOWN_SQL} SELECT 'nodes' AS kind, count(*) AS n FROM down
        UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_partkey IN (SELECT id FROM down)""",
)
def _(spark, d):
    nodes = part_tree(spark, d)
    roots = nodes.where("kind = 'SMALL' and sort > 30")
    return tree.tree_counts(nodes, "id", "parent", roots, "id", {"lines": (table(spark, d, "lineitem"), "l_partkey")})


def _digits(col: str) -> str:
    return f"lpad(CAST(CAST({col} AS HUGEINT) + 9223372036854775808 AS VARCHAR), 20, '0')"


def _tree_key(a: str) -> str:
    return f"{_digits(f'{a}.sort')} || chr(1) || lower({a}.name) || chr(1) || {_digits(f'{a}.id')} || chr(2)"


@case(
    "h9_ordered_tree",
    f"""WITH RECURSIVE nodes AS ({TREE_SQL}), p AS (SELECT id, {_tree_key("nodes")} AS tree_key, 1 AS depth FROM nodes WHERE parent IS NULL
        UNION ALL SELECT n.id, p.tree_key || {_tree_key("n")}, p.depth + 1 FROM nodes n JOIN p ON n.parent = p.id)
        SELECT id, depth, tree_key FROM p""",
)
def _(spark, d):
    return tree.ordered_tree(part_tree(spark, d), "id", "parent", "sort", "name")


@case("h9_sorted_fields", "SELECT p_partkey, 'Alpha=' || p_brand || ',Beta=' || p_type || ',gamma=' || p_size AS fields FROM part")
def _(spark, d):
    fields = F.create_map(F.lit("gamma"), F.col("p_size").cast("string"), F.lit("Beta"), F.col("p_type"), F.lit("Alpha"), F.col("p_brand"))
    entries = F.map_entries(tree.sorted_fields(fields))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return table(spark, d, "part").select("p_partkey", text.alias("fields"))


# A tree with links back: every 40th node's parent waits for it, and every 75th one's grandparent, so cycles of different lengths meet.
RINGS_SQL = f"""SELECT child, parent FROM ({EDGES_SQL}) e WHERE child <> parent
  UNION SELECT CAST(floor(id / 3.0) AS BIGINT), id FROM ({TREE_SQL}) t WHERE id > 0 AND id % 40 = 0
  UNION SELECT CAST(floor(floor(id / 3.0) / 3.0) AS BIGINT), id FROM ({TREE_SQL}) t WHERE id > 8 AND id % 75 = 0"""


@case(
    "g3_dependency_cycles",
    f"""WITH RECURSIVE e AS ({RINGS_SQL}),
        back AS (SELECT DISTINCT e.parent AS id FROM e WHERE e.parent > e.child),
        r(a, b) AS (SELECT child, parent FROM e UNION SELECT r.a, e.parent FROM r JOIN e ON e.child = r.b),
        on_one AS (SELECT a FROM r WHERE a = b)
        SELECT 'T' || x.a AS name, min('t' || y.b) AS cycle FROM on_one x JOIN r y ON y.a = x.a JOIN r z ON z.a = y.b AND z.b = x.a GROUP BY 1""",
)
def _(spark, d):
    nodes = part_tree(spark, d)
    name = lambda c: F.concat(F.lit("T"), c.cast("string"))
    up = nodes.where("parent is not null").select("id", "parent").unionByName(nodes.select("id", F.floor(F.col("id") / 3).alias("parent")))
    third = F.floor(F.col("id") / 3)
    back = nodes.where("id > 0 and id % 40 = 0").select(third.alias("id"), F.col("id").alias("parent"))
    far = nodes.where("id > 8 and id % 75 = 0").select(F.floor(third / 3).alias("id"), F.col("id").alias("parent"))
    edges = up.unionByName(back).unionByName(far).select(name(F.col("id")).alias("child"), F.lower(name(F.col("parent"))).alias("parent"))
    rows = integrity.dependency_cycles(nodes.select(name(F.col("id")).alias("name")), edges)
    return rows.select("name", F.lower("cycle").alias("cycle"))


@case("h2_subtree_by_labels", f"{DOWN_SQL} SELECT id AS node_id FROM down")
def _(spark, d):
    nodes = part_tree(spark, d)
    labels = intervals.label_tree(nodes, "id", "parent", F.col("name"))
    return intervals.subtree_by_labels(labels, nodes.where("kind = 'SMALL' and sort > 30"), "id")


@case("h3_survivors_by_labels", f"{DOWN_SQL} SELECT p_partkey AS node_id FROM part WHERE p_partkey NOT IN (SELECT id FROM down)")
def _(spark, d):
    nodes = part_tree(spark, d)
    labels = intervals.label_tree(nodes, "id", "parent", F.col("name"))
    return intervals.survivors_by_labels(labels, nodes.where("kind = 'SMALL' and sort > 30"), "id")


@case(
    "h8_counts_by_labels",
    f"""WITH RECURSIVE nodes AS ({TREE_SQL}), up(id, top) AS (SELECT id, id FROM nodes
          UNION ALL SELECT up.id, n.parent FROM up JOIN nodes n ON n.id = up.top WHERE n.parent IS NOT NULL)
        SELECT top AS node_id, count(*) AS n FROM up GROUP BY top""",
)
def _(spark, d):
    return intervals.counts_by_labels(intervals.label_tree(part_tree(spark, d), "id", "parent", F.col("name")))
