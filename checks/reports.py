"""Manifests, gates, reports (J) and permissions (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import ORDERS, PAIR_SQL, case, incoming_orders, live_orders, orders, table
from checks.graphs import GOOD, solvent
from tablesync.operators import identity, integrity, permissions, quality

ASSETS_SQL = """SELECT DISTINCT kind, path, referenced_by FROM (
  SELECT 'page-layout' AS kind, p_type AS path, p_brand AS referenced_by FROM part
  UNION ALL SELECT 'item-type', p_name, p_brand FROM part
  UNION ALL SELECT 'item-type', CASE WHEN p_size > 45 THEN '../' || p_type ELSE '' END, p_name FROM part) a WHERE path <> ''"""


def assets(spark, d):
    parts = table(spark, d, "part")
    odd = parts.select(F.when(F.col("p_size") > 45, F.concat(F.lit("../"), "p_type")).otherwise("").alias("path"), "p_name")
    return quality.asset_refs(
        [(parts, "page-layout", "p_type", "p_brand"), (parts, "item-type", "p_name", "p_brand"), (odd, "item-type", "path", "p_name")]
    )


@case("j1_asset_refs", ASSETS_SQL)
def _(spark, d):
    return assets(spark, d)


BAD_SQL = f"""WITH a AS ({ASSETS_SQL}), have AS (SELECT 'item-type' AS kind, p_name AS path FROM part WHERE p_size < 5)
  SELECT *, CASE WHEN path LIKE '%..%' THEN 'unsafe path' ELSE 'missing' END AS problem FROM a
  WHERE path LIKE '%..%' OR (kind, path) NOT IN (SELECT kind, path FROM have)"""


def missing(spark, d):
    have = table(spark, d, "part").where("p_size < 5").select(F.lit("item-type").alias("kind"), F.col("p_name").alias("path"))
    return quality.missing_assets(assets(spark, d), have)


@case("j2_missing_assets", BAD_SQL)
def _(spark, d):
    return missing(spark, d)


@case("j2_users_per_asset", f"SELECT kind, path, count(*) AS n_users FROM ({BAD_SQL}) b GROUP BY kind, path")
def _(spark, d):
    return quality.users_per_asset(missing(spark, d))


@case(
    "j3_assert_no_warnings",
    f"""WITH w AS (SELECT 'unknown id ' || o_custkey AS warning, count(*) AS n FROM orders
          WHERE o_custkey > 0 AND o_custkey NOT IN (SELECT c_custkey FROM ({GOOD}) c) GROUP BY o_custkey)
        SELECT warning, n, (SELECT count(*) FROM w) AS told FROM w""",
)
def _(spark, d):
    dim = solvent(spark, d)
    warnings = identity.resolve_guid(table(spark, d, "orders"), "o_custkey", dim, "c_custkey", "c_name", "guid")[1]
    quality.assert_no_warnings(warnings, strict=False)
    try:
        quality.assert_no_warnings(warnings)
        return warnings.limit(0)
    except quality.StrictModeError as e:
        n, where = int(str(e).split(" ")[0]), str(e).rsplit(" ", 1)[1]
    listed = spark.read.parquet(where)  # every warning, where the error says
    return listed.select("warning", F.col("rows").alias("n"), F.lit(n).cast("long").alias("told"))


@case(
    "j4_run_summary",
    f"""{PAIR_SQL}, o AS (SELECT i.o_orderpriority AS table_name, CASE WHEN t.o_orderkey IS NULL THEN 'created'
        WHEN t.o_orderpriority = i.o_orderpriority THEN 'skipped' ELSE 'updated' END AS outcome
        FROM inc i LEFT JOIN live t ON t.o_orderkey = i.o_orderkey)
        SELECT coalesce(table_name, '(total)') AS table_name, count(*) FILTER (WHERE outcome = 'created') AS created,
          count(*) FILTER (WHERE outcome = 'updated') AS updated, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
          count(*) FILTER (WHERE outcome = 'failed') AS failed FROM o GROUP BY ROLLUP (table_name)""",
)
def _(spark, d):
    rows = identity.classify_changes(incoming_orders(spark, d), live_orders(spark, d), ORDERS)
    return quality.run_summary(rows.select(F.col("o_orderpriority").alias("table_name"), "outcome"))


@case(
    "j5_advice",
    """WITH e AS (SELECT 'T' || user_id AS table_name, CASE event_type WHEN 'click' THEN 'conflict with Foreign Key constraint'
          WHEN 'view' THEN 'Group ' || user_id || ' not found' WHEN 'error' THEN 'duplicate row' WHEN 'signup' THEN '  ' ELSE event_type END AS error FROM events)
       SELECT NULL AS table_name, 'run' AS kind, 'The run itself failed: no space left' AS advice
       UNION ALL SELECT NULL, 'again', 'Run again once this is done; what is applied already will be skipped'
       UNION ALL SELECT DISTINCT table_name, CASE WHEN error ILIKE '%foreign key%' THEN 'foreign key' WHEN error ILIKE 'group%' THEN 'missing group'
          WHEN error LIKE 'duplicate%' THEN 'duplicate key' ELSE 'other' END AS kind,
        CASE WHEN error ILIKE '%foreign key%' THEN 'Apply the parents of ' || table_name || ' first'
          WHEN error ILIKE 'group%' THEN 'Create the group that ' || table_name || ' refers to'
          WHEN error LIKE 'duplicate%' THEN 'Make the name column of ' || table_name || ' unique'
          ELSE 'Error in ' || table_name || ': ' || error END AS advice FROM e WHERE trim(error) <> ''""",
)
def _(spark, d):
    kind = F.col("event_type")
    error = (
        F.when(kind == "click", "conflict with Foreign Key constraint")
        .when(kind == "view", F.concat(F.lit("Group "), F.col("user_id").cast("string"), F.lit(" not found")))
        .when(kind == "error", "duplicate row")
        .when(kind == "signup", "  ")
        .otherwise(kind)
    )
    name = F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("table_name")
    run = spark.createDataFrame([(None, "no space left")], "table_name string, error string")
    return quality.advice(table(spark, d, "events").select(name, error.alias("error")).unionByName(run))


@case(
    "j6_secret_scan",
    """SELECT doc_id, 'text' AS col, 'text' AS reason FROM documents WHERE regexp_matches(text, '(?i)password|secret|token|apikey|privatekey')
       UNION ALL SELECT doc_id, 'ApiToken', 'name' FROM documents WHERE trim(lang) <> ''""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("lang").alias("ApiToken"))
    return quality.secret_scan(docs, ["doc_id"])


@case(
    "j7_reconcile",
    f"""{PAIR_SQL} SELECT count(i.o_orderkey) AS source_rows, count(t.o_orderkey) AS target_rows,
        count(*) FILTER (WHERE i.o_orderpriority = t.o_orderpriority) AS equal_rows,
        count(*) FILTER (WHERE i.o_orderpriority <> t.o_orderpriority) AS different_rows,
        count(*) FILTER (WHERE t.o_orderkey IS NULL) AS only_source, count(*) FILTER (WHERE i.o_orderkey IS NULL) AS only_target
        FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey""",
)
def _(spark, d):
    return quality.reconcile(incoming_orders(spark, d), live_orders(spark, d), ORDERS)


@case(
    "j8_verify_post",
    f"""SELECT check_name, n, n = 0 AS ok FROM (
        SELECT 'orders without customer' AS check_name, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM ({GOOD}) c)) AS n
        UNION ALL SELECT 'lines without order', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
        UNION ALL SELECT 'pending orders', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')) x""",
)
def _(spark, d):
    rows = orders(spark, d)
    return quality.verify_post(
        {
            "orders without customer": integrity.fk_orphans(rows, solvent(spark, d), "o_custkey", "c_custkey"),
            "lines without order": integrity.fk_orphans(table(spark, d, "lineitem"), rows, "l_orderkey", "o_orderkey"),
            "pending orders": rows.where("o_orderstatus = 'P'"),
        }
    )


LEVEL_SQL = "CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 1364 ELSE 77 END"
GROUP_SQL = "SELECT n_nationkey AS group_id, CASE WHEN n_regionkey = 4 THEN '' ELSE upper(n_name) END AS name FROM nation"


def groups(spark, d):
    name = F.when(F.col("n_regionkey") == 4, "").otherwise(F.upper("n_name"))
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("group_id"), name.alias("name"))


def level():
    rest = F.col("event_id") % 4
    return F.when(rest == 0, 1).when(rest == 1, 4).when(rest == 2, 1364).otherwise(77)


@case(
    "k1_export_permissions",
    f"""WITH p AS (SELECT event_id, user_id AS page_id, CASE event_type WHEN 'view' THEN 'anonymous' WHEN 'click' THEN 'Administrator'
          WHEN 'error' THEN 'staff' ELSE CAST(user_id % 40 AS VARCHAR) END AS owner_id, {LEVEL_SQL} AS level_value FROM events),
        g AS ({GROUP_SQL})
        SELECT page_id, CASE WHEN owner_id IN ('anonymous', 'Administrator') THEN owner_id ELSE coalesce(g.name, owner_id) END AS owner,
          CASE WHEN owner_id IN ('anonymous', 'Administrator') THEN 'role' ELSE 'group' END AS owner_type,
          CASE WHEN owner_id NOT IN ('anonymous', 'Administrator') THEN owner_id END AS owner_id,
          CASE level_value WHEN 1 THEN 'none' WHEN 4 THEN 'read' WHEN 1364 THEN 'all' ELSE '77' END AS level, level_value
        FROM p LEFT JOIN g ON g.name <> '' AND g.group_id = TRY_CAST(owner_id AS INT)""",
)
def _(spark, d):
    kind = F.col("event_type")
    owner = (
        F.when(kind == "view", "anonymous").when(kind == "click", "Administrator").when(kind == "error", "staff")
        .otherwise((F.col("user_id") % 40).cast("string"))
    )
    perms = table(spark, d, "events").select(F.col("user_id").alias("page_id"), owner.alias("owner_id"), level().alias("level_value"))
    return permissions.export_permissions(perms, groups(spark, d))


PERMS_SQL = f"""SELECT event_id, user_id AS page_id, CASE WHEN event_type = 'view' THEN 'Anonymous'
    WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'lost group' ELSE 'Nation_' || (user_id % 20) END AS owner,
  CASE WHEN event_type = 'view' THEN 'role' ELSE 'group' END AS owner_type,
  CASE {LEVEL_SQL} WHEN 1 THEN 'None' WHEN 4 THEN 'READ' WHEN 1364 THEN 'all' ELSE 'odd' END AS level, 55 AS level_value FROM events"""

RULES_SQL = f"""WITH p AS ({PERMS_SQL}), g AS (SELECT lower(name) AS n, min(group_id) AS gid FROM ({GROUP_SQL}) x WHERE name <> '' GROUP BY 1),
  j AS (SELECT p.*, g.gid, CASE lower(level) WHEN 'none' THEN 1 WHEN 'read' THEN 4 WHEN 'all' THEN 1364 ELSE level_value END AS v
        FROM p LEFT JOIN g ON owner_type = 'group' AND g.n = lower(owner)),
  s AS (SELECT page_id, CASE WHEN owner_type = 'role' THEN owner ELSE CAST(gid AS VARCHAR) END AS owner, v, 0 AS deny, event_id FROM j
        WHERE owner_type = 'role' OR gid IS NOT NULL
        UNION ALL SELECT DISTINCT page_id, 'Anonymous', 1, 1, CAST(0 AS BIGINT) FROM j WHERE owner_type = 'group' AND gid IS NULL),
  r AS (SELECT *, row_number() OVER (PARTITION BY page_id, lower(owner) ORDER BY deny DESC, event_id DESC) AS n FROM s)"""


def perms(spark, d):
    kind, user = F.col("event_type"), F.col("user_id")
    owner = F.when(kind == "view", "Anonymous").when((kind == "error") & (user % 3 == 0), "lost group").otherwise(
        F.concat(F.lit("Nation_"), (user % 20).cast("string"))
    )
    code = level()
    name = F.when(code == 1, "None").when(code == 4, "READ").when(code == 1364, "all").otherwise("odd")
    return table(spark, d, "events").select(
        "event_id", user.alias("page_id"), owner.alias("owner"),
        F.when(kind == "view", "role").otherwise("group").alias("owner_type"), name.alias("level"), F.lit(55).alias("level_value"),
    )


@case("k2_import_permissions", f"{RULES_SQL} SELECT page_id, owner, v AS level_value FROM r WHERE n = 1")
def _(spark, d):
    return permissions.import_permissions(perms(spark, d), groups(spark, d), "event_id")[0]


@case(
    "k2_import_permissions_warnings",
    f"""{RULES_SQL} SELECT owner AS group_name, count(*) AS n, 'group ''' || owner || ''' not found on target' AS warning
        FROM j WHERE owner_type = 'group' AND gid IS NULL GROUP BY owner""",
)
def _(spark, d):
    return permissions.import_permissions(perms(spark, d), groups(spark, d), "event_id")[1]
