"""Identity, change detection and id maps (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import CHECKSUM_SQL, ORDERS, PAIR_SQL, case, incoming_orders, live_orders, orders, table
from tablesync.operators import identity
from tablesync.spec import TableSpec

LINES = TableSpec("lineitem", keys=("l_orderkey", "L_LINENUMBER"))
BY_NAME = TableSpec("part", keys=("p_partkey",), name_col="p_name", compare_cols=("p_name", "p_brand", "p_size"))


@case("d1_row_identity", "SELECT l_orderkey, l_linenumber, l_linenumber || '$$' || l_orderkey AS identity FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", identity.row_identity(lines, LINES).alias("identity"))


@case(
    "d2_row_checksum",
    f"""SELECT o.o_orderkey, {CHECKSUM_SQL.format(a="o")} AS checksum FROM
        (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         o_orderpriority FROM orders) o""",
)
def _(spark, d):
    rows = orders(spark, d).drop("o_orderdate")
    return rows.select("o_orderkey", identity.row_checksum(rows, ORDERS).alias("checksum"))


@case(
    "d3_classify_changes",
    f"""{PAIR_SQL} SELECT i.o_orderkey, CASE WHEN {CHECKSUM_SQL.format(a="i")} = {CHECKSUM_SQL.format(a="t")} THEN 'skipped'
        WHEN t.o_orderkey IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome
        FROM inc i LEFT JOIN live t ON t.o_orderkey = i.o_orderkey""",
)
def _(spark, d):
    rows = identity.classify_changes(incoming_orders(spark, d), live_orders(spark, d), ORDERS)
    return rows.select("o_orderkey", "outcome")


# Parts go by their name here, which many of them share: the highest key stands for the name.
NAME_SQL = """WITH live AS (SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_size <= 40),
  inc AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_brand = 'Brand#7' THEN 0 ELSE p_size END AS p_size FROM part WHERE p_size >= 10),
  last AS (SELECT arg_max(p_brand, p_partkey) AS b, arg_max(p_size, p_partkey) AS z, lower(trim(p_name)) AS n FROM live GROUP BY 3)"""


def named_parts(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    size = F.when(F.col("p_brand") == "Brand#7", 0).otherwise(F.col("p_size"))
    return parts.where("p_size <= 40"), parts.where("p_size >= 10").withColumn("p_size", size)


@case(
    "d3_classify_by_name",
    f"""{NAME_SQL} SELECT i.p_partkey, CASE WHEN l.b = i.p_brand AND l.z = i.p_size THEN 'skipped'
        WHEN k.p_partkey IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome
        FROM inc i LEFT JOIN last l ON l.n = lower(trim(i.p_name)) LEFT JOIN live k ON k.p_partkey = i.p_partkey""",
)
def _(spark, d):
    live, inc = named_parts(spark, d)
    return identity.classify_changes(inc, live, BY_NAME).select("p_partkey", "outcome")


@case(
    "d4_duplicate_identities",
    """SELECT min(n) AS identity, count(*) AS n FROM (
         SELECT trim(CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END) AS n FROM part) p GROUP BY lower(n) HAVING count(*) > 1""",
)
def _(spark, d):
    name = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name"))
    return identity.duplicate_identities(table(spark, d, "part").withColumn("p_name", name), BY_NAME)


def guids(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.md5("c_name").alias("guid"), "c_acctbal", "c_mktsegment", "c_nationkey"
    )


@case(
    "d5_resolve_guid",
    """SELECT o_orderkey, CASE WHEN c_custkey > 0 THEN md5(c_name) END AS guid FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey""",
)
def _(spark, d):
    dim = guids(spark, d).where("c_acctbal >= 0")
    rows, _ = identity.resolve_guid(table(spark, d, "orders"), "o_custkey", dim, "id", "guid", "guid")
    return rows.select("o_orderkey", "guid")


@case(
    "d5_resolve_guid_warnings",
    """SELECT o_custkey AS id, count(*) AS "rows", 'unknown id ' || o_custkey AS warning FROM orders
       WHERE o_custkey > 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
)
def _(spark, d):
    dim = guids(spark, d).where("c_acctbal >= 0")
    return identity.resolve_guid(table(spark, d, "orders"), "o_custkey", dim, "id", "guid", "guid")[1]


MAP_SQL = """SELECT c_custkey AS source_id, c_custkey + 100000 AS target_id FROM customer
  WHERE c_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'"""


def customer_map(spark, d):
    """Source id → target id: furniture customers have no id at the source, debtors none at the target."""
    rows = guids(spark, d)
    source = rows.withColumn("id", F.when(F.col("c_mktsegment") != "FURNITURE", F.col("id")))
    target = rows.where("c_acctbal >= 0").select((F.col("id") + 100000).alias("id"), F.upper("guid").alias("guid"))
    return identity.build_id_map(source, target)


@case("d6_build_id_map", MAP_SQL)
def _(spark, d):
    return customer_map(spark, d)


@case(
    "d7_union_id_maps",
    f"""WITH a AS ({MAP_SQL}), b AS (SELECT c_custkey AS source_id, c_custkey + 500000 AS target_id FROM customer WHERE c_nationkey > 9)
        SELECT source_id, target_id FROM a UNION ALL SELECT source_id, target_id FROM b
        WHERE source_id NOT IN (SELECT source_id FROM a)""",
)
def _(spark, d):
    later = table(spark, d, "customer").where("c_nationkey > 9")
    later = later.select(F.col("c_custkey").alias("source_id"), (F.col("c_custkey") + 500000).alias("target_id"))
    return identity.union_id_maps([customer_map(spark, d), later])


@case(
    "d8_allocate_ids",
    """WITH c AS (SELECT c_custkey AS id, md5(c_name) AS guid, c_acctbal FROM customer),
       t AS (SELECT id, guid FROM c WHERE c_acctbal >= 0),
       f AS (SELECT guid, row_number() OVER (ORDER BY md5(guid), guid) AS n FROM c WHERE guid NOT IN (SELECT guid FROM t))
       SELECT c.guid, coalesce(t.id, (SELECT max(id) FROM t) + f.n) AS target_id, t.id IS NULL AS is_new
       FROM c LEFT JOIN t USING (guid) LEFT JOIN f USING (guid)
       UNION ALL SELECT NULL, NULL, NULL FROM supplier""",
)
def _(spark, d):
    rows = guids(spark, d).select("id", "guid", "c_acctbal")
    nameless = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit(None).cast("string").alias("guid"), F.lit(0.0).alias("c_acctbal"))
    return identity.allocate_ids(rows.unionByName(nameless), rows.where("c_acctbal >= 0")).select("guid", "target_id", "is_new")
