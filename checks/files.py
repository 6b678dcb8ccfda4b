"""Tables in files: merges that rewrite only what they touch, versions, and comparing by digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import DROP_SQL, LIVE_SQL, ORDERS, PAIR_SQL, SEED_SQL, case, incoming_orders, live_orders, unset_orders
from checks.merges import FILLED, MERGED
from tablesync.operators.digests import reconcile_by_digest
from tablesync.operators.placement import work_path
from tablesync.sources.chain import SnapshotChain
from tablesync.sources.filetable import FileTable

ROWS_PER_FILE = 5_000


def filed(rows) -> FileTable:
    return FileTable.create(rows, work_path(rows.sparkSession, "table"), ORDERS, ROWS_PER_FILE)


@case(
    "e1_upsert_files",
    f"{PAIR_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {MERGED} FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey",
)
def _(spark, d):
    target = filed(live_orders(spark, d))
    target.upsert(incoming_orders(spark, d))
    return target.read()


@case(
    "e2_seed_fill_files",
    f"{SEED_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {FILLED} FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey",
)
def _(spark, d):
    target = filed(unset_orders(spark, d))
    target.seed_fill(incoming_orders(spark, d))
    return target.read()


@case(
    "e4_update_subset_files",
    f"""{PAIR_SQL} SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
        CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
        FROM live t LEFT JOIN inc i ON i.o_orderkey = t.o_orderkey""",
)
def _(spark, d):
    target = filed(live_orders(spark, d))
    target.update_subset(incoming_orders(spark, d), ["o_orderpriority"])
    return target.read()


@case("a6_remove_stale_files", f"WITH live AS ({LIVE_SQL}), inc AS ({DROP_SQL}) SELECT * FROM live WHERE o_orderkey IN (SELECT o_orderkey FROM inc)")
def _(spark, d):
    """Rows that the later run did not write are taken out by key."""
    rows = live_orders(spark, d)
    target = filed(rows)
    target.remove(rows.join(incoming_orders(spark, d), "o_orderkey", "left_anti").select("o_orderkey"))
    return target.read()


@case(
    "a3_versions",
    f"""{PAIR_SQL} SELECT 0 AS version, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers FROM live
        UNION ALL SELECT 1, count(*), CAST(sum(coalesce(i.o_custkey, t.o_custkey)) AS BIGINT) FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey
        UNION ALL SELECT 2, count(*), CAST(sum(o_custkey) AS BIGINT) FROM inc""",
)
def _(spark, d):
    """Versions 0 (the target), 1 (with the incoming rows) and 2 (without what only the target had) are all readable."""
    rows, incoming = live_orders(spark, d), incoming_orders(spark, d)
    target = filed(rows)
    target.upsert(incoming)
    target.remove(rows.join(incoming, "o_orderkey", "left_anti"))
    parts = [target.read(v).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers")).select(F.lit(v).alias("version"), "n", "customers") for v in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


RECONCILED = f"""{PAIR_SQL} SELECT count(i.o_orderkey) AS source_rows, count(t.o_orderkey) AS target_rows,
  count(*) FILTER (WHERE i.o_orderpriority = t.o_orderpriority) AS equal_rows,
  count(*) FILTER (WHERE i.o_orderpriority <> t.o_orderpriority) AS different_rows,
  count(*) FILTER (WHERE t.o_orderkey IS NULL) AS only_source, count(*) FILTER (WHERE i.o_orderkey IS NULL) AS only_target
  FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey"""


@case("j7_reconcile_by_digest", RECONCILED)
def _(spark, d):
    return reconcile_by_digest(incoming_orders(spark, d), live_orders(spark, d), ORDERS)


@case("j7_reconcile_files", RECONCILED.replace("live t", "(SELECT * FROM live WHERE o_orderstatus <> 'P' OR o_custkey > 100) t"))
def _(spark, d):
    """The target's copy of a snapshot, changed since: both are tables in files, and only unequal buckets are read."""
    rows = live_orders(spark, d)
    source = FileTable.create(incoming_orders(spark, d), work_path(spark, "table"), ORDERS, ROWS_PER_FILE)
    target = FileTable.create(rows, work_path(spark, "table"), ORDERS, -(-rows.count() // source.buckets))
    target.remove(rows.where("o_orderstatus = 'P' and o_custkey <= 100"))
    return source.reconcile(target)[0]


@case(
    "a3_snapshot_chain",
    f"""{PAIR_SQL}, merged AS (SELECT coalesce(i.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(i.o_orderpriority, t.o_orderpriority) AS o_orderpriority
          FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey)
        SELECT 0 AS version, o_orderkey, o_orderpriority FROM live UNION ALL SELECT 1, * FROM merged
        UNION ALL SELECT 2, o_orderkey, o_orderpriority FROM inc""",
)
def _(spark, d):
    """Version 0 is the target, 1 has the incoming rows too, 2 is the incoming snapshot alone: inserts, updates and deletes."""
    rows, incoming = live_orders(spark, d), incoming_orders(spark, d)
    chain = SnapshotChain.create(rows, work_path(spark, "chain"), ORDERS)
    chain.append(incoming)
    chain.compact()
    chain.snapshot(incoming)
    parts = [chain.read(v).select(F.lit(v).alias("version"), "o_orderkey", "o_orderpriority") for v in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
