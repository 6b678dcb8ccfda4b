"""The register and the two environments that the queries move data between."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.spec import TableSpec


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None):
    def register(run):
        CASES[name] = Case(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(col: str):
    return F.col(col).cast("decimal(18,2)").alias(col)


ORDERS = TableSpec("orders", keys=("o_orderkey",))

# The target environment holds the orders up to the end of 1999, the incoming snapshot those since
# 1997, where pending orders got a new priority. Together they cover the whole table, and every
# outcome occurs: kept, skipped, updated, created.
_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice"

LIVE_SQL = f"SELECT {_ORDER_COLS}, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
DROP_SQL = f"""SELECT {_ORDER_COLS},
  CASE WHEN o_orderstatus = 'P' THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'"""
PAIR_SQL = f"WITH live AS ({LIVE_SQL}), inc AS ({DROP_SQL})"


def orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice"), "o_orderpriority", "o_orderdate"
    )


def live_orders(spark, folder) -> DataFrame:
    return orders(spark, folder).where("o_orderdate < timestamp '2000-01-01 00:00:00'").drop("o_orderdate")


def incoming_orders(spark, folder) -> DataFrame:
    changed = F.when(F.col("o_orderstatus") == "P", "CHANGED").otherwise(F.col("o_orderpriority"))
    rows = orders(spark, folder).where("o_orderdate >= timestamp '1997-01-01 00:00:00'").drop("o_orderdate")
    return rows.withColumn("o_orderpriority", changed)


# The same target with cells nobody has set yet, for seed fills.
UNSET_SQL = f"""SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(0 AS DECIMAL(18,2)) ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END AS o_orderpriority
  FROM ({LIVE_SQL}) l"""
SEED_SQL = f"WITH live AS ({UNSET_SQL}), inc AS ({DROP_SQL})"


def unset_orders(spark, folder) -> DataFrame:
    live = live_orders(spark, folder)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return live.select(
        "o_orderkey",
        "o_custkey",
        F.when(priority != "3-MEDIUM", status).alias("o_orderstatus"),
        F.when(priority == "1-URGENT", F.lit(0)).otherwise(F.col("o_totalprice")).cast("decimal(18,2)").alias("o_totalprice"),
        F.when(status == "O", "").otherwise(priority).alias("o_orderpriority"),
    )


# A tree over the parts: part k hangs below part floor((k-1)/4); part 0 is the root.
TREE_SQL = """SELECT p_partkey AS id, CASE WHEN p_partkey > 0 THEN CAST(floor((p_partkey - 1) / 4.0) AS BIGINT) END AS parent,
  p_brand AS name, p_type AS kind, p_size AS sort FROM part"""


def part_tree(spark, folder) -> DataFrame:
    up = F.when(F.col("p_partkey") > 0, F.floor((F.col("p_partkey") - 1) / 4))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), up.alias("parent"), F.col("p_brand").alias("name"),
        F.col("p_type").alias("kind"), F.col("p_size").alias("sort"),
    )


# Checksums as text, in DuckDB's words.
CHECKSUM_SQL = (
    "md5('O_CUSTKEY=' || {a}.o_custkey || '|O_ORDERKEY=' || {a}.o_orderkey || '|O_ORDERPRIORITY=' || "
    "coalesce({a}.o_orderpriority, '') || '|O_ORDERSTATUS=' || coalesce({a}.o_orderstatus, '') || "
    "'|O_TOTALPRICE=' || {a}.o_totalprice)"
)
