"""Tables and snapshots: reading, writing, backups."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.identity import row_identity
from tablesync.operators.selection import exclude_columns, select_rows
from tablesync.operators.xmlcols import canonical_xml, drop_xml_elements
from tablesync.spec import SyncSpec, TableSpec, check_columns


def read_table(spark: SparkSession, path: str, where: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Scan a table; the condition is pushed to the files (or, with ``fmt='jdbc'``, to the server)."""
    reader = spark.read.format(fmt).options(**options)
    return select_rows(reader.load(path) if path else reader.load(), where)


def snapshot_rows(df: DataFrame, spec: SyncSpec) -> DataFrame:
    """What a snapshot of the table holds: selected rows, kept columns, canonical XML, identity."""
    check_columns(df, spec.table.keys, f"{spec.table.table}: keys")
    check_columns(df, spec.table.compare_cols, f"{spec.table.table}: compare columns")
    rows = exclude_columns(select_rows(df, spec.where), spec.exclude, spec.table.table, spec.include)
    xml = [c for c in spec.xml_text_cols if c.lower() in {n.lower() for n in rows.columns}]
    if xml:
        rows = canonical_xml(rows, xml)
        if spec.drop_elements:
            rows = drop_xml_elements(rows, xml, list(spec.drop_elements))
    return rows.withColumn("_identity", row_identity(rows, spec.table))


def write_snapshot(df: DataFrame, spec: SyncSpec, out: str, fmt: str = "parquet", partition_by=()) -> DataFrame:
    """Write the snapshot rows and their schema below ``out``; NULL cells are kept in JSON too."""
    rows = snapshot_rows(df, spec)
    writer = rows.write.mode("overwrite").format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{out}/rows")
    write_schema(df.sparkSession, rows.schema, spec.table, f"{out}/_meta")
    return rows


def read_snapshot(spark: SparkSession, out: str, fmt: str = "parquet") -> DataFrame:
    schema, _ = read_schema(spark, f"{out}/_meta")
    return spark.read.schema(schema).format(fmt).load(f"{out}/rows")


def write_schema(spark: SparkSession, schema: T.StructType, table: TableSpec, path: str) -> None:
    """Persist column definitions and keys beside the data."""
    meta = {"table": table.table, "keys": list(table.keys), "nameCol": table.name_col,
            "autoCols": list(table.auto_cols), "schema": schema.jsonValue()}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_schema(spark: SparkSession, path: str) -> tuple[T.StructType, TableSpec]:
    meta = json.loads(spark.read.text(path).first()["value"])
    spec = TableSpec(meta["table"], tuple(meta["keys"]), meta["nameCol"], (), tuple(meta["autoCols"]))
    return T.StructType.fromJson(meta["schema"]), spec


def backup_tables(spark: SparkSession, tables: dict[str, DataFrame], out: str, suffix: str) -> DataFrame:
    """Copy each table to ``<out>/<name>_<suffix>`` and report the sizes of originals and copies."""
    report = None
    for name, df in tables.items():
        copy = f"{out}/{name}_{suffix}"
        df.write.mode("overwrite").parquet(copy)
        sizes = df.select(F.lit(0).alias("copy")).unionByName(spark.read.parquet(copy).select(F.lit(1).alias("copy")))
        part = sizes.agg(
            F.count_if(F.col("copy") == 0).alias("rows_before"), F.count_if(F.col("copy") == 1).alias("rows_copied")
        ).select(F.lit(name).alias("table_name"), "rows_before", "rows_copied")
        report = part if report is None else report.unionByName(part)
    return report


def purge_tables(spark: SparkSession, paths: dict[str, str], levels: DataFrame, like: str = "%") -> list[str]:
    """Empty the tables whose name matches ``like`` (SQL pattern, without case), children before parents, keeping their
    schemas. Returns the order taken.

    ``levels(name, level)`` comes from ``dependency_levels``. The order is the driver's to walk: one row per table
    in ``paths``, which the caller lists.
    """
    named = levels.where(F.col("name").isin(*paths) & F.col("name").ilike(like)) if paths else levels.limit(0)
    order = [r["name"] for r in named.orderBy(F.desc("level"), "name").collect()]
    for name in order:
        schema = spark.read.parquet(paths[name]).schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(paths[name])
    return order
