"""Helpers that keep work spread over the cluster: tables in the shared folder, numbering."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """This application's folder in the cluster's shared folder, ``spark.checkpoint.dir``.

    Where that is unset, a folder set on the context counts, else one in the warehouse, which all executors reach too.
    """
    sc = spark.sparkContext
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    shared = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir() or f"{warehouse}/_work"
    return f"{shared}/{sc.applicationId}"


def work_path(spark: SparkSession, what: str) -> str:
    """A new place below the work folder."""
    return f"{work_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back. Runs at once.

    Ends the lineage on storage that outlives any executor, fixes every value that depends on row
    placement, and gives the following joins real sizes to plan with.
    """
    path = work_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def complete_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables below a folder that were written to the end, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []
    return sorted(n for n in names if fs.exists(path(f"{folder}/{n}/_SUCCESS")))


def prefixed(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(c if c in keep else prefix + c) for c in df.columns])


def ordinal(df: DataFrame, group: list[str], order: list, out: str) -> DataFrame:
    """Number the rows of each group 1..n by ``order`` (which must decide every tie). Writes the rows once, at once.

    Rows are range-partitioned by group and order and sorted; their places inside each range are written with them and shifted by
    the sizes of the group's ranges before, so a group of any size spreads over tasks and rows are shuffled once. A NULL group is
    a group too; no group columns mean one group of all rows.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    keys = [F.col(g) for g in group]
    ranges = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # inside the range
    placed = cut(ranges.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))
    sizes = placed.groupBy(*group, "_part").agg(F.count("*").alias("_size"), F.min("_place").alias("_first"))  # a row per group and range
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_part").alias("_at"), (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = placed.join(shift, reduce(lambda a, b: a & b, same, F.col("_part") == F.col("_at")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_place") + F.col("_shift")).cast("long").alias(out))
