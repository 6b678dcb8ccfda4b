"""Snapshots as a chain: a whole one, then only what changed, merged when read.

A chain is a folder of tables, each of which counts once it is complete: ``base`` holds a whole version, ``delta`` the rows that a version changed
or added and, as markers, the keys it no longer has. A version is read from the last base at or before it and the deltas after that. Compaction adds a base
and takes nothing away, so a reader of any version is never disturbed. One writer at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.operators.identity import last_per, row_checksum, with_match_keys
from tablesync.operators.placement import complete_tables, delete_path
from tablesync.sources.tables import read_schema, write_schema
from tablesync.spec import TableSpec

GONE, VERSION = "_gone", "_version"


class SnapshotChain:
    """Versions 0, 1, ... of one table; rows are known by ``spec.keys``, the last of equal ones counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.spec = read_schema(spark, f"{self.root}/_meta")

    @classmethod
    def create(cls, df: DataFrame, root: str, spec: TableSpec) -> SnapshotChain:
        """Write the rows as version 0."""
        write_schema(df.sparkSession, df.schema, spec, f"{root}/_meta")
        chain = cls(df.sparkSession, root)
        chain._fitted(df).write.mode("overwrite").parquet(f"{chain.root}/base/{0:08d}")
        return chain

    def _fitted(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _tables(self, kind: str) -> list[int]:
        return [int(n) for n in complete_tables(self.spark, f"{self.root}/{kind}")]

    def versions(self) -> list[int]:
        """All versions that can be read."""
        bases = self._tables("base")
        return sorted({*bases, *(d for d in self._tables("delta") if any(b < d for b in bases))})

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last one by default): of each key the last change counts, unless it is a marker.

        The base and its deltas meet by key in one shuffle; each task sends one row per key.
        """
        wanted = self.versions()[-1] if version is None else version
        bases = [b for b in self._tables("base") if b <= wanted]
        if not bases or wanted not in self.versions():
            raise ValueError(f"no version {wanted} in {self.root}")
        base, deltas = max(bases), [d for d in self._tables("delta") if max(bases) < d <= wanted]
        whole = self.spark.read.schema(self.schema).parquet(f"{self.root}/base/{base:08d}")
        if not deltas:
            return whole
        parts = [whole.withColumn(GONE, F.lit(False)).withColumn(VERSION, F.lit(base))]
        parts += [self.spark.read.parquet(f"{self.root}/delta/{d:08d}").withColumn(VERSION, F.lit(d)) for d in deltas]
        keyed, names = with_match_keys(reduce(DataFrame.unionByName, parts), self.spec)
        return last_per(keyed, names, [VERSION]).where(~F.col(GONE)).select(*self.schema.names)

    def append(self, changed: DataFrame, gone: DataFrame | None = None) -> int:
        """Add a version: rows that are new or changed, and keys that are no longer there (a key in both is changed)."""
        version = self.versions()[-1] + 1
        rows = self._fitted(changed).withColumn(GONE, F.lit(False))
        if gone is not None:
            keys = {k.lower() for k in self.spec.keys}
            typed = gone.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name.lower() in keys])
            own, names = with_match_keys(rows, self.spec)
            left, _ = with_match_keys(typed, self.spec)
            left = left.join(own.select(*names), names, "left_anti").drop(*names).distinct()
            rows = rows.unionByName(left.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(f"{self.root}/delta/{version:08d}")
        return version

    def snapshot(self, df: DataFrame) -> int:
        """Add a version that equals ``df``, as what differs from the last one. One join by key of checksums, no rows move twice."""
        now, before = self._fitted(df), self.read()
        a, names = with_match_keys(now.withColumn("_now", row_checksum(now, self.spec)), self.spec)
        b, _ = with_match_keys(before.withColumn("_before", row_checksum(before, self.spec)), self.spec)
        known = b.select(*names, "_before")
        changed = a.join(known, names, "left").where(~F.col("_now").eqNullSafe(F.col("_before")))
        return self.append(changed.select(*self.schema.names), b.join(a.select(*names), names, "left_anti").select(*self.spec.keys))

    def compact(self) -> int:
        """Write the last version whole, so that reading it and later ones starts there. Earlier versions stay readable."""
        version = self.versions()[-1]
        if version not in self._tables("base"):
            self.read(version).write.mode("overwrite").parquet(f"{self.root}/base/{version:08d}")
        return version

    def expire(self, before: int) -> None:
        """Delete what only versions earlier than ``before`` need: tables up to the last base at or before it."""
        start = max(b for b in self._tables("base") if b <= before)
        for kind in ("base", "delta"):
            for n in self._tables(kind):
                if n < start or (kind == "delta" and n == start):
                    delete_path(self.spark, f"{self.root}/{kind}/{n:08d}")
