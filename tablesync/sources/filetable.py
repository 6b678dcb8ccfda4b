"""Tables of which a merge rewrites only the files that it touches.

A table is a folder: data files that never change, and one small table per version that lists the files of the version with their key
range, digest and number of rows. Rows lie in buckets by the hash of their key. Beside each file there is a Bloom filter of its keys. A merge looks up which files
can hold an incoming key, reads and rewrites these, and adds a version; a version counts once its list is complete, so readers see whole
versions and a broken-off merge leaves nothing that is read. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.functions.text import actual_name
from tablesync.functions.unset import default_value
from tablesync.operators.digests import SUMS, compared, digest_sums, digest_tree, key_bucket, unequal_buckets, with_equal
from tablesync.operators.identity import match_keys, row_checksum, with_match_keys
from tablesync.operators.merge import merge_rows, update_subset, upsert
from tablesync.operators.placement import complete_tables, cut, delete_path
from tablesync.sources.tables import read_schema, write_schema
from tablesync.spec import DESTINATION_WINS, TableSpec

BITS_PER_KEY = 16
PROBES = 2
SLOT_BITS = 32_768  # of one bitmap
FIRST_KEYS = 64  # one key in so many is looked up first
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class Change:
    """What a merge did: the version it made, and how many files it read, wrote and left alone."""

    version: int
    files_read: int
    files_written: int
    files_kept: int


def _bits_of(rows: Column) -> Column:
    return F.greatest(F.ceil(rows * BITS_PER_KEY / SLOT_BITS), F.lit(1)) * SLOT_BITS


def _probes(hash_: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(hash_, F.lit(n)), bits) for n in range(PROBES)])


@contextmanager
def _listing_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Paths are listed by a few tasks per core; by default each path is a task of its own."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


class FileTable:
    """A table in files, known by key (``spec.keys``; a name column beside the keys is not looked up)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.spec = read_schema(spark, f"{self.root}/_meta")
        self.buckets = int(self.schema.fields[0].metadata["buckets"])

    @classmethod
    def create(cls, df: DataFrame, root: str, spec: TableSpec, rows_per_file: int = 1_000_000) -> FileTable:
        """Write the rows as version 0, in buckets of about ``rows_per_file`` rows. Reads ``df`` twice."""
        if not spec.keys or not spec.goes_by_key:
            raise ValueError("a table in files goes by its key columns")
        spark, buckets = df.sparkSession, max(1, -(-df.count() // rows_per_file))
        schema = type(df.schema).fromJson(df.schema.jsonValue())
        schema.fields[0].metadata = schema.fields[0].metadata | {"buckets": buckets}
        write_schema(spark, schema, spec, f"{root}/_meta")
        table = cls(spark, root)
        table._commit(0, None, table._written(df))
        return table

    # versions and files

    def versions(self) -> list[int]:
        return sorted(int(n) for n in complete_tables(self.spark, f"{self.root}/versions"))

    def files(self, version: int | None = None) -> DataFrame:
        """The files of a version (the last one by default): file, bucket, rows, low, high, sum_a, sum_b."""
        at = self.versions()[-1] if version is None else version
        return self.spark.read.parquet(f"{self.root}/versions/{at:08d}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version. The driver lists one path per file."""
        return self._rows(self.files(version))

    def _rows(self, files: DataFrame) -> DataFrame:
        paths = [f"{self.root}/data/{r.file}" for r in files.select("file").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        with _listing_in_few_tasks(self.spark):
            return self.spark.read.schema(self.schema).parquet(*paths)

    def _ranges(self, rows: DataFrame) -> list[Column]:
        """Aggregates of the matched keys: ``low`` and ``high``. A single key that is never NULL needs no sort of the rows."""
        keys = match_keys(rows, self.spec)
        if len(keys) == 1 and default_value(self.schema[self.spec.keys[0]].dataType) is not None:
            return [F.struct(of(keys[0]).alias("k0")).alias(name) for of, name in ((F.min, "low"), (F.max, "high"))]
        key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
        return [F.min(key).alias("low"), F.max(key).alias("high")]

    def _written(self, df: DataFrame) -> DataFrame | None:
        """Write rows to new files, one per bucket or task, and return their entries; None for no rows."""
        run = uuid.uuid4().hex
        rows = df.select(*[F.col(f"`{actual_name(df, f.name)}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        # a given number of tasks: what a file costs, not its few bytes, decides how long a task takes
        tasks = min(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        placed = rows.withColumn("_bucket", key_bucket(rows, self.spec, self.buckets)).repartition(tasks, "_bucket")
        placed.sortWithinPartitions("_bucket", *self.spec.keys).write.partitionBy("_bucket").parquet(f"{self.root}/data/{run}")
        with _listing_in_few_tasks(self.spark):
            new = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{run}")
        path, sums = F.col("_metadata.file_path"), digest_sums(row_checksum(new, self.spec, self.schema.names))
        found = new.groupBy(path.alias("path"), key_bucket(new, self.spec, self.buckets).alias("bucket")).agg(*self._ranges(new), *sums)
        entries = cut(
            found.select(
                F.regexp_extract("path", f"({run}/.*)$", 1).alias("file"), "bucket", "low", "high", *SUMS, _bits_of(F.col("rows")).alias("bits"),
                "path", F.monotonically_increasing_id().alias("number"),
            )
        )
        if entries.isEmpty():
            return None
        sized = new.select(path.alias("path"), F.xxhash64(*match_keys(new, self.spec)).alias("hash")).join(entries.select("path", "bits", "number"), "path")
        places = sized.select("number", F.explode(_probes(F.col("hash"), F.col("bits"))).alias("at"))
        slots = places.groupBy("number", F.floor(F.col("at") / SLOT_BITS).alias("slot"))  # rows are sorted by two numbers, not by long names
        bitmaps = slots.agg(F.expr(f"bitmap_construct_agg(at % {SLOT_BITS})").alias("bitmap")).join(entries.select("number", "file"), "number")
        bitmaps.select("file", "slot", "bitmap").write.parquet(f"{self.root}/filters/run={run}")
        return entries.drop("path", "number")

    def _commit(self, version: int, kept: DataFrame | None, new: DataFrame | None) -> None:
        parts = [p for p in (kept, new) if p is not None]
        if not parts:
            key = ", ".join(f"k{i}: {self.schema[k].dataType.simpleString()}" for i, k in enumerate(self.spec.keys)).replace(": ", ":").replace(", ", ",")
            schema = f"file string, bucket int, low struct<{key}>, high struct<{key}>, rows long, sum_a decimal(38,0), sum_b decimal(38,0), bits long"
            parts = [self.spark.createDataFrame([], schema)]
        listed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        listed.write.mode("overwrite").parquet(f"{self.root}/versions/{version:08d}")

    # merging

    def candidates(self, keys: DataFrame) -> DataFrame:
        """The files that can hold a row of the given keys: by bucket, then by key range, then by Bloom filter.

        Files without any of the keys are named for about one key in fifty; no file with one is left out. One key in ``FIRST_KEYS`` is looked
        up first, then all keys in the files that are not named yet: a file that holds many of the keys is named by few of them.
        """
        typed = keys.select(*[F.col(f"`{actual_name(keys, k)}`").cast(self.schema[k].dataType).alias(k) for k in self.spec.keys])
        asked = typed.select(
            key_bucket(typed, self.spec, self.buckets).alias("bucket"), F.xxhash64(*match_keys(typed, self.spec)).alias("hash"),
            F.struct(*[k.alias(f"k{i}") for i, k in enumerate(match_keys(typed, self.spec))]).alias("key"),
        )
        files = self.files()
        runs = sorted({r.run for r in files.select(F.substring_index("file", "/", 1).alias("run")).distinct().collect()})
        if not runs:
            return files
        filters = self.spark.read.option("basePath", f"{self.root}/filters").parquet(*[f"{self.root}/filters/run={r}" for r in runs])
        first = F.pmod(F.xxhash64("hash", F.lit("first")), F.lit(FIRST_KEYS)) == 0
        named = cut(self._named(asked.where(first), files, filters))
        others = cut(files.join(named, "file", "left_anti"))
        if others.isEmpty():
            return files
        named = named.unionByName(self._named(asked, others, filters))
        return cut(files.join(named, "file", "left_semi"))

    @staticmethod
    def _named(asked: DataFrame, files: DataFrame, filters: DataFrame) -> DataFrame:
        """``file``s of ``files`` that can hold one of the asked keys."""
        near = asked.join(files, "bucket").where((F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high")))
        keys = near.select("file", "hash", "bits").distinct()
        places = keys.select("file", "hash", F.explode(_probes(F.col("hash"), F.col("bits"))).alias("at"))
        slot, bit = F.floor(F.col("at") / SLOT_BITS), F.col("at") % SLOT_BITS
        found = places.select("file", "hash", "at", slot.alias("slot"), bit.cast("int").alias("bit")).join(filters, ["file", "slot"])
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return found.groupBy("file", "hash").agg(F.min(F.getbit(byte, F.col("bit") % 8)).alias("all_set")).where("all_set = 1").select("file").distinct()

    def change(self, keys: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> Change:
        """Put ``merged(rows)`` in the place of the rows of all files that can hold one of the keys. Runs at once."""
        version, files = self.versions()[-1], self.files()
        touched = self.candidates(keys)
        new = self._written(merged(self._rows(touched)))
        kept = files.join(touched.select("file"), "file", "left_anti")
        self._commit(version + 1, kept, new)
        return Change(version + 1, touched.count(), new.count() if new is not None else 0, kept.count())

    def upsert(self, incoming: DataFrame, order: str | None = None) -> Change:
        """Source wins, as ``merge.upsert``."""
        return self.change(incoming, lambda rows: upsert(rows, incoming, self.spec, order))

    def seed_fill(self, incoming: DataFrame, order: str | None = None) -> Change:
        """Destination wins, as ``merge.seed_fill``."""
        return self.change(incoming, lambda rows: merge_rows(rows, incoming, self.spec, DESTINATION_WINS, order).select(*rows.columns))

    def update_subset(self, patch: DataFrame, cols: list[str], order: str | None = None) -> Change:
        """Overwrite just ``cols`` of known rows, as ``merge.update_subset``."""
        return self.change(patch, lambda rows: update_subset(rows, patch, list(self.spec.keys), cols, order))

    def remove(self, keys: DataFrame) -> Change:
        """Take out the rows of the given keys, which are computed once."""
        typed = cut(keys.select(*[F.col(f"`{actual_name(keys, k)}`").cast(self.schema[k].dataType).alias(k) for k in self.spec.keys]))

        def rest(rows: DataFrame) -> DataFrame:
            own, names = with_match_keys(rows, self.spec)
            gone, _ = with_match_keys(typed, self.spec)
            return own.join(gone.select(*names).distinct(), names, "left_anti").drop(*names)

        return self.change(typed, rest)

    def compact(self, files_per_bucket: int = 4) -> Change:
        """Put the files of each bucket that has more than ``files_per_bucket`` into one. The rows stay the same."""
        version, files = self.versions()[-1], self.files()
        crowded = files.withColumn("_n", F.count("*").over(Window.partitionBy("bucket"))).where(F.col("_n") > files_per_bucket).drop("_n")
        crowded = cut(crowded)
        new = self._written(self._rows(crowded)) if not crowded.isEmpty() else None
        kept = files.join(crowded.select("file"), "file", "left_anti")
        self._commit(version + 1, kept, new)
        return Change(version + 1, crowded.count(), new.count() if new is not None else 0, kept.count())

    def expire(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions, and the runs of files that none of those lists."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        live = set()
        for v in kept:
            live |= {r.run for r in self.files(v).select(F.substring_index("file", "/", 1).alias("run")).distinct().collect()}
        for v in old:
            delete_path(self.spark, f"{self.root}/versions/{v:08d}")
        for run in complete_tables(self.spark, f"{self.root}/data"):
            if run not in live:
                delete_path(self.spark, f"{self.root}/data/{run}")
                delete_path(self.spark, f"{self.root}/filters/run={run}")

    # comparing

    def digests(self) -> DataFrame:
        """(bucket, rows, sum_a, sum_b) of the last version, from the list of its files."""
        return self.files().groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "sum_a", "sum_b")])

    def reconcile(self, other: FileTable) -> tuple[DataFrame, int]:
        """The counts of ``reconcile`` against another table of as many buckets, and how many files were read. Runs at once.

        Only the files of buckets whose digests differ are read.
        """
        if self.buckets != other.buckets:
            raise ValueError("tables of a different number of buckets have no digests in common")
        sides = [cut(digest_tree(t.digests(), self.buckets)) for t in (self, other)]
        unequal = unequal_buckets(*sides)
        files = [cut(t.files().join(unequal, "bucket", "left_semi")) for t in (self, other)]
        rows = [t._rows(f) for t, f in zip((self, other), files, strict=True)]
        counts = compared(*rows, self.spec, self.schema.names)
        return with_equal(counts, self.digests(), unequal), sum(f.count() for f in files)
