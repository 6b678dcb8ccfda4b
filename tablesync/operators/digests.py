"""Digests of rows by ranges of their key's hash: equal ranges need no comparing, and only digests have to travel.

A row's digest is the MD5 of its compared cells as two 64-bit numbers; a range's digest is their sums and the number of rows, so it does not
depend on the order of rows, and digests of parts add up. Ranges form a tree: a node of one level covers ``FAN`` nodes of the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.identity import match_keys, row_checksum, with_match_keys
from tablesync.operators.placement import cut
from tablesync.spec import TableSpec

FAN = 64
SUMS = ["rows", "sum_a", "sum_b"]


def key_bucket(df: DataFrame, spec: TableSpec, buckets: int) -> Column:
    """The range of a row's key, as keys are matched: 0 to ``buckets`` - 1."""
    return F.pmod(F.xxhash64(*match_keys(df, spec)), F.lit(buckets)).cast("int")


def digest_sums(checksum: Column) -> list[Column]:
    """Aggregates of MD5 checksums: ``rows``, ``sum_a`` and ``sum_b``.

    A half is summed in three parts of 22, 21 and 21 bits, whose sums are exact as long as a group has no more than two billion thousand rows.
    """
    sums = []
    for at, name in ((1, "sum_a"), (17, "sum_b")):
        half = F.conv(F.substring(checksum, at, 16), 16, -10).cast("long")  # the 64 bits, as a signed number
        parts = [F.sum(F.shiftrightunsigned(half, shift).bitwiseAND(F.lit((1 << 22) - 1 if shift == 42 else (1 << 21) - 1))) for shift in (42, 21, 0)]
        high, middle, low = [p.cast("decimal(38,0)") for p in parts]
        sums.append((high * F.lit(1 << 42) + middle * F.lit(1 << 21) + low).cast("decimal(38,0)").alias(name))
    return [F.count("*").alias("rows"), *sums]


def key_digests(df: DataFrame, spec: TableSpec, columns: list[str], buckets: int) -> DataFrame:
    """(bucket, rows, sum_a, sum_b) of a table, over its cells in ``columns``. One scan; a task sends one row per bucket."""
    rows = df.select(key_bucket(df, spec, buckets).alias("bucket"), row_checksum(df, spec, columns).alias("_sum"))
    return rows.groupBy("bucket").agg(*digest_sums(F.col("_sum")))


def digest_tree(digests: DataFrame, buckets: int) -> DataFrame:
    """(level, node, rows, sum_a, sum_b) from digests by bucket: level 0 is the root, the last level has the buckets."""
    depth = 0
    while FAN**depth < buckets:
        depth += 1
    levels = F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda n: F.struct(n.alias("level"), F.floor(F.col("bucket") / F.pow(F.lit(FAN), depth - n)).cast("int").alias("node")))
    return digests.select(F.inline(levels), *SUMS).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in SUMS])


def unequal_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """``bucket``s whose digests differ, from the trees of two tables cut into equally many buckets. Runs at once.

    Trees are walked from the root: of a level only the children of unequal nodes are compared.
    """
    depth = a.unionByName(b).agg(F.max("level")).first()[0]
    asked = None
    for level in range((depth or 0) + 1):
        sides = [t.where(F.col("level") == level).select("node", *[F.col(c).alias(f"{c}_{n}") for c in SUMS]) for t, n in ((a, "a"), (b, "b"))]
        if asked is not None:
            up = asked.withColumnRenamed("node", "_up")
            sides = [s.join(up, F.floor(F.col("node") / FAN) == F.col("_up"), "left_semi") for s in sides]
        both = sides[0].join(sides[1], "node", "full_outer")
        same = F.lit(True)
        for c in SUMS:
            same &= F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b"))
        asked = cut(both.where(~same).select("node"))
        if asked.isEmpty():
            break
    return asked.withColumnRenamed("node", "bucket")


COUNTS = ["source_rows", "target_rows", "equal_rows", "different_rows", "only_source", "only_target"]


def compared(source: DataFrame, target: DataFrame, spec: TableSpec, columns: list[str]) -> DataFrame:
    """One row of counts: rows on both sides, equal, different, and on one side only. One join by key."""
    s = source.withColumn("_source_sum", row_checksum(source, spec, columns))
    t = target.withColumn("_target_sum", row_checksum(target, spec, columns))
    s, keys = with_match_keys(s, spec)
    t, _ = with_match_keys(t, spec)
    both = s.select(*keys, "_source_sum").join(t.select(*keys, "_target_sum"), keys, "full_outer")
    in_s, in_t = F.col("_source_sum").isNotNull(), F.col("_target_sum").isNotNull()
    same = F.col("_source_sum") == F.col("_target_sum")
    flags = [in_s, in_t, in_s & in_t & same, in_s & in_t & ~same, in_s & ~in_t, in_t & ~in_s]
    return both.agg(*[F.count_if(flag).alias(c) for c, flag in zip(COUNTS, flags, strict=True)])


def with_equal(counts: DataFrame, digests: DataFrame, unequal: DataFrame) -> DataFrame:
    """Counts of the rows compared one by one, with the rows of all other buckets, which are equal."""
    n = digests.join(unequal, "bucket", "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return counts.select(*[(F.col(c) + n).alias(c) if c in COUNTS[:3] else F.col(c) for c in COUNTS])


def reconcile_by_digest(source: DataFrame, target: DataFrame, spec: TableSpec, buckets: int = 4096) -> DataFrame:
    """The counts of ``reconcile`` for unique keys. Each side is digested in one scan, without a shuffle of rows; only rows of ranges whose
    digests differ are joined by key. Runs at once."""
    columns = source.columns
    sides = [cut(key_digests(df, spec, columns, buckets)) for df in (source, target)]
    unequal = unequal_buckets(*[cut(digest_tree(d, buckets)) for d in sides])
    # bounded: one row per bucket
    rows = [df.withColumn("_bucket", key_bucket(df, spec, buckets)).join(F.broadcast(unequal), F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket") for df in (source, target)]
    return with_equal(compared(*rows, spec, columns), sides[0], unequal)
