"""Manifests, gates and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import is_blank, string_columns
from tablesync.operators.digests import compared
from tablesync.operators.placement import work_path
from tablesync.spec import CREATED, FAILED, SKIPPED, UPDATED, TableSpec

# Characters an asset path may have, and names that look like credentials.
SAFE_PATH = r"^[a-zA-Z0-9_./\- ]+$"
CREDENTIAL = r"(?i)password|secret|token|apikey|privatekey"


def asset_refs(parts: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Distinct (kind, path, referenced_by) over several tables, in order of kind and path.

    ``parts``: (rows, kind, path column, column that names the page). Users of one asset that differ
    only in case count once. The users stay rows, so an asset used everywhere is no large cell.
    """
    refs = [
        df.where(F.col(path) != "").select(
            F.lit(kind).alias("kind"), F.col(path).alias("path"), F.col(user).cast("string").alias("referenced_by")
        )
        for df, kind, path, user in parts
    ]
    distinct = (
        reduce(DataFrame.unionByName, refs)
        .groupBy("kind", "path", F.lower("referenced_by").alias("_u"))
        .agg(F.min("referenced_by").alias("referenced_by"))
        .drop("_u")
    )
    return distinct.orderBy(F.lower("kind"), F.lower("path"), "path", "referenced_by")


def users_per_asset(refs: DataFrame) -> DataFrame:
    """How many users each asset has."""
    return refs.groupBy("kind", "path").agg(F.count("*").alias("n_users"))


def is_safe_path(path):
    rooted = F.startswith(path, F.lit("/"))
    return path.rlike(SAFE_PATH) & ~F.contains(path, F.lit("..")) & ~rooted


def missing_assets(refs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Uses of assets with an unsafe path, and of assets that the inventory (kind, path) does not hold: one row each."""
    safe = F.coalesce(is_safe_path(F.col("path")), F.lit(False))
    have = inventory.select("kind", "path").distinct().withColumn("_have", F.lit(True))
    bad = refs.join(have, ["kind", "path"], "left").where(~safe | F.col("_have").isNull()).drop("_have")
    return bad.withColumn("problem", F.when(safe, "missing").otherwise("unsafe path"))


class StrictModeError(RuntimeError):
    """Warnings were collected during a strict run."""


def assert_no_warnings(warnings: DataFrame, strict: bool = True) -> int:
    """Fail once at the end of a strict run if there is any warning.

    All warnings are written as a table in the work folder; the error names their number and that place.
    """
    if not strict:
        return 0
    path = work_path(warnings.sparkSession, "warnings")
    warnings.write.parquet(path)
    n = warnings.sparkSession.read.schema(warnings.schema).parquet(path).count()
    if n:
        raise StrictModeError(f"{n} warning(s) in strict mode, listed in {path}")
    return 0


def run_summary(outcomes: DataFrame) -> DataFrame:
    """created / updated / skipped / failed per table and in total, from (table_name, outcome) rows."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in (CREATED, UPDATED, SKIPPED, FAILED)]
    return outcomes.rollup("table_name").agg(*counts).withColumn(
        "table_name", F.coalesce("table_name", F.lit("(total)"))
    )


def advice(errors: DataFrame) -> DataFrame:
    """What to do about (table_name, error) rows: distinct advice per table.

    An error without a table is the run's own. Where any table has advice, one more line says to run again.
    """
    low = F.lower("error")
    table = F.col("table_name")
    has = lambda text: F.contains(low, F.lit(text))
    kind = (
        F.when(table.isNull(), "run")
        .when(has("foreign key"), "foreign key")
        .when(has("group") & has("not found"), "missing group")
        .when(has("duplicate"), "duplicate key")
        .otherwise("other")
    )
    text = (
        F.when(F.col("kind") == "run", F.concat(F.lit("The run itself failed: "), F.col("error")))
        .when(F.col("kind") == "foreign key", F.concat(F.lit("Apply the parents of "), table, F.lit(" first")))
        .when(F.col("kind") == "missing group", F.concat(F.lit("Create the group that "), table, F.lit(" refers to")))
        .when(F.col("kind") == "duplicate key", F.concat(F.lit("Make the name column of "), table, F.lit(" unique")))
        .otherwise(F.concat(F.lit("Error in "), table, F.lit(": "), F.col("error")))
    )
    rows = errors.where(~is_blank(F.col("error"))).withColumn("kind", kind)
    found = rows.select("table_name", "kind", text.alias("advice")).distinct()
    some = found.agg(F.count("*").alias("n")).where("n > 0")
    again = some.select(
        F.lit(None).cast("string").alias("table_name"), F.lit("again").alias("kind"),
        F.lit("Run again once this is done; what is applied already will be skipped").alias("advice"),
    )
    return found.unionByName(again)


def secret_scan(df: DataFrame, keys: list[str], pattern: str = CREDENTIAL) -> DataFrame:
    """Text cells with a value whose column name or content looks like a credential."""
    hits = []
    for c in string_columns(df):
        col = F.col(f"`{c}`")
        by_name = F.lit(c).rlike(pattern)
        reason = F.when(by_name, "name").when(col.rlike(pattern), "text")
        hit = ~is_blank(col) & reason.isNotNull()
        hits.append(F.when(hit, F.struct(F.lit(c).alias("col"), reason.alias("reason"))))
    return df.select(*keys, F.inline(F.array_compact(F.array(*hits))))


def reconcile(source: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """Row counts and content after a round trip: rows equal, different, and on one side only."""
    return compared(source, target, spec, source.columns)


def verify_post(checks: dict[str, DataFrame]) -> DataFrame:
    """Rows that each check still finds after the clean-up; ``ok`` where there are none."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("n") == 0)
