"""Referential integrity, cascading deletes and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import is_empty
from tablesync.operators.levels import find_cycles, rank_nodes
from tablesync.operators.placement import cut, work_path

NAMED = 20  # members of cycles that an error names


def _parent_keys(parent: DataFrame, key: str) -> DataFrame:
    return parent.where(F.col(key).isNotNull()).select(F.col(key).alias("_parent")).distinct()


def fk_orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, nulls_are_orphans: bool = False
) -> DataFrame:
    """Rows whose parent is missing. A NULL key refers to nothing and is only reported on request.

    NULL keys stay out of the join: they would all meet in one partition.
    """
    rows = child.where(F.col(child_key).isNotNull())
    orphans = rows.join(_parent_keys(parent, parent_key), F.col(child_key) == F.col("_parent"), "left_anti")
    return orphans.unionByName(child.where(F.col(child_key).isNull())) if nulls_are_orphans else orphans


def orphans_by_group(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphans counted per missing parent. Counts first, so each parent is looked up once."""
    counts = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count("*").alias("n"))
    return counts.join(_parent_keys(parent, parent_key), F.col(child_key) == F.col("_parent"), "left_anti")


def delete_cascade(tables: dict[str, tuple[DataFrame, str]], victims: DataFrame, victim_key: str) -> dict[str, DataFrame]:
    """Every table without the rows that belong to a victim. ``tables``: name → (rows, key column)."""
    gone = _parent_keys(victims, victim_key)
    return {
        name: df.join(gone, F.col(f"`{key}`") == F.col("_parent"), "left_anti") for name, (df, key) in tables.items()
    }


class CircularDependencyError(ValueError):
    """Some nodes wait for each other; the message says where all of them are listed."""


def _graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names by their folded form, and the links (child, parent) among them without repeats and loops."""
    named = cut(nodes.groupBy(F.lower("name").alias("_n")).agg(F.min("name").alias("name")))
    inside = named.select("_n")
    links = edges.select(F.lower("child").alias("child"), F.lower("parent").alias("parent")).where("child <> parent").distinct()
    links = links.join(inside, F.col("child") == F.col("_n"), "left_semi").join(inside, F.col("parent") == F.col("_n"), "left_semi")
    return named, cut(links)


def dependency_levels(nodes: DataFrame, edges: DataFrame, on_cycle: str = "raise") -> DataFrame:
    """Level of each node so that parents come before children; matched without case. Runs at once.

    ``nodes(name)``, ``edges(child, parent)``. Edges to the node itself or to outside nodes do not
    count. On a cycle all names on or behind it are written to the work folder with the cycle they are on (NULL: behind one), and an
    error names the first members, the number and that place; with ``on_cycle='mark'`` these nodes get level NULL instead. Rounds: see ``levels``.
    """
    named, links = _graph(nodes, edges)
    ranked = rank_nodes(named.select(F.col("_n").alias("node")), links)
    if on_cycle == "raise" and not ranked.cycles.isEmpty():
        place = work_path(nodes.sparkSession, "circular")
        waiting = named.join(ranked.levels.where("level is null"), F.col("_n") == F.col("node")).select("name")
        waiting.join(_members(named, ranked.cycles), "name", "left").select("name", "cycle").write.parquet(place)
        written = nodes.sparkSession.read.schema("name string, cycle string").parquet(place)
        first = ", ".join(r.name for r in written.where("cycle is not null").orderBy("cycle", "name").limit(NAMED).collect())
        raise CircularDependencyError(f"circular dependency among {first}: {written.count()} names wait for each other or behind them, listed in {place}")
    return named.join(ranked.levels, F.col("_n") == F.col("node"), "left").select("name", "level")


def _members(named: DataFrame, cycles: DataFrame) -> DataFrame:
    of = named.select(F.col("_n").alias("cycle"), F.col("name").alias("_first"))
    rows = cycles.join(named, F.col("node") == F.col("_n")).join(of, "cycle")
    return rows.select(F.col("_first").alias("cycle"), "name")


def dependency_cycles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes that wait for each other: (cycle, name), a cycle being named by its first member without regard to case.

    Nodes that only lie behind a cycle are not in it; cycles that share a node are one. Runs at once.
    """
    named, links = _graph(nodes, edges)
    return _members(named, find_cycles(links))


def dangling_pairs(df: DataFrame, id_col: str, type_col: str):
    """Clear ids whose type is empty. Returns the rows and the number of cleared cells (one row)."""
    dangling = is_empty(F.col(type_col)) & ~is_empty(F.col(id_col).cast("string"))
    kept = F.when(~dangling, F.col(id_col))
    return df.withColumn(id_col, kept), df.agg(F.count_if(dangling).alias("cleared"))


class CountGuardError(RuntimeError):
    """A pre or post count is outside the expected range, so nothing may be written."""


def assert_count(df: DataFrame, low: int, high: int | None = None, stage: str = "before", zero_ok: bool = True) -> int:
    """Count the rows and raise unless the count lies in [low, high]; zero means nothing to do."""
    high = low if high is None else high
    n = df.count()
    if (n == 0 and zero_ok) or low <= n <= high:
        return n
    raise CountGuardError(f"{stage}: expected {low}..{high} rows, found {n}")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete the rows for which the condition is true; NULL is not true."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def victims_in_orphan_areas(pages: DataFrame, areas: DataFrame, page_key: str, area_col: str, area_key: str) -> DataFrame:
    """Pages whose area does not exist."""
    return fk_orphans(pages, areas, area_col, area_key).select(page_key)
