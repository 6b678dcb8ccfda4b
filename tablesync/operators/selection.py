"""Choosing rows, columns and map fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.operators.identity import last_per
from tablesync.spec import RUNTIME_COLUMNS, SYSTEM_FIELDS


def select_rows(df: DataFrame, where: str | None) -> DataFrame:
    """Rows that meet a one-table SQL condition. Unknown columns fail at once, in Spark's analysis."""
    return df.where(where) if where and where.strip() else df


def exclude_columns(df: DataFrame, exclude=(), table: str | None = None, include=()) -> DataFrame:
    """Drop ``exclude`` and the table's runtime columns unless ``include`` names them; case-insensitive."""
    auto = next((c for t, c in RUNTIME_COLUMNS.items() if table and t.lower() == table.lower()), ())
    wanted = {c.lower() for c in include}
    gone = {c.lower() for c in exclude} | {c.lower() for c in auto if c.lower() not in wanted}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def lowered(names) -> Column:
    """Names as an array of lower-case literals."""
    return F.array(*[F.lit(n.lower()) for n in names]).cast("array<string>")


def excluded_fields(type_col: Column, flat, by_type: dict[str, list[str]]) -> Column:
    """The lower-case names a row leaves out: the flat list and the list of the row's type."""
    names = lowered(flat)
    typed = F.lit(None).cast("array<string>")
    for item_type, fields in by_type.items():
        typed = F.when(F.lower(type_col) == item_type.lower(), lowered(fields)).otherwise(typed)
    return F.array_union(names, F.coalesce(typed, lowered(())))


def exclude_fields_by_type(df: DataFrame, map_col: str, type_col: str, flat=(), by_type=None) -> DataFrame:
    """Drop map entries excluded for every row or for the row's type."""
    gone = excluded_fields(F.col(type_col), flat, by_type or {})
    kept = F.map_filter(map_col, lambda k, v: ~F.array_contains(gone, F.lower(k)))
    return df.withColumn(map_col, kept)


def compact_fields(df: DataFrame, map_col: str, held: tuple[str, ...] = ()) -> DataFrame:
    """Keep map entries that have a value and are not held in columns of their own."""
    names = lowered(held)
    return df.withColumn(
        map_col, F.map_filter(map_col, lambda k, v: v.isNotNull() & ~F.array_contains(names, F.lower(k)))
    )


def live_rows(df: DataFrame, active: str, deleted: str, id_col: str) -> DataFrame:
    """Active rows that are not soft-deleted, by id."""
    return df.where(F.col(active) & ~F.coalesce(F.col(deleted), F.lit(False))).orderBy(id_col)


def excluded_field_counts(types: DataFrame, rules: DataFrame) -> DataFrame:
    """Per type: declared fields and excluded fields, by category and name.

    ``types(system_name, display_name, category, field)`` one row per declared field (NULL: none),
    ``rules(system_name, field)`` one row per exclusion.
    """
    declared = types.groupBy("system_name").agg(
        F.min("display_name").alias("display_name"),
        F.min("category").alias("category"),
        F.count("field").alias("field_count"),
    )
    excluded = rules.groupBy(F.lower("system_name").alias("_t")).agg(F.count("*").alias("_n"))
    return (
        declared.join(excluded, F.lower("system_name") == F.col("_t"), "left")
        .select(
            "system_name", "display_name", "category", "field_count",
            F.coalesce("_n", F.lit(0)).alias("excluded_field_count"),
        )
        .orderBy(F.lower("category"), F.lower("display_name"), "system_name")
    )


def _is_system(k: Column, excluded: Column | None) -> Column:
    reserved = F.array_contains(lowered(SYSTEM_FIELDS), F.lower(k))
    return reserved if excluded is None else reserved | F.array_contains(excluded, F.lower(k))


def overwrite_map(target: Column, source: Column, excluded: Column | None = None) -> Column:
    """Source wins over a field map: its fields replace the target's, the target's others become NULL.

    Excluded fields of the target keep their value when the source does not bring them; bookkeeping
    fields always do.
    """
    reserved = lowered(SYSTEM_FIELDS)
    incoming = F.map_filter(source, lambda k, v: ~F.array_contains(reserved, F.lower(k)))
    rest = F.map_filter(target, lambda k, v: ~F.map_contains_key(incoming, k))
    rest = F.transform_values(rest, lambda k, v: F.when(_is_system(k, excluded), v))
    return F.when(source.isNull(), target).when(target.isNull(), incoming).otherwise(F.map_concat(incoming, rest))


def fill_map(target: Column, source: Column, excluded: Column | None = None) -> Column:
    """Destination wins: source fields fill keys that are missing, NULL or empty in the target."""
    offered = F.map_filter(source, lambda k, v: ~_is_system(k, excluded))
    empty = F.map_filter(offered, lambda k, v: F.coalesce(F.try_element_at(target, k) == "", F.lit(True)))
    rest = F.map_filter(target, lambda k, v: ~F.map_contains_key(empty, k))
    return F.when(source.isNull(), target).when(target.isNull(), offered).otherwise(F.map_concat(rest, empty))


def fill_map_counts(target: Column, source: Column, excluded: Column | None = None) -> tuple[Column, Column]:
    """How many offered fields were filled, and how many were left because they are set."""
    target = F.coalesce(target, F.create_map().cast("map<string,string>"))
    offered = F.map_filter(source, lambda k, v: ~_is_system(k, excluded))
    empty = F.map_filter(offered, lambda k, v: F.coalesce(F.try_element_at(target, k) == "", F.lit(True)))
    n_filled = F.coalesce(F.nullif(F.size(empty), F.lit(-1)), F.lit(0))
    n_offered = F.coalesce(F.nullif(F.size(offered), F.lit(-1)), F.lit(0))
    return n_filled, n_offered - n_filled


def _joined_maps(target: DataFrame, incoming: DataFrame, keys: list[str], map_col: str, order: str | None) -> DataFrame:
    place = [F.col(f"`{order}`").alias("_order")] if order else []
    source = incoming.select(*keys, F.col(map_col).alias("_source"), *place)
    source = last_per(source, keys, ["_order"] if order else []).drop("_order")
    return target.join(source, keys, "left")


def overwrite_fields(target: DataFrame, incoming: DataFrame, keys: list[str], map_col: str, exclude=(), order: str | None = None) -> DataFrame:
    """Apply ``overwrite_map`` to the rows of the same key; other target rows stay.

    Of several incoming rows with one key the last in ``order`` counts (without one, by a hash of the content).
    """
    rows = _joined_maps(target, incoming, keys, map_col, order)
    merged = overwrite_map(F.col(map_col), F.col("_source"), lowered(exclude))
    return rows.withColumn(map_col, merged).select(*target.columns)


def fill_fields(target: DataFrame, incoming: DataFrame, keys: list[str], map_col: str, exclude=(), order: str | None = None) -> DataFrame:
    """Apply ``fill_map`` to the rows of the same key; add ``n_filled`` and ``n_left``. Repeated incoming keys as in ``overwrite_fields``."""
    rows = _joined_maps(target, incoming, keys, map_col, order)
    n_filled, n_left = fill_map_counts(F.col(map_col), F.col("_source"), lowered(exclude))
    merged = fill_map(F.col(map_col), F.col("_source"), lowered(exclude))
    rows = rows.withColumns({"n_filled": n_filled, "n_left": n_left}).withColumn(map_col, merged)
    return rows.select(*target.columns, "n_filled", "n_left")


