"""Row identity, checksums, change classification, id maps and names derived from identity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.functions.text import actual_name, cell, is_blank, safe_name, trimmed
from tablesync.functions.unset import NUMERIC, default_value
from tablesync.operators.placement import ordinal
from tablesync.spec import CREATED, SKIPPED, UPDATED, TableSpec


def row_identity(df: DataFrame, spec: TableSpec) -> Column:
    """The row's name: the name column, else the key values, else all values, joined by ``$$``."""
    if spec.name_col:
        return F.coalesce(trimmed(cell(df, spec.name_col)), F.lit(""))
    names = sorted(spec.keys or df.columns, key=str.upper)
    return F.concat_ws("$$", *[F.coalesce(trimmed(cell(df, n)), F.lit("")) for n in names])


def folded_identity(df: DataFrame, spec: TableSpec) -> Column:
    """Identity as it is matched: without regard to case."""
    return F.lower(row_identity(df, spec))


def row_checksum(df: DataFrame, spec: TableSpec, columns=None) -> Column:
    """MD5 over ``COLUMN=value`` of the compared columns; blank, NULL and absent cells count as ''."""
    if spec.compare_cols:
        names = list(spec.compare_cols)
    else:
        auto = {c.lower() for c in spec.auto_cols}
        names = [c for c in (columns or df.columns) if c.lower() not in auto]
    parts = []
    for name in sorted(names, key=str.upper):
        value, found = cell(df, name), actual_name(df, name)
        never_blank = found is not None and isinstance(df.schema[found].dataType, NUMERIC)  # but NULL
        parts.append(F.concat(F.lit(name.upper() + "="), F.coalesce(value, F.lit("")) if never_blank else F.when(is_blank(value), "").otherwise(value)))
    return F.md5(F.concat_ws("|", *parts))


def match_keys(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The key columns as they are matched: text without case and trailing blanks, NULL as the default."""
    keys = []
    for name in spec.keys:
        col = F.col(f"`{actual_name(df, name)}`")
        dtype = df.schema[actual_name(df, name)].dataType
        if dtype.typeName() == "string":
            col = F.lower(F.rtrim(col))
        default = default_value(dtype)
        keys.append(col if default is None else F.coalesce(col, default))
    return keys


def with_match_keys(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    names = [f"_k{i}" for i in range(len(spec.keys))]
    return df.select("*", *[k.alias(n) for k, n in zip(match_keys(df, spec), names)]), names


def numbered_last(df: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """Number the rows per key, the last in ``order`` first; rows that tie go by a hash of their content."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    maps = [F.to_json(F.struct(f"`{f.name}`")) for f in df.schema.fields if "map<" in f.dataType.simpleString()]
    content = F.xxhash64(*plain, *maps)
    rank = Window.partitionBy(*by).orderBy(*[F.col(o).desc() for o in order], content.desc())
    return df.withColumn(out, F.row_number().over(rank))


def last_per(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The last row per key in ``order``, for columns of any type.

    A limit on a rank is applied before the shuffle as well, so each task sends one row per key and
    a hot key stays cheap; a join on the same key afterwards needs no further shuffle.
    """
    return numbered_last(df, by, order, "_rank").where("_rank = 1").drop("_rank")


def last_by_identity(target: DataFrame, spec: TableSpec) -> DataFrame:
    """Target rows as the identity lookup sees them: of equal identities the highest key wins."""
    named = target.withColumn("_identity", folded_identity(target, spec))
    return last_per(named, ["_identity"], [actual_name(target, k) for k in spec.keys])


def classify_changes(
    incoming: DataFrame, target: DataFrame, spec: TableSpec, compare: str = "target"
) -> DataFrame:
    """Add ``outcome`` to the incoming rows.

    skipped: a target row of the same identity has the same checksum; updated: the key exists;
    created: it does not. ``compare='shared'`` leaves columns the incoming rows lack out of the
    checksum instead of comparing them as empty.
    """
    have = {c.lower() for c in incoming.columns}
    columns = target.columns if compare == "target" else [c for c in target.columns if c.lower() in have]
    s, keys = with_match_keys(incoming.withColumn("_checksum", row_checksum(incoming, spec, columns)), spec)
    t, _ = with_match_keys(target.withColumn("_target_checksum", row_checksum(target, spec, columns)), spec)
    same = F.coalesce(F.col("_checksum") == F.col("_target_checksum"), F.lit(False))
    if spec.goes_by_key:
        # A row of the same identity is the row of the same key: one join.
        both = s.join(t.select(*keys, "_target_checksum"), keys, "left")
        exists = F.col("_target_checksum").isNotNull()
    else:
        named = last_by_identity(target, spec)
        named = named.select("_identity", row_checksum(named, spec, columns).alias("_target_checksum"))
        known = t.select(*keys, F.lit(True).alias("_known"))
        both = s.withColumn("_identity", folded_identity(incoming, spec)).join(named, "_identity", "left")
        both = both.join(known, keys, "left")
        exists = F.col("_known").isNotNull()
    outcome = F.when(same, SKIPPED).when(exists, UPDATED).otherwise(CREATED)
    return both.select(*[f"`{c}`" for c in incoming.columns], outcome.alias("outcome"))


def duplicate_identities(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Identities that several rows share when matched without case, each in its smallest spelling."""
    named = df.select(row_identity(df, spec).alias("identity"))
    groups = named.groupBy(F.lower("identity").alias("_folded")).agg(F.min("identity").alias("identity"), F.count("*").alias("n"))
    return groups.where("n > 1").select("identity", "n")


def resolve_guid(df: DataFrame, id_col: str, dim: DataFrame, dim_id: str, dim_guid: str, out: str):
    """Add the GUID behind a local id. Returns the rows and one warning per unknown id.

    Ids of zero and below mean "none" and stay NULL without a warning. Unusable ids are kept out of
    the join, so that they do not meet in one partition.
    """
    lookup = dim.groupBy(F.col(dim_id).alias("_id")).agg(F.min(dim_guid).alias(out))
    usable = F.coalesce(F.col(id_col) > 0, F.lit(False))
    joined = df.where(usable).join(lookup, F.col(id_col) == F.col("_id"), "left").drop("_id")
    guid_type = dim.schema[dim_guid].dataType
    rows = joined.unionByName(df.where(~usable).withColumn(out, F.lit(None).cast(guid_type)))
    known = lookup.select("_id")
    warnings = (
        df.where(usable)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.count("*").alias("rows"))
        .join(known, F.col("id") == F.col("_id"), "left_anti")
        .withColumn("warning", F.concat(F.lit("unknown id "), F.col("id").cast("string")))
    )
    return rows, warnings


def build_id_map(source: DataFrame, target: DataFrame, id_col: str = "id", guid_col: str = "guid"):
    """Source id → target id of the row with the same GUID; unmatched and NULL ids are left out."""
    s = source.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("source_id"), F.lower(guid_col).alias("_guid")
    )
    t = target.groupBy(F.lower(guid_col).alias("_guid")).agg(F.max(id_col).alias("target_id"))
    return s.join(t, "_guid").groupBy("source_id").agg(F.max("target_id").alias("target_id"))


def union_id_maps(maps: list[DataFrame]) -> DataFrame:
    """Combine the id maps of several runs; the first run that knows a source id wins."""
    ranked = [m.select("source_id", "target_id", F.lit(i).alias("_run")) for i, m in enumerate(maps)]
    return (
        reduce(DataFrame.unionByName, ranked)
        .groupBy("source_id")
        .agg(F.min_by("target_id", F.struct("_run", "target_id")).alias("target_id"))
    )


def allocate_ids(incoming: DataFrame, target: DataFrame, guid_col: str = "guid", id_col: str = "id") -> DataFrame:
    """Give every incoming GUID its target id: the existing one, or a new one above the highest.

    New ids follow the hash of the GUID. Only the distinct new GUIDs are ranked, which writes them once, at once. A row
    without a GUID names nothing: its ``target_id`` and ``is_new`` are NULL, and the caller sets it aside.
    """
    guids = incoming.select(F.lower(guid_col).alias("_guid")).where("_guid is not null").distinct()
    known = target.groupBy(F.lower(guid_col).alias("_guid")).agg(F.max(id_col).cast("long").alias("target_id"))
    known = known.where("_guid is not null")
    top = target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_top")).first()["_top"]  # one number
    fresh = ordinal(guids.join(known, "_guid", "left_anti"), [], [F.md5("_guid"), F.col("_guid")], "_n")
    # Two lookups side by side: the known ids keep the shuffle of their grouping, and rows are shuffled once for both.
    rows = incoming.withColumn("_guid", F.lower(guid_col))
    out = [*[F.col(f"`{c}`") for c in incoming.columns], "target_id", "is_new"]
    named = rows.where("_guid is not null").join(known.withColumnRenamed("target_id", "_known"), "_guid", "left")
    named = named.join(fresh.select("_guid", (F.col("_n") + F.lit(top)).alias("_new")), "_guid", "left")
    named = named.withColumns({"target_id": F.when(F.col("_new").isNull(), F.col("_known")).otherwise(F.col("_new")), "is_new": F.col("_new").isNotNull()})
    named = named.select(*out)
    nameless = rows.where("_guid is null").withColumns({"target_id": F.lit(None).cast("long"), "is_new": F.lit(None).cast("boolean")})
    return named.unionByName(nameless.select(*out))


def snapshot_manifest(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Everything a run wrote: identity and checksum, sorted without regard to case."""
    rows = df.select(row_identity(df, spec).alias("identity"), row_checksum(df, spec).alias("checksum"))
    return rows.orderBy(F.lower("identity"), "identity", "checksum")


def stale_keys(previous: DataFrame, current: DataFrame, key: str = "identity") -> DataFrame:
    """Entries of the earlier run that this run did not write; compared without case."""
    now = current.select(F.lower(key).alias("_key")).distinct()
    return previous.withColumn("_key", F.lower(key)).join(now, "_key", "left_anti").drop("_key")


def drop_stale(df: DataFrame, spec: TableSpec, stale: DataFrame) -> DataFrame:
    """The snapshot without the rows that ``stale_keys`` reports."""
    gone = stale.select(F.lower("identity").alias("_identity")).distinct()
    rows = df.withColumn("_identity", folded_identity(df, spec))
    return rows.join(gone, "_identity", "left_anti").drop("_identity")


def row_file_names(df: DataFrame, identity_col: str, order: list[str]):
    """A unique file name per row. The first row of a name keeps it, the others get `` [md5-n]``.

    Names are compared without case; the counter runs per name and hash of the identity. A name that itself ends like
    such a suffix always gets one of its own, so it can never meet a numbered name. Numbering writes the rows, at once.
    """
    named = df.select(
        "*",
        safe_name(F.col(identity_col)).alias("_name"),
        F.substring(F.md5(F.coalesce(F.col(identity_col), F.lit(""))), 1, 6).alias("_hash"),
    ).withColumn("_folded", F.lower("_name"))
    first = named.groupBy(F.col("_folded").alias("_f")).agg(
        F.min_by(F.struct(F.col("_hash").alias("h"), F.struct(*order).alias("o")), F.struct(*order)).alias("_first")
    )
    numbered = ordinal(named, ["_folded", "_hash"], order, "_n").join(first, F.col("_folded") == F.col("_f"))
    lookalike = F.col("_folded").rlike(r" \[[0-9a-f]{6}-[0-9]+\]$")
    is_first = F.struct(*order).eqNullSafe(F.col("_first.o")) & ~lookalike
    # The first row of the name took no number, so its own hash group counts from one lower.
    number = F.col("_n") - (~lookalike & (F.col("_hash") == F.col("_first.h"))).cast("int")
    suffix = F.concat(F.lit(" ["), F.col("_hash"), F.lit("-"), number.cast("string"), F.lit("]"))
    name = F.when(is_first, F.col("_name")).otherwise(F.concat("_name", suffix))
    return numbered.select(*df.columns, name.alias("file_name"))


def sibling_folder_names(
    df: DataFrame, parent: str, name: str, guid: str, order: list[str], style: str = "page"
) -> DataFrame:
    """A unique folder name among siblings: the first keeps its name, others add 6 GUID digits.

    ``style='row'`` takes ``name`` as the sort number of a grid row: ``grid-row-N`` / ``grid-row-N-guid6``.
    """
    short = F.substring(F.regexp_replace(F.lower(guid), "[^0-9a-f]", ""), 1, 6)
    if style == "row":
        base = F.concat(F.lit("grid-row-"), F.col(name).cast("string"))
        longer = F.concat(F.col("_name"), F.lit("-"), short)
    else:
        base = safe_name(F.col(name))
        longer = F.concat(F.col("_name"), F.lit(" ["), short, F.lit("]"))
    named = df.withColumn("_name", base).withColumn("_folded", F.lower("_name"))
    # Only the first of a name is special, so a partial minimum replaces numbering the siblings.
    firsts = named.groupBy(F.col(parent).alias("_p"), F.col("_folded").alias("_f")).agg(
        F.min(F.struct(*order)).alias("_first")
    )
    same = F.col(parent).eqNullSafe(F.col("_p")) & (F.col("_folded") == F.col("_f"))
    folder = F.when(F.struct(*order).eqNullSafe(F.col("_first")), F.col("_name")).otherwise(longer)
    return named.join(firsts, same).select(*df.columns, folder.alias("folder"))
