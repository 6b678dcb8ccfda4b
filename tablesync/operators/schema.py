"""Fitting rows to a target schema: drift, typing, NOT NULL defaults, declared columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import actual_name, is_blank, trimmed
from tablesync.functions.unset import default_value

WARNING = "table_name string, column_name string, warning string"

# Spellings of a truth value, and the shapes of numbers, ids and US dates.
TRUE, FALSE = ("true", "1"), ("false", "0")
WHOLE = r"^[+-]?[0-9]+$"
GROUPED = r"^[+-]?[0-9][0-9,]*(\.[0-9]*)?$|^[+-]?\.[0-9]+$"
FLOATING = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
GUID = r"^\{?[0-9a-fA-F]{8}-?([0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}\}?$"
DATE_SHAPES = ("M/d/yyyy H:m:s", "M/d/yyyy")


@dataclass(frozen=True)
class ColumnDef:
    """A column as the source database declares it."""

    name: str
    data_type: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True
    identity: bool = False


def spark_type(d: ColumnDef) -> T.DataType:
    """The Spark type behind each SQL Server type name; unknown names become text."""
    kind = d.data_type.lower()
    if kind in ("decimal", "numeric"):
        return T.DecimalType(d.precision or 18, d.scale or 0)
    return {
        "int": T.IntegerType(),
        "smallint": T.IntegerType(),
        "tinyint": T.IntegerType(),
        "bigint": T.LongType(),
        "money": T.DecimalType(19, 4),
        "smallmoney": T.DecimalType(10, 4),
        "float": T.DoubleType(),
        "real": T.FloatType(),
        "bit": T.BooleanType(),
        "date": T.DateType(),
        "datetime": T.TimestampType(),
        "datetime2": T.TimestampType(),
        "smalldatetime": T.TimestampType(),
        "datetimeoffset": T.TimestampType(),
        "binary": T.BinaryType(),
        "varbinary": T.BinaryType(),
        "image": T.BinaryType(),
    }.get(kind, T.StringType())


def struct_from_defs(defs: list[ColumnDef], keys=()) -> T.StructType:
    """Spark schema of declared columns; length, identity and key travel as field metadata."""
    key_set = {k.lower() for k in keys}
    fields = []
    for d in defs:
        meta = {"sqlType": d.data_type.lower(), "isIdentity": d.identity, "isKey": d.name.lower() in key_set}
        if d.max_length is not None:
            meta["maxLength"] = d.max_length
        fields.append(T.StructField(d.name, spark_type(d), d.nullable, meta))
    return T.StructType(fields)


def empty_from_schema(spark: SparkSession, defs: list[ColumnDef], keys=()) -> DataFrame:
    """An empty table with the declared columns."""
    return spark.createDataFrame([], struct_from_defs(defs, keys))


def align_to_schema(df: DataFrame, target: T.StructType, table: str = "") -> tuple[DataFrame, DataFrame]:
    """Keep the columns the target has, in its order and spelling; one warning per dropped column."""
    kept = [F.col(f"`{actual_name(df, f.name)}`").alias(f.name) for f in target.fields if actual_name(df, f.name)]
    have = {f.name.lower() for f in target.fields}
    dropped = [c for c in df.columns if c.lower() not in have]
    text = "{}.{}: left out, the target has no such column"
    rows = [(table, c, text.format(table, c)) for c in dropped]
    return df.select(*kept), df.sparkSession.createDataFrame(rows, WARNING)


def _parsed(col: Column, dtype: T.DataType, sql_type: str | None) -> Column:
    """Text as a value of the target type; NULL where it does not parse."""
    text = trimmed(col)
    if isinstance(dtype, T.BooleanType):
        low = F.lower(col)
        return F.when(low.isin(*TRUE), True).when(low.isin(*FALSE), False)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.when(text.rlike(WHOLE), text.try_cast(dtype))
    if isinstance(dtype, T.DecimalType):
        return F.when(text.rlike(GROUPED), F.replace(text, F.lit(","), F.lit("")).try_cast(dtype))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(text.rlike(FLOATING), text.try_cast(dtype))
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        stamp = F.coalesce(text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(s)) for s in DATE_SHAPES])
        return stamp.cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(col, F.lit("base64"))
    if sql_type == "uniqueidentifier":
        digits = F.regexp_replace(F.lower(text), "[^0-9a-f]", "")
        return F.when(text.rlike(GUID), F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
    return col.try_cast(dtype)


def coerce(df: DataFrame, target: T.StructType, keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Text cells become values of the target's types. Returns the rows and what did not parse.

    Blank text is NULL in every column that is not text. A cell that does not parse is NULL in the
    result and listed in the rejects with its row's keys.
    """
    cells, rejects = [], []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        goal = next((t for t in target.fields if t.name.lower() == f.name.lower()), None)
        is_text = isinstance(f.dataType, T.StringType)
        if goal is None or goal.dataType == f.dataType and goal.metadata.get("sqlType") != "uniqueidentifier":
            cells.append(col)
        elif not is_text:
            cells.append(col.try_cast(goal.dataType).alias(f.name))
        else:
            value = F.when(~is_blank(col), _parsed(col, goal.dataType, goal.metadata.get("sqlType")))
            bad = ~is_blank(col) & value.isNull()
            rejects.append(F.when(bad, F.struct(F.lit(f.name).alias("col"), col.alias("value"))))
            cells.append(value.alias(f.name))
    none = F.array().cast("array<struct<col:string,value:string>>")
    bad_cells = F.array_compact(F.array(*rejects)) if rejects else none
    return df.select(*cells), df.select(*keys, F.inline(bad_cells))


def fill_not_null(df: DataFrame, target: T.StructType) -> DataFrame:
    """NULL in a NOT NULL column becomes the type's default; types without one stay NULL."""
    strict = {f.name.lower(): f for f in target.fields if not f.nullable}
    out = {}
    for f in df.schema.fields:
        default = default_value(f.dataType)
        if f.name.lower() in strict and default is not None:
            out[f.name] = F.coalesce(F.col(f"`{f.name}`"), default)
    return df.withColumns(out)


def add_defined_columns(
    df: DataFrame, field_defs: DataFrame, type_map: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Add the columns that definition rows declare; true/false columns start as false.

    ``field_defs(name, type_id)``, ``type_map(type_id, spark_type)``. A definition of an unknown type
    is skipped. Returns the rows and one log row per definition. Definitions are as many as columns.
    """
    resolved = field_defs.join(type_map, "type_id", "left").select("name", "type_id", "spark_type").orderBy("name")
    have = {c.lower() for c in df.columns}
    out, log = {}, []
    for row in resolved.collect():
        if row["name"].lower() in have:
            log.append((row["name"], "exists"))
            continue
        if row["spark_type"] is None:
            log.append((row["name"], "unknown type"))
            continue
        have.add(row["name"].lower())
        start = F.lit(False) if row["spark_type"].lower() == "boolean" else F.lit(None).cast(row["spark_type"])
        out[row["name"]] = start
        log.append((row["name"], "added"))
    return df.withColumns(out), df.sparkSession.createDataFrame(log, "name string, action string")


def add_missing_columns(df: DataFrame, columns: T.StructType) -> DataFrame:
    """Add the listed columns that the frame lacks, as NULL. Running it again changes nothing."""
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in columns.fields if actual_name(df, f.name) is None}
    )


def schema_diff(spark: SparkSession, a: T.StructType, b: T.StructType) -> DataFrame:
    """Columns on one side only, and columns whose type or nullability differs."""
    cols = "_n string, {p}_name string, {p}_type string, {p}_nullable boolean"

    def side(schema, p):
        rows = [(f.name.lower(), f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
        return spark.createDataFrame(rows, cols.format(p=p))

    both = side(a, "a").join(side(b, "b"), "_n", "full_outer")
    change = (
        F.when(F.col("b_name").isNull(), "only_a")
        .when(F.col("a_name").isNull(), "only_b")
        .when(F.col("a_type") != F.col("b_type"), "type")
        .when(F.col("a_nullable") != F.col("b_nullable"), "nullability")
    )
    return both.select(
        F.coalesce("a_name", "b_name").alias("column_name"), change.alias("change"), "a_type", "b_type"
    ).where("change is not null")


def field_kinds(df: DataFrame, type_col: str, json_col: str) -> DataFrame:
    """(type_name, field, kind) of the top-level fields of JSON objects, per type: the kind that holds all values of the field."""
    docs = df.select(F.col(type_col).cast("string").alias("type_name"), F.try_parse_json(json_col).alias("doc")).where("doc is not null")
    fields = docs.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("doc").outer())).where("key is not null")
    return fields.groupBy("type_name", F.col("key").alias("field")).agg(F.schema_of_variant_agg("value").alias("kind"))


def field_drift(before: DataFrame, after: DataFrame, type_col: str, json_col: str) -> DataFrame:
    """Fields of free-form JSON objects that are ``new``, ``lost`` or ``retyped`` between two snapshots, per type.

    (type_name, field, change, old_kind, new_kind). No schema is declared: fields and their kinds come from all values. Texts that are no
    JSON object are skipped; a field of one kind beside NULLs keeps the kind. Equal kinds are not listed.
    """
    old = field_kinds(before, type_col, json_col).select(F.col("type_name").alias("_t"), F.col("field").alias("_f"), F.col("kind").alias("old_kind"))
    new = field_kinds(after, type_col, json_col).withColumnRenamed("kind", "new_kind")
    both = new.join(old, F.col("type_name").eqNullSafe(F.col("_t")) & (F.col("field") == F.col("_f")), "full_outer")
    change = F.when(F.col("_f").isNull(), "new").when(F.col("field").isNull(), "lost").when(F.col("old_kind") != F.col("new_kind"), "retyped")
    rows = both.withColumn("change", change).where("change is not null")
    named = F.when(F.col("field").isNull(), F.col("_t")).otherwise(F.col("type_name"))
    return rows.select(named.alias("type_name"), F.coalesce("field", "_f").alias("field"), "change", "old_kind", "new_kind")
