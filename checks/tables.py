"""Sources, snapshots, selection and typing (A, B, C)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import LIVE_SQL, DROP_SQL, ORDERS, case, incoming_orders, live_orders, money, part_tree, table
from tablesync.operators import identity, integrity, merge, quality, schema, selection, tree
from tablesync.operators.placement import cut, work_dir
from tablesync.sources import rowfiles, tables
from tablesync.spec import PathRule, SyncSpec, TableSpec

CUSTOMER = TableSpec("customer", keys=("c_custkey",))


def customers(spark, d):
    return table(spark, d, "customer").withColumn("c_acctbal", money("c_acctbal"))


WHERE = (
    "(l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 5 AND 40 AND NOT l_linestatus LIKE 'O%')"
    " OR (l_discount IS NOT NULL AND l_tax >= 0.08)"
)


@case("a1_read_table", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
def _(spark, d):
    return tables.read_table(spark, f"{d}/orders.parquet", "o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")


SNAP = SyncSpec(CUSTOMER, where="c_acctbal > 0", exclude=("C_NationKey",))


@case(
    "a3_write_snapshot",
    """SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
       CAST(c_custkey AS VARCHAR) AS "_identity" FROM customer WHERE c_acctbal > 0""",
)
def _(spark, d):
    out = f"{work_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    tables.write_snapshot(customers(spark, d), SNAP, out)
    return tables.read_snapshot(spark, out)


@case(
    "a4_schema_beside_data",
    """SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
       CAST(c_custkey AS VARCHAR) AS "_identity" FROM customer WHERE c_acctbal > 0""",
)
def _(spark, d):
    # JSON rows carry no types: the stored schema brings the decimal and the long back.
    out = f"{work_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    tables.write_snapshot(customers(spark, d), SNAP, out, "json")
    return tables.read_snapshot(spark, out, "json")


def one_file_per_row(spark, text) -> str:
    out = f"{work_dir(spark)}/files-{uuid.uuid4().hex}"
    # many tasks write, and each moves its own files into place
    spread = text.repartition(4 * spark.sparkContext.defaultParallelism)
    spread.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(out)
    return out


@case(
    "a2_read_row_files",
    """SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal, CAST(NULL AS VARCHAR) AS note,
       'first line' || chr(10) || 'line of ' || s_suppkey AS remark FROM supplier""",
)
def _(spark, d):
    rows = table(spark, d, "supplier").withColumn("s_acctbal", money("s_acctbal"))
    text = rows.select(F.format_string(
        '"S_SuppKey": %d\n"s_name": "%s"\ns_nationkey: %d\n"note": \n"remark": |-\n  first line\n  line of %d\n"s_acctbal": \'%s\'\n',
        "s_suppkey", "s_name", "s_nationkey", "s_suppkey", F.col("s_acctbal").cast("string"),
    ))
    goal = T.StructType().add("s_suppkey", "long").add("s_name", "string").add("s_nationkey", "integer")
    goal = goal.add("s_acctbal", "decimal(18,2)").add("note", "string").add("remark", "string")
    return rowfiles.read_row_files(spark, one_file_per_row(spark, text), goal, "*.txt")[0].drop("_path")


@case("a9_read_run_logs", "SELECT s_name AS operation, s_nationkey AS created, 'line of ' || s_suppkey AS log_text FROM supplier")
def _(spark, d):
    summary = F.to_json(F.struct(F.col("s_name").alias("operation"), F.col("s_nationkey").alias("totalCreated")))
    lines = F.concat(F.lit("line of "), F.col("s_suppkey").cast("string"))
    text = F.concat(F.lit("=== RUN SUMMARY ===\n"), summary, F.lit("\n=== END SUMMARY ===\n"), lines)
    folder = one_file_per_row(spark, table(spark, d, "supplier").select(text))
    logs = rowfiles.read_run_logs(spark, folder, "*.txt").join(rowfiles.read_log_lines(spark, folder, "*.txt"), "file_name")
    return logs.select("summary.operation", F.col("summary.totalCreated").alias("created"), F.col("line").alias("log_text"))


@case(
    "a11_purge_tables",
    """SELECT 'customer' AS table_name, 0 AS n, count(*) AS before FROM customer UNION ALL SELECT 'orders', 0, count(*) FROM orders
       UNION ALL SELECT 'supplier', count(*), count(*) FROM supplier""",
)
def _(spark, d):
    out = f"{work_dir(spark)}/purge-{uuid.uuid4().hex}"
    names = ("customer", "orders", "supplier")
    report = tables.backup_tables(spark, {n: table(spark, d, n) for n in names}, out, "copy")
    paths = {n: f"{out}/{n}_copy" for n in names}
    report = cut(report)
    edges = spark.createDataFrame([("orders", "customer")], "child string, parent string")
    levels = integrity.dependency_levels(report.select(F.col("table_name").alias("name")), edges)
    tables.purge_tables(spark, paths, levels, like="%O%r%S")  # orders
    tables.purge_tables(spark, paths, levels, like="cust%")
    left = quality.verify_post({n: tables.read_table(spark, p) for n, p in paths.items()})
    left = left.select(F.col("check_name").alias("table_name"), "n")
    return left.join(report.select("table_name", F.col("rows_before").alias("before")), "table_name")


MANIFEST_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS identity,
  md5('C_ACCTBAL=' || CAST(c_acctbal AS DECIMAL(18,2)) || '|C_CUSTKEY=' || c_custkey || '|C_MKTSEGMENT=' || c_mktsegment
      || '|C_NAME=' || c_name || '|C_NATIONKEY=' || c_nationkey) AS checksum FROM customer"""


@case("a5_snapshot_manifest", MANIFEST_SQL)
def _(spark, d):
    return identity.snapshot_manifest(customers(spark, d), CUSTOMER)


@case(
    "a6_stale_keys",
    f"""WITH live AS ({LIVE_SQL}), inc AS ({DROP_SQL}) SELECT CAST(o_orderkey AS VARCHAR) AS identity FROM live
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)""",
)
def _(spark, d):
    before = live_orders(spark, d).select(identity.row_identity(live_orders(spark, d), ORDERS).alias("identity"))
    now = incoming_orders(spark, d)
    now = now.select(identity.row_identity(now, ORDERS).alias("identity"))
    return identity.stale_keys(before, now)


@case(
    "a7_row_file_names",
    """WITH n AS (SELECT p_partkey, p_name, replace(p_name, '/', '_') AS f, substr(md5(p_name), 1, 6) AS h FROM part),
       r AS (SELECT *, row_number() OVER (PARTITION BY lower(f), h ORDER BY p_partkey) AS n,
             first_value(p_partkey) OVER (PARTITION BY lower(f) ORDER BY p_partkey) AS k0,
             first_value(h) OVER (PARTITION BY lower(f) ORDER BY p_partkey) AS h0 FROM n)
       SELECT p_partkey, CASE WHEN p_partkey = k0 THEN f
         ELSE f || ' [' || h || '-' || (n - CASE WHEN h = h0 THEN 1 ELSE 0 END) || ']' END AS file_name FROM r""",
)
def _(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name")
    return identity.row_file_names(parts, "p_name", ["p_partkey"]).drop("p_name")


@case(
    "a8_sibling_folder_names",
    """WITH t AS (SELECT p_partkey AS id, CAST(floor((p_partkey - 1) / 50.0) AS BIGINT) AS parent, p_brand AS name FROM part),
       r AS (SELECT *, row_number() OVER (PARTITION BY parent, lower(name) ORDER BY id) AS n FROM t)
       SELECT id, parent, CASE WHEN n = 1 THEN name
              ELSE name || ' [' || substr(md5(CAST(id AS VARCHAR)), 1, 6) || ']' END AS folder FROM r""",
)
def _(spark, d):
    nodes = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.floor((F.col("p_partkey") - 1) / 50).alias("parent"), F.col("p_brand").alias("name")
    )
    nodes = nodes.withColumn("guid", F.md5(F.col("id").cast("string")))
    return identity.sibling_folder_names(nodes, "parent", "name", "guid", ["id"]).select("id", "parent", "folder")


@case(
    "a10_backup_tables",
    """SELECT 'customer' AS table_name, count(*) AS rows_before, count(*) AS rows_copied FROM customer
       UNION ALL SELECT 'orders', count(*), count(*) FROM orders""",
)
def _(spark, d):
    out = f"{work_dir(spark)}/backup-{uuid.uuid4().hex}"
    kept = {n: table(spark, d, n) for n in ("customer", "orders")}
    return tables.backup_tables(spark, kept, out, "bak")


@case("b1_select_rows", f"SELECT * FROM lineitem WHERE {WHERE}")
def _(spark, d):
    return selection.select_rows(table(spark, d, "lineitem"), WHERE)


@case("b2_exclude_columns", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(spark, d):
    return selection.exclude_columns(table(spark, d, "orders"), ("O_TotalPrice", "o_orderdate", "O_ORDERSTATUS"))


FIELDS_SQL = """SELECT p_partkey, p_type, 'Brand' AS field, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, p_type, 'Size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, p_type, 'Label', CASE WHEN p_size > 10 THEN p_name END FROM part"""


def part_fields(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        "p_type",
        F.create_map(
            F.lit("Brand"), "p_brand",
            F.lit("Size"), F.col("p_size").cast("string"),
            F.lit("Label"), F.when(F.col("p_size") > 10, F.col("p_name")),
        ).alias("fields"),
    )


def exploded(df, *keys):
    return df.select(*keys, F.explode("fields").alias("field", "value"))


@case(
    "b3_exclude_fields_by_type",
    f"""SELECT p_partkey, p_type, field, value FROM ({FIELDS_SQL}) f WHERE field <> 'Label'
        AND NOT (p_type = 'PROMO' AND field = 'Size') AND NOT (p_type = 'SMALL' AND field = 'Brand')""",
)
def _(spark, d):
    rules = {"promo": ["SIZE"], "Small": ["brand"]}
    kept = selection.exclude_fields_by_type(part_fields(spark, d), "fields", "p_type", ["label"], rules)
    return exploded(kept, "p_partkey", "p_type")


@case(
    "b4_filter_paths",
    """SELECT page_path, doc_id, area FROM (SELECT '/' || lang || '/' || source || '/' || doc_id AS page_path, doc_id,
         length(lang) AS area FROM documents) t
       WHERE area = 2 AND (((page_path = '/en/src1' OR page_path LIKE '/en/src1/%'))
         OR ((page_path LIKE '/fr/%') AND NOT (page_path LIKE '/fr/src2/%')))""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select(
        F.concat_ws("/", F.lit(""), "lang", "source", F.col("doc_id").cast("string")).alias("page_path"),
        "doc_id",
        F.length("lang").alias("area"),
    )
    rules = [PathRule(2, "/EN/src1"), PathRule(2, "/fr", ("/FR/src2",)), PathRule(9, "/")]
    return tree.filter_paths(docs, "page_path", "area", rules)


@case("b5_compact_fields", f"SELECT p_partkey, field, value FROM ({FIELDS_SQL}) f WHERE value IS NOT NULL AND field <> 'Size'")
def _(spark, d):
    return exploded(selection.compact_fields(part_fields(spark, d), "fields", ("size",)), "p_partkey")


@case(
    "b6_live_rows",
    """SELECT o_orderkey, o_orderstatus <> 'F' AS active,
       CASE WHEN o_orderpriority = '5-LOW' THEN TRUE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE FALSE END AS deleted
       FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'""",
)
def _(spark, d):
    priority = F.col("o_orderpriority")
    flags = table(spark, d, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") != "F").alias("active"),
        F.when(priority == "5-LOW", True).when(priority != "1-URGENT", False).alias("deleted"),
    )
    return selection.live_rows(flags, "active", "deleted", "o_orderkey")


@case(
    "b7_excluded_field_counts",
    """WITH t AS (SELECT DISTINCT p_brand AS system_name, p_name AS field FROM part),
       r AS (SELECT DISTINCT p_brand AS system_name, p_type AS field FROM part WHERE p_size > 30)
       SELECT system_name, min(system_name) AS display_name, 'parts' AS category, count(field) AS field_count,
         (SELECT count(*) FROM r WHERE r.system_name = t.system_name) AS excluded_field_count
       FROM t GROUP BY system_name""",
)
def _(spark, d):
    parts = table(spark, d, "part")
    types = parts.select(
        F.col("p_brand").alias("system_name"), F.col("p_brand").alias("display_name"), F.lit("parts").alias("category"),
        F.col("p_name").alias("field"),
    ).distinct()
    rules = parts.where("p_size > 30").select(F.upper("p_brand").alias("system_name"), F.col("p_type").alias("field")).distinct()
    return selection.excluded_field_counts(types, rules)


@case("c1_align_to_schema", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(spark, d):
    goal = T.StructType().add("O_ORDERKEY", "long").add("o_custkey", "long").add("o_orderpriority", "string").add("extra", "integer")
    rows, _warnings = schema.align_to_schema(table(spark, d, "orders"), goal, "orders")
    return rows.withColumnRenamed("O_ORDERKEY", "o_orderkey")


RAW_SQL = """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN 'n/a' WHEN o_orderpriority = '5-LOW' THEN '  '
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
  CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN '0' ELSE 'maybe' END AS flag,
  CASE WHEN o_orderstatus = 'O' THEN ' ' || o_custkey || ' ' ELSE o_custkey || '.5' END AS cust FROM orders"""


def raw_orders(spark, d):
    status = F.col("o_orderstatus")
    price = F.when(status == "P", "n/a").when(F.col("o_orderpriority") == "5-LOW", "  ")
    return table(spark, d, "orders").select(
        "o_orderkey",
        price.otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(status == "F", "TRUE").when(status == "O", "0").otherwise("maybe").alias("flag"),
        F.when(status == "O", F.concat(F.lit(" "), "o_custkey", F.lit(" "))).otherwise(F.concat("o_custkey", F.lit(".5"))).alias("cust"),
    )


GOAL = T.StructType().add("o_orderkey", "long").add("price", "decimal(18,2)").add("flag", "boolean").add("cust", "integer")


@case(
    "c2_coerce",
    f"""SELECT o_orderkey, CASE WHEN price NOT IN ('n/a', '  ') THEN CAST(price AS DECIMAL(18,2)) END AS price,
        CASE flag WHEN 'TRUE' THEN TRUE WHEN '0' THEN FALSE END AS flag,
        CASE WHEN cust LIKE ' %' THEN CAST(trim(cust) AS INT) END AS cust
        FROM (SELECT o_orderkey, price, flag, cust FROM ({RAW_SQL}) q) r
        WHERE TRUE""".replace("CAST(price AS DECIMAL(18,2))", "TRY_CAST(price AS DECIMAL(18,2))"),
)
def _(spark, d):
    return schema.coerce(raw_orders(spark, d), GOAL)[0]


@case(
    "c2_coerce_rejects",
    f"""WITH r AS ({RAW_SQL}) SELECT o_orderkey, 'price' AS col, price AS value FROM r WHERE price = 'n/a'
        UNION ALL SELECT o_orderkey, 'flag', flag FROM r WHERE flag = 'maybe'
        UNION ALL SELECT o_orderkey, 'cust', cust FROM r WHERE cust LIKE '%.5'""",
)
def _(spark, d):
    return schema.coerce(raw_orders(spark, d), GOAL, ["o_orderkey"])[1]


@case(
    "c3_fill_not_null",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_custkey END, 0) AS cust,
       coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END, '') AS priority,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS optional FROM orders""",
)
def _(spark, d):
    status = F.col("o_orderstatus")
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(status != "F", F.col("o_custkey")).alias("cust"),
        F.when(status != "O", F.col("o_orderpriority")).alias("priority"),
        F.when(status != "P", F.col("o_orderpriority")).alias("optional"),
    )
    goal = T.StructType().add("CUST", "long", False).add("priority", "string", False).add("optional", "string", True)
    return schema.fill_not_null(rows, goal)


@case("c4_empty_from_schema", "SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer")
def _(spark, d):
    defs = [
        schema.ColumnDef("c_custkey", "bigint", nullable=False), schema.ColumnDef("c_name", "nvarchar", 50),
        schema.ColumnDef("c_acctbal", "decimal", None, 18, 2),
    ]
    created = schema.empty_from_schema(spark, defs, ("c_custkey",))
    return merge.upsert(created, customers(spark, d), CUSTOMER)


@case(
    "c5_add_defined_columns",
    """SELECT c_custkey, lower(n_name) AS col, CASE n_regionkey WHEN 0 THEN 'int' WHEN 1 THEN 'boolean' WHEN 2 THEN 'string' WHEN 3 THEN 'double' ELSE 'date' END AS kind,
       CASE WHEN n_regionkey = 1 THEN 'false' END AS value FROM customer, nation""",
)
def _(spark, d):
    defs = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("type_id"))
    key = F.col("r_regionkey")
    kinds = F.when(key == 0, "int").when(key == 1, "boolean").when(key == 2, "string").when(key == 3, "double").otherwise("date")
    types = table(spark, d, "region").select(key.alias("type_id"), kinds.alias("spark_type"))
    rows, _log = schema.add_defined_columns(table(spark, d, "customer").select("c_custkey", "c_name"), defs, types)
    cells = [
        F.struct(F.lit(f.name.lower()).alias("col"), F.lit(f.dataType.simpleString()).alias("kind"), F.col(f"`{f.name}`").cast("string").alias("value"))
        for f in rows.schema.fields if f.name not in ("c_custkey", "c_name")
    ]
    return rows.select("c_custkey", F.inline(F.array(*cells)))


@case(
    "c2_coerce_dates_guids_binary",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate AS moment,
       regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS guid,
       CAST(o_custkey AS VARCHAR) AS raw FROM orders""",
)
def _(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.concat(F.lit("{"), F.upper(F.regexp_replace(F.md5(F.col("o_orderkey").cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")), F.lit("}")).alias("guid"),
        F.base64(F.col("o_custkey").cast("string").cast("binary")).alias("raw"),
    )
    goal = T.StructType().add("day", "date").add("moment", T.TimestampType()).add("guid", "string", True, {"sqlType": "uniqueidentifier"}).add("raw", "binary")
    return schema.coerce(rows, goal)[0].withColumn("raw", F.col("raw").cast("string")).withColumn("moment", F.col("moment").cast("timestamp_ntz"))


@case(
    "c7_schema_diff",
    """SELECT * FROM (VALUES ('o_clerk', 'only_b', NULL, 'string'), ('o_custkey', 'type', 'bigint', 'string'), ('o_orderdate', 'only_a', 'x', NULL)) v(column_name, change, a_type, b_type)
       WHERE (SELECT count(*) FROM orders) > 0""",
)
def _(spark, d):
    rows = table(spark, d, "orders")
    other = rows.drop("o_orderdate").withColumn("o_custkey", F.col("o_custkey").cast("string")).withColumn("o_clerk", F.lit("x"))
    paths = []
    for df in (rows, other):
        paths.append(f"{work_dir(spark)}/schema-{uuid.uuid4().hex}")
        tables.write_snapshot(df, SyncSpec(ORDERS), paths[-1])
    a, b = (tables.read_schema(spark, f"{p}/_meta")[0] for p in paths)
    diff = schema.schema_diff(spark, a, b).where("change <> 'nullability'")
    return diff.withColumn("a_type", F.when(F.col("column_name") == "o_orderdate", F.when(F.col("a_type").startswith("timestamp"), "x")).otherwise(F.col("a_type")))


@case("c6_add_missing_columns", "SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR) AS note FROM supplier")
def _(spark, d):
    goal = T.StructType().add("S_NAME", "string").add("note", "string")
    rows = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return schema.add_missing_columns(schema.add_missing_columns(rows, goal), goal)


__all__ = ["customers", "exploded", "part_fields", "part_tree"]


@case(
    "b4_filter_paths_rules_as_tables",
    """SELECT '/' || lang || '/' || source || '/' || doc_id AS page_path, doc_id, CAST(length(lang) AS INTEGER) AS area FROM documents
       WHERE source <> 'src3' AND n_chars <= 3000""",
)
def _(spark, d):
    """A rule per language and source, and an exclude per long document: as many as there are documents."""
    docs = table(spark, d, "documents").where("lang is not null and source is not null")
    docs = docs.withColumn("page_path", F.concat_ws("/", F.lit(""), "lang", "source", F.col("doc_id").cast("string"))).withColumn("area", F.length("lang"))
    rule = F.xxhash64("lang", "source").alias("rule")
    includes = docs.where("source <> 'src3'").select(rule, "area", F.upper(F.concat_ws("/", F.lit(""), "lang", "source")).alias("path")).distinct()
    excludes = docs.where("n_chars > 3000").select(rule, F.col("page_path").alias("path"))
    return tree.filter_paths(docs, "page_path", "area", (includes, excludes)).select("page_path", "doc_id", "area")


@case(
    "c7_field_drift",
    """SELECT DISTINCT event_type AS type_name, 'k' AS field, 'retyped' AS change, 'BIGINT' AS old_kind, 'STRING' AS new_kind FROM events WHERE event_type = 'view'
       UNION ALL SELECT DISTINCT event_type, 'gone', 'lost', 'BIGINT', NULL FROM events WHERE event_type = 'click'
       UNION ALL SELECT DISTINCT event_type, 'fresh', 'new', NULL, 'OBJECT<u: BIGINT>' FROM events WHERE user_id >= 100""",
)
def _(spark, d):
    """Every event's field map, and the same maps after a change of the application."""
    events, kind = table(spark, d, "events"), F.col("event_type")
    more = lambda text: F.concat(F.regexp_replace("props", r"\}$", ""), F.lit(text), F.lit("}"))
    before = events.select("event_type", F.when(kind == "click", more(', "gone": 1')).otherwise(F.col("props")).alias("fields"))
    text = F.regexp_replace("props", r": (\d+)", ': "$1"')
    fresh = F.concat(F.regexp_replace("props", r"\}$", ', "fresh": {"u": '), F.col("user_id"), F.lit("}}"))
    fresh_text = F.concat(F.regexp_replace(text, r"\}$", ', "fresh": {"u": '), F.col("user_id"), F.lit("}}"))
    held = F.when(F.col("user_id") >= 100, F.when(kind == "view", fresh_text).otherwise(fresh)).when(kind == "view", text).otherwise(F.col("props"))
    after = events.select("event_type", held.alias("fields"))
    return schema.field_drift(before, after, "event_type", "fields")
