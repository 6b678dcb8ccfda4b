"""Merging and dry runs (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    CHECKSUM_SQL, DROP_SQL, LIVE_SQL, ORDERS, PAIR_SQL, SEED_SQL, TREE_SQL, case, incoming_orders, live_orders,
    part_tree, table, unset_orders,
)
from checks.identities import BY_NAME, MAP_SQL, NAME_SQL, customer_map, named_parts
from checks.tables import FIELDS_SQL, exploded, part_fields
from tablesync.functions.unset import is_unset
from tablesync.operators import merge, selection, tree
from tablesync.plans.apply import apply_all, apply_snapshot
from tablesync.plans.content import apply_by_guid
from tablesync.spec import DESTINATION_WINS, SyncSpec, TableSpec

COLS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
MERGED = ", ".join(f"CASE WHEN i.o_orderkey IS NOT NULL THEN i.{c} ELSE t.{c} END AS {c}" for c in COLS)


@case(
    "e1_upsert",
    f"{PAIR_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {MERGED} FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey",
)
def _(spark, d):
    return merge.upsert(live_orders(spark, d), incoming_orders(spark, d), ORDERS)


@case(
    "e1_upsert_partial_columns",
    f"""{PAIR_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
        CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
        FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey""",
)
def _(spark, d):
    narrow = incoming_orders(spark, d).select("o_orderkey", F.col("o_orderpriority").alias("O_OrderPriority"))
    return merge.upsert(live_orders(spark, d), narrow, ORDERS)


_DIFFER = f"({CHECKSUM_SQL.format(a='t')} <> {CHECKSUM_SQL.format(a='i')})"
_EMPTY = {
    "o_custkey": "t.o_custkey = 0", "o_orderstatus": "coalesce(t.o_orderstatus, '') = ''",
    "o_totalprice": "t.o_totalprice = 0", "o_orderpriority": "coalesce(t.o_orderpriority, '') = ''",
}
_FILL = {c: f"({_DIFFER} AND {e})" for c, e in _EMPTY.items()}
FILLED = ", ".join(
    f"CASE WHEN t.o_orderkey IS NULL OR (i.o_orderkey IS NOT NULL AND {_FILL[c]}) THEN i.{c} ELSE t.{c} END AS {c}" for c in COLS
)
NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN {_FILL[c]} THEN '{c}' END" for c in COLS) + ")"


@case(
    "e2_seed_fill",
    f"""{SEED_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {FILLED},
        CASE WHEN i.o_orderkey IS NULL THEN 'kept' WHEN t.o_orderkey IS NULL THEN 'created'
             WHEN {NAMES} = '' THEN 'skipped' ELSE 'updated' END AS outcome,
        CASE WHEN t.o_orderkey IS NULL OR i.o_orderkey IS NULL THEN '' ELSE {NAMES} END AS filled
        FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey""",
)
def _(spark, d):
    return merge.seed_fill(unset_orders(spark, d), incoming_orders(spark, d), ORDERS)


@case(
    "e2_seed_fill_by_name",
    f"""WITH live AS (SELECT p_partkey, p_name, p_brand, CASE WHEN p_type = 'PROMO' THEN 0 ELSE p_size END AS p_size FROM part WHERE p_size <= 40),
        inc AS (SELECT max(p_partkey) AS p_partkey, p_name, 'Brand#X' AS p_brand, max(p_size) AS p_size FROM part GROUP BY p_name),
        last AS (SELECT max(p_partkey) AS k, lower(trim(p_name)) AS n FROM live GROUP BY 2),
        fill AS (SELECT l.k, i.p_size FROM inc i JOIN last l ON l.n = lower(trim(i.p_name)))
        SELECT t.p_partkey, t.p_name, t.p_brand, CASE WHEN f.k IS NOT NULL AND t.p_size = 0 THEN f.p_size ELSE t.p_size END AS p_size
        FROM live t LEFT JOIN fill f ON f.k = t.p_partkey
        UNION ALL SELECT i.p_partkey, i.p_name, i.p_brand, i.p_size FROM inc i WHERE lower(trim(i.p_name)) NOT IN (SELECT n FROM last)""",
)
def _(spark, d):
    parts = table(spark, d, "part")
    size = F.when(F.col("p_type") == "PROMO", 0).otherwise(F.col("p_size"))
    live = parts.where("p_size <= 40").select("p_partkey", "p_name", "p_brand", size.alias("p_size"))
    inc = parts.groupBy("p_name").agg(F.max("p_partkey").alias("p_partkey"), F.max("p_size").alias("p_size"))
    inc = inc.select("p_partkey", "p_name", F.lit("Brand#X").alias("p_brand"), "p_size")
    return merge.seed_fill(live, inc, BY_NAME).drop("outcome", "filled")


# Every line under its order and number: keys repeat, and the last line by part and supplier counts.
LINES_SQL = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_partkey * 1000 + l_suppkey) * 100 + l_quantity DESC, l_returnflag DESC) AS n FROM lineitem),
  inc AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM r WHERE n = 1),
  live AS (SELECT l_orderkey, l_linenumber, -1.0 AS l_quantity, 'old' AS l_returnflag FROM inc WHERE l_returnflag <> 'A'
           UNION ALL SELECT -l_orderkey - 1, l_linenumber, 0.0, 'own' FROM inc)"""
LINES = TableSpec("lineitem", ("l_orderkey", "l_linenumber"))


def repeated_lines(spark, d):
    path = F.concat_ws("|", F.lpad(((F.col("l_partkey") * 1000 + F.col("l_suppkey")) * 100 + F.col("l_quantity")).cast("long").cast("string"), 20, "0"), "l_returnflag").alias("path")
    inc = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", path)
    one = merge.dedupe_incoming(inc, ["l_orderkey", "l_linenumber"], "path")
    old = one.where("l_returnflag <> 'A'").select("l_orderkey", "l_linenumber", F.lit(-1.0).alias("l_quantity"), F.lit("old").alias("l_returnflag"))
    own = one.select((-F.col("l_orderkey") - 1).alias("l_orderkey"), "l_linenumber", F.lit(0.0).alias("l_quantity"), F.lit("own").alias("l_returnflag"))
    return old.unionByName(own), inc


_LINE = ", ".join(f"CASE WHEN i.l_orderkey IS NOT NULL THEN i.{c} ELSE t.{c} END AS {c}" for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@case("e1_upsert_repeated_keys", f"{LINES_SQL} SELECT {_LINE} FROM live t FULL JOIN inc i ON i.l_orderkey = t.l_orderkey AND i.l_linenumber = t.l_linenumber")
def _(spark, d):
    live, inc = repeated_lines(spark, d)
    return merge.upsert(live, inc, LINES, "path")


@case(
    "e4_update_subset_repeated_keys",
    f"""{LINES_SQL} SELECT t.l_orderkey, t.l_linenumber, coalesce(i.l_quantity, t.l_quantity) AS l_quantity, t.l_returnflag
        FROM live t LEFT JOIN inc i ON i.l_orderkey = t.l_orderkey AND i.l_linenumber = t.l_linenumber""",
)
def _(spark, d):
    live, inc = repeated_lines(spark, d)
    return merge.update_subset(live, inc, ["l_orderkey", "l_linenumber"], ["l_quantity"], "path")


@case(
    "e14_apply_repeated_keys",
    f"""{LINES_SQL}, o AS (SELECT CASE WHEN t.l_orderkey IS NULL THEN 'created' ELSE 'updated' END AS outcome FROM inc i
          LEFT JOIN live t ON i.l_orderkey = t.l_orderkey AND i.l_linenumber = t.l_linenumber
          UNION ALL SELECT 'skipped' FROM r WHERE n > 1)
        SELECT outcome, count(*) AS n FROM o GROUP BY outcome""",
)
def _(spark, d):
    live, inc = repeated_lines(spark, d)
    return apply_snapshot(live, inc, SyncSpec(LINES), order="path").outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


@case("e3_replace_all", "SELECT l_orderkey, l_quantity, CAST(NULL AS VARCHAR) AS note FROM lineitem")
def _(spark, d):
    lines = table(spark, d, "lineitem")
    target = lines.select("l_orderkey", "l_quantity", F.lit("old").alias("note"))
    return merge.replace_all(target, lines.select("L_ORDERKEY", "l_quantity", "l_tax"))


@case(
    "e4_update_subset",
    f"""WITH live AS ({LIVE_SQL}), inc AS ({DROP_SQL}) SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice,
        CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
        FROM live t LEFT JOIN inc i ON i.o_orderkey = t.o_orderkey""",
)
def _(spark, d):
    return merge.update_subset(live_orders(spark, d), incoming_orders(spark, d), ["o_orderkey"], ["o_orderpriority"])


OTHER_SQL = """SELECT p_partkey, 'Size' AS field, CAST(p_size + 1 AS VARCHAR) AS value FROM part WHERE p_size <= 40
  UNION ALL SELECT p_partkey, 'Label', 'seeded' FROM part WHERE p_size <= 40
  UNION ALL SELECT p_partkey, 'Extra', p_type FROM part WHERE p_size <= 40"""


def other_fields(spark, d):
    return table(spark, d, "part").where("p_size <= 40").select(
        "p_partkey",
        F.create_map(
            F.lit("Size"), (F.col("p_size") + 1).cast("string"), F.lit("Label"), F.lit("seeded"),
            F.lit("Extra"), F.col("p_type"), F.lit("Sort"), F.lit("9"),
        ).alias("fields"),
    )


def repeated_fields(spark, d):
    """Each incoming row comes twice; the second one counts."""
    rows = other_fields(spark, d)
    stale = rows.withColumn("fields", F.transform_values("fields", lambda k, v: F.lit("stale")))
    return stale.withColumn("seq", F.lit(1)).unionByName(rows.withColumn("seq", F.lit(2)))


@case(
    "e5_overwrite_fields",
    f"""WITH t AS ({FIELDS_SQL}), s AS ({OTHER_SQL}), k AS (SELECT p_partkey FROM part WHERE p_size <= 40)
        SELECT t.p_partkey, t.field, CASE WHEN k.p_partkey IS NULL THEN t.value WHEN s.field IS NOT NULL THEN s.value END AS value
        FROM t LEFT JOIN k USING (p_partkey) LEFT JOIN s ON s.p_partkey = t.p_partkey AND s.field = t.field
        UNION ALL SELECT p_partkey, field, value FROM s WHERE field = 'Extra'""",
)
def _(spark, d):
    return exploded(selection.overwrite_fields(part_fields(spark, d), repeated_fields(spark, d), ["p_partkey"], "fields", order="seq"), "p_partkey")


@case(
    "e6_fill_fields",
    f"""WITH t AS ({FIELDS_SQL}), s AS ({OTHER_SQL}), n AS (SELECT p_partkey,
          CASE WHEN p_size > 40 THEN 0 WHEN p_size > 10 THEN 1 ELSE 2 END AS n_filled,
          CASE WHEN p_size > 40 THEN 0 WHEN p_size > 10 THEN 2 ELSE 1 END AS n_left FROM part),
        m AS (SELECT t.p_partkey, t.field, CASE WHEN coalesce(t.value, '') = '' THEN coalesce(s.value, t.value) ELSE t.value END AS value
              FROM t LEFT JOIN s ON s.p_partkey = t.p_partkey AND s.field = t.field
              UNION ALL SELECT p_partkey, field, value FROM s WHERE field = 'Extra')
        SELECT m.p_partkey, n_filled, n_left, field, value FROM m JOIN n USING (p_partkey)""",
)
def _(spark, d):
    rows = selection.fill_fields(part_fields(spark, d), repeated_fields(spark, d), ["p_partkey"], "fields", order="seq")
    return exploded(rows, "p_partkey", "n_filled", "n_left")


@case(
    "e7_is_unset",
    """SELECT event_id, event_type = 'view' OR FALSE AS text_unset, value = 0 OR value IS NULL AS number_unset,
       event_type IN ('click', 'error') AS flag_unset, event_type = 'view' AS decimal_unset, event_type = 'view' AS long_unset,
       event_type IN ('view', 'click') AS date_unset, event_type IN ('view', 'click') AS stamp_unset FROM events""",
)
def _(spark, d):
    kind = F.col("event_type")
    rows = table(spark, d, "events").select(
        "event_id",
        F.when(kind != "view", kind).alias("text"),
        F.col("value").alias("number"),
        F.when(kind == "click", None).otherwise(kind != "error").alias("flag"),
        F.when(kind == "view", 0).otherwise(1).cast("decimal(18,2)").alias("decimal"),
        F.when(kind == "view", 0).otherwise(7).cast("long").alias("long"),
        F.when(kind == "view", F.lit("0001-01-01")).when(kind == "click", None).otherwise("2020-02-02").cast("date").alias("date"),
        F.when(kind == "view", F.lit("0001-01-01 00:00:00")).when(kind == "click", None).otherwise("2020-02-02 02:02:02").cast("timestamp").alias("stamp"),
    )
    unset = [is_unset(F.col(f.name), f.dataType).alias(f"{f.name}_unset") for f in rows.schema.fields[1:]]
    return rows.select("event_id", *unset)


@case(
    "e8_fill_scalars",
    f"""{SEED_SQL}, j AS (SELECT t.*, i.o_orderkey IS NOT NULL AS hit, i.o_orderpriority AS ip, i.o_totalprice AS it, i.o_custkey AS ic,
             i.o_orderstatus AS ist FROM live t LEFT JOIN inc i ON i.o_orderkey = t.o_orderkey)
        SELECT o_orderkey, CASE WHEN hit THEN ic ELSE o_custkey END AS o_custkey,
          CASE WHEN hit AND o_orderpriority = '' THEN ip ELSE o_orderpriority END AS o_orderpriority,
          CASE WHEN hit AND ist <> 'O' AND o_totalprice = 0 THEN it ELSE o_totalprice END AS price,
          CASE WHEN hit AND ist <> 'O' AND coalesce(o_orderstatus, '') = '' THEN ist ELSE o_orderstatus END AS status,
          CAST(CASE WHEN hit THEN (CASE WHEN o_orderpriority = '' THEN 1 ELSE 0 END) + (CASE WHEN ist = 'O' THEN 0 ELSE
            (CASE WHEN o_totalprice = 0 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(o_orderstatus, '') = '' THEN 1 ELSE 0 END) END)
            ELSE 0 END AS INT) AS n_filled FROM j""",
)
def _(spark, d):
    def nested(df, drop_open):
        seo = F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
        seo = F.when(F.col("o_orderstatus") != "O", seo) if drop_open else seo
        return df.select("o_orderkey", "o_custkey", "o_orderpriority", seo.alias("seo"))

    def repeated(df):
        stale = df.withColumns({"o_custkey": F.col("o_custkey") + 1, "o_orderpriority": F.lit("stale"), "seq": F.lit(1)})
        return stale.unionByName(df.withColumn("seq", F.lit(2)))

    rows = merge.fill_scalars(
        nested(unset_orders(spark, d), False), repeated(nested(incoming_orders(spark, d), True)), ["o_orderkey"],
        ["o_orderpriority"], {"seo": ["price", "status"]}, always=["o_custkey"], order="seq",
    )
    return rows.select("o_orderkey", "o_custkey", "o_orderpriority", "seo.price", "seo.status", "n_filled")


_DIFFS = " UNION ALL ".join(
    f"""SELECT t.o_orderkey, '{c}' AS col, CAST(t.{c} AS VARCHAR) AS old_value, CAST(i.{c} AS VARCHAR) AS new_value
        FROM live t JOIN inc i ON i.o_orderkey = t.o_orderkey WHERE t.{c} IS DISTINCT FROM i.{c}"""
    for c in COLS
)


@case("e9_diff_rows", f"{SEED_SQL} {_DIFFS}")
def _(spark, d):
    stale = incoming_orders(spark, d).withColumns({"o_orderpriority": F.lit("stale"), "seq": F.lit(1)})
    both = stale.unionByName(incoming_orders(spark, d).withColumn("seq", F.lit(2)))
    return merge.diff_rows(unset_orders(spark, d), both, ORDERS, order="seq")


_WOULD = " UNION ALL ".join(
    f"""SELECT t.o_orderkey, '{c}' AS col, CAST(i.{c} AS VARCHAR) AS seed FROM live t JOIN inc i ON i.o_orderkey = t.o_orderkey
        WHERE {_FILL[c]}"""
    for c in COLS
)


@case("e10_would_fill", f"{SEED_SQL} {_WOULD}")
def _(spark, d):
    return merge.would_fill(unset_orders(spark, d), incoming_orders(spark, d), ORDERS)


GUID_SQL = f"""WITH nodes AS (SELECT id, parent, name, sort, md5(CAST(id AS VARCHAR)) AS guid, 1 AS area FROM ({TREE_SQL}) x),
  tgt AS (SELECT id + 7000000 AS id, guid, area, name FROM nodes WHERE sort > 15),
  fresh AS (SELECT guid, row_number() OVER (ORDER BY md5('1|' || guid), '1|' || guid) AS n FROM nodes WHERE guid NOT IN (SELECT guid FROM tgt)),
  ids AS (SELECT nodes.id AS source_id, coalesce(tgt.id, (SELECT max(id) FROM tgt) + fresh.n) AS target_id
          FROM nodes LEFT JOIN tgt USING (guid) LEFT JOIN fresh USING (guid))"""


def content_nodes(spark, d):
    return part_tree(spark, d).select(
        "id", "parent", "name", "sort", F.md5(F.col("id").cast("string")).alias("guid"), F.lit(1).alias("area")
    )


@case(
    "e11_apply_by_guid",
    f"""{GUID_SQL} SELECT s.target_id AS id, p.target_id AS parent, n.guid, n.area, n.name,
        CASE WHEN n.guid IN (SELECT guid FROM tgt) THEN 'updated' ELSE 'created' END AS outcome
        FROM nodes n JOIN ids s ON s.source_id = n.id LEFT JOIN ids p ON p.source_id = n.parent""",
)
def _(spark, d):
    nodes = content_nodes(spark, d)
    target = nodes.where("sort > 15").select(
        (F.col("id") + 7000000).alias("id"), F.lit(None).cast("long").alias("parent"), "guid", "area", F.lit("old").alias("name")
    )
    incoming = nodes.select("id", "parent", "guid", "area", "name")
    return apply_by_guid(target, incoming, "id", "guid", "area", "parent")[0]


@case(
    "e12_cascade_skip",
    f"""WITH RECURSIVE nodes AS ({TREE_SQL}), failed AS (SELECT id FROM nodes WHERE kind = 'PROMO' AND sort > 25),
        down AS (SELECT id, 0 AS n FROM failed UNION SELECT c.id, 1 FROM nodes c JOIN down ON c.parent = down.id)
        SELECT nodes.id, CASE WHEN nodes.id IN (SELECT id FROM down WHERE n = 1) THEN 'skipped'
               WHEN nodes.id IN (SELECT id FROM failed) THEN 'failed' ELSE 'applied' END AS outcome FROM nodes""",
)
def _(spark, d):
    nodes = part_tree(spark, d)
    return tree.cascade_skip(nodes, "id", "parent", nodes.where("kind = 'PROMO' and sort > 25"), "id")


@case(
    "e13_dedupe_incoming",
    """WITH r AS (SELECT l_orderkey, l_linenumber, (l_partkey * 1000 + l_suppkey) * 100 + l_quantity AS path, l_quantity, row_number() OVER
         (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_partkey * 1000 + l_suppkey) * 100 + l_quantity DESC) AS n FROM lineitem)
       SELECT l_orderkey, l_linenumber, path, l_quantity FROM r WHERE n = 1""",
)
def _(spark, d):
    path = ((F.col("l_partkey") * 1000 + F.col("l_suppkey")) * 100 + F.col("l_quantity")).alias("path")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", path, "l_quantity")
    return merge.dedupe_incoming(rows, ["l_orderkey", "l_linenumber"], "path")


_SUMMARY = """SELECT coalesce(table_name, '(total)') AS table_name, count(*) FILTER (WHERE outcome = 'created') AS created,
  count(*) FILTER (WHERE outcome = 'updated') AS updated, count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
  count(*) FILTER (WHERE outcome = 'failed') AS failed FROM o GROUP BY ROLLUP (table_name)"""


def as_text(df):
    """Incoming rows the way row files bring them: every cell is text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.lit("x").alias("unknown_column"))


@case(
    "e14_apply_snapshot",
    f"""{PAIR_SQL}, o AS (SELECT 'orders' AS table_name, CASE WHEN t.o_orderkey IS NULL THEN 'created'
        WHEN t.o_orderpriority = i.o_orderpriority THEN 'skipped' ELSE 'updated' END AS outcome
        FROM inc i LEFT JOIN live t ON t.o_orderkey = i.o_orderkey) {_SUMMARY}""",
)
def _(spark, d):
    return apply_snapshot(live_orders(spark, d), as_text(incoming_orders(spark, d)), SyncSpec(ORDERS)).summary()


@case(
    "e14_apply_snapshot_table",
    f"{PAIR_SQL} SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {MERGED} FROM live t FULL JOIN inc i ON i.o_orderkey = t.o_orderkey",
)
def _(spark, d):
    return apply_snapshot(live_orders(spark, d), as_text(incoming_orders(spark, d)), SyncSpec(ORDERS)).table


@case(
    "e14_apply_seed",
    f"""{SEED_SQL}, o AS (SELECT 'orders' AS table_name, CASE WHEN t.o_orderkey IS NULL THEN 'created'
        WHEN {NAMES} = '' THEN 'skipped' ELSE 'updated' END AS outcome
        FROM inc i LEFT JOIN live t ON t.o_orderkey = i.o_orderkey) {_SUMMARY}""",
)
def _(spark, d):
    spec = SyncSpec(ORDERS)
    return apply_snapshot(unset_orders(spark, d), as_text(incoming_orders(spark, d)), spec, DESTINATION_WINS).summary()


@case(
    "e14_apply_all",
    f"""{PAIR_SQL}, o AS (SELECT 'orders' AS table_name, CASE WHEN t.o_orderkey IS NULL THEN 'created'
          WHEN t.o_orderpriority = i.o_orderpriority THEN 'skipped' ELSE 'updated' END AS outcome
          FROM inc i LEFT JOIN live t ON t.o_orderkey = i.o_orderkey
          UNION ALL SELECT 'customer', CASE WHEN c_acctbal < 0 THEN 'created' ELSE 'skipped' END FROM customer
          UNION ALL SELECT 'notes', 'created' FROM supplier) {_SUMMARY}""",
)
def _(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    notes = table(spark, d, "supplier").select("s_suppkey", "s_name")
    solvent = table(spark, d, "customer").where("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment")
    targets = {"orders": live_orders(spark, d), "customer": solvent, "notes": notes.limit(0)}
    snapshots = {"orders": as_text(incoming_orders(spark, d)), "customer": customers, "notes": notes}
    specs = [SyncSpec(ORDERS), SyncSpec(TableSpec("customer", ("c_custkey",))), SyncSpec(TableSpec("notes")), SyncSpec(TableSpec("absent", ("x",)))]
    return apply_all(targets, snapshots, specs).summary()


@case(
    "e14_apply_keyless_links",
    f"""WITH m AS ({MAP_SQL}) SELECT o_orderkey, 'see Default.aspx?ID=' || coalesce(target_id, o_custkey) AS note
        FROM orders LEFT JOIN m ON source_id = o_custkey""",
)
def _(spark, d):
    note = F.concat(F.lit("see Default.aspx?ID="), F.col("o_custkey").cast("string")).alias("note")
    rows = table(spark, d, "orders").select("o_orderkey", note)
    spec = SyncSpec(TableSpec("notes"), link_cols=("note",))
    return apply_snapshot(rows.limit(0), rows, spec, page_map=customer_map(spark, d)).table


@case(
    "e14_apply_by_name",
    f"""{NAME_SQL}, o AS (SELECT 'part' AS table_name, CASE WHEN l.b = i.p_brand AND l.z = i.p_size THEN 'skipped'
        WHEN k.p_partkey IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome
        FROM inc i LEFT JOIN last l ON l.n = lower(trim(i.p_name)) LEFT JOIN live k ON k.p_partkey = i.p_partkey) {_SUMMARY}""",
)
def _(spark, d):
    live, inc = named_parts(spark, d)
    return apply_snapshot(live, inc, SyncSpec(BY_NAME)).summary()
