"""Trees given by parent pointers: paths, subtrees, filtering, ordering; and the layout inside a page.

All questions about ancestors are answered by one fold. Each node holds a value for the stretch of
ancestors it has seen and a pointer to the first one it has not; a round joins every open node with
the node it points to and doubles the stretch. A tree of depth d takes log2(d) rounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.placement import cut, delete_path, ordinal, work_path
from tablesync.spec import FAILED, SKIPPED, PathRule

SEP, END = "\u0001", "\u0002"


def fold_up(
    nodes: DataFrame, id_col: str, parent_col: str, carry: dict[str, tuple[Column, Callable[[Column, Column], Column]]]
) -> DataFrame:
    """Fold values over each node and all its ancestors.

    ``carry``: name → (value of one node, how a lower and an upper stretch combine; associative).
    Returns ``node_id``, the folded values and ``reached_root``: false below a missing parent and
    on or below a cycle. Runs at once, a table per round in the work folder.
    """
    names = list(carry)
    spark, root = nodes.sparkSession, work_path(nodes.sparkSession, "fold")
    state = nodes.select(
        F.col(id_col).alias("node_id"),
        F.col(parent_col).alias("_up"),
        F.lit(True).alias("reached_root"),
        *[value.alias(n) for n, (value, _) in carry.items()],
    )
    schema = T.StructType([*state.schema.fields, T.StructField("round", T.IntegerType()), T.StructField("open", T.BooleanType())])

    def write(rows: DataFrame, number: int) -> DataFrame:
        """Append one round; finished nodes are written once, in the round that finishes them."""
        rows.withColumn("open", F.col("_up").isNotNull()).write.partitionBy("open").parquet(f"{root}/round={number}")
        if number:
            delete_path(spark, f"{root}/round={number - 1}/open=true")
        return spark.read.schema(schema).option("basePath", root).parquet(root)

    done = 0
    known = write(state, 0)
    most = math.ceil(math.log2(max(known.count(), 1))) + 1
    while done < most and not known.where(F.col("open")).isEmpty():
        above = known.select([F.col(c).alias(f"a_{c}") for c in state.columns])
        joined = known.where(F.col("open")).join(above, F.col("_up") == F.col("a_node_id"), "left")
        found = F.col("a_node_id").isNotNull()
        step = joined.select(
            "node_id",
            F.col("a__up").alias("_up"),
            (found & F.coalesce("a_reached_root", F.lit(False))).alias("reached_root"),
            *[F.when(found, carry[n][1](F.col(n), F.col(f"a_{n}"))).otherwise(F.col(n)).alias(n) for n in names],
        )
        done += 1
        known = write(step, done)
    # Whatever still points upwards after log2(n) doublings goes round in a circle.
    reached = (F.col("reached_root") & F.col("_up").isNull()).alias("reached_root")
    return known.select("node_id", reached, *names)


def build_paths(nodes: DataFrame, id_col: str, parent_col: str, name_col: str) -> DataFrame:
    """``/A/B/C`` and the depth of every node that hangs from a root (a NULL parent)."""
    name = F.concat(F.lit("/"), F.coalesce(F.col(name_col).cast("string"), F.lit("")))
    folded = fold_up(
        nodes,
        id_col,
        parent_col,
        {
            "path": (name, lambda low, up: F.concat(up, low)),
            "depth": (F.lit(1), lambda low, up: low + up),
        },
    )
    return folded.where("reached_root").select(F.col("node_id").alias(id_col), "path", "depth")


def subtree(nodes: DataFrame, id_col: str, parent_col: str, roots: DataFrame, root_id: str) -> DataFrame:
    """The ids of the roots and all nodes below them. Cycles do no harm."""
    marks = roots.select(F.col(root_id).alias("_root")).distinct()
    marked = nodes.select(id_col, parent_col).join(marks, F.col(id_col) == F.col("_root"), "left")
    folded = fold_up(
        marked, id_col, parent_col, {"hit": (F.col("_root").isNotNull(), lambda low, up: low | up)}
    )
    return folded.where("hit").select(F.col("node_id").alias(id_col))


def rule_tables(spark: SparkSession, rules: list[PathRule]) -> tuple[DataFrame, DataFrame]:
    """Path rules as tables: includes (rule, area, path) and excludes (rule, path)."""
    includes = [(i, r.area, r.path) for i, r in enumerate(rules)]
    excludes = [(i, x) for i, r in enumerate(rules) for x in r.excludes]
    return spark.createDataFrame(includes, "rule long, area long, path string"), spark.createDataFrame(excludes, "rule long, path string")


def _prefixes(path: Column) -> Column:
    """All paths that cover a path: itself and what stands before each of its slashes; ``/`` covers what begins with one."""
    parts = F.split(path, "/")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.concat(heads, F.when(F.startswith(path, F.lit("/")), F.array(F.lit("/"))).otherwise(F.array().cast("array<string>"))))


def covered_paths(paths: DataFrame, includes: DataFrame, excludes: DataFrame) -> DataFrame:
    """The distinct (area, path) of which some rule covers the path and none of its excludes does; paths in lower case.

    Paths unfold into what covers them, which meets the rules by equality: the plan has one size for any number of rules.
    """
    places = paths.select(F.col("area").cast("long").alias("area"), F.lower("path").alias("path")).distinct()
    unfolded = places.select("area", "path", F.explode(_prefixes(F.col("path"))).alias("prefix"))
    rules = includes.select("rule", F.col("area").cast("long").alias("area"), F.lower("path").alias("prefix")).distinct()
    hits = unfolded.join(rules, ["area", "prefix"]).select("area", "path", "rule").distinct()
    without = excludes.select("rule", F.lower("path").alias("prefix")).distinct()
    barred = hits.withColumn("prefix", F.explode(_prefixes(F.col("path")))).join(without, ["rule", "prefix"], "left_semi")
    return hits.join(barred, ["area", "path", "rule"], "left_anti").select("area", "path").distinct()


def _included(df: DataFrame, path_col: str, area_col: str, rules, how: str) -> DataFrame:
    """``df`` joined with the places that the rules include (as ``_in``)."""
    includes, excludes = rule_tables(df.sparkSession, rules) if isinstance(rules, list) else rules
    found = covered_paths(df.select(F.col(area_col).alias("area"), F.col(path_col).alias("path")), includes, excludes)
    found = found.select(F.col("area").alias("_area"), F.col("path").alias("_path"), F.lit(True).alias("_in"))
    return df.join(found, (F.col(area_col) == F.col("_area")) & (F.lower(path_col) == F.col("_path")), how)


def filter_paths(df: DataFrame, path_col: str, area_col: str, rules: list[PathRule] | tuple[DataFrame, DataFrame]) -> DataFrame:
    """Rows whose path the rules include: a list, or tables as of ``rule_tables`` for any number of them."""
    return _included(df, path_col, area_col, rules, "left_semi")


def filter_tree(
    nodes: DataFrame, id_col: str, parent_col: str, name_col: str, area_col: str, rules: list[PathRule] | tuple[DataFrame, DataFrame]
) -> DataFrame:
    """Nodes that the rules include together with every ancestor. Returns id and path."""
    paths = build_paths(nodes, id_col, parent_col, name_col).select(F.col(id_col).alias("_id"), "path")
    placed = nodes.select(id_col, parent_col, area_col).join(paths, F.col(id_col) == F.col("_id"))
    judged = _included(placed, "path", area_col, rules, "left").withColumn("_ok", F.coalesce("_in", F.lit(False)))
    judged = cut(judged.select(id_col, parent_col, "path", "_ok"))
    folded = fold_up(judged, id_col, parent_col, {"ok": (F.col("_ok"), lambda low, up: low & up)})
    kept = folded.where("ok and reached_root").select("node_id")
    return judged.join(kept, F.col(id_col) == F.col("node_id")).select(id_col, "path")


def cascade_skip(nodes: DataFrame, id_col: str, parent_col: str, failed: DataFrame, failed_id: str) -> DataFrame:
    """Outcome per node: ``failed`` itself, ``skipped`` below a failed one, else ``applied``."""
    marks = failed.select(F.col(failed_id).alias("_failed")).distinct()
    marked = nodes.select(id_col, parent_col).join(marks, F.col(id_col) == F.col("_failed"), "left")
    own = F.col("_failed").isNotNull()
    folded = fold_up(marked, id_col, parent_col, {"n_failed": (own.cast("int"), lambda low, up: low + up)})
    outcomes = folded.join(marks, F.col("node_id") == F.col("_failed"), "left")
    # A failed node below another failed one is never tried.
    outcome = (
        F.when(F.col("n_failed") == 0, "applied")
        .when(F.col("_failed").isNotNull() & (F.col("n_failed") == 1), FAILED)
        .otherwise(SKIPPED)
    )
    return outcomes.select(F.col("node_id").alias(id_col), outcome.alias("outcome"))


def _digits(number: Column) -> Column:
    """A whole number of up to 64 bits as text of one length that sorts like the number."""
    return F.lpad((number.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")


def ordered_tree(nodes: DataFrame, id_col: str, parent_col: str, sort_col: str, name_col: str) -> DataFrame:
    """Nodes in reading order: siblings by (sort, name, id). ``tree_key`` sorts the whole tree."""
    numeric = isinstance(nodes.schema[id_col].dataType, T.IntegralType)
    own = F.concat(
        _digits(F.coalesce(F.col(sort_col), F.lit(0))),
        F.lit(SEP),
        F.lower(F.coalesce(F.col(name_col).cast("string"), F.lit(""))),
        F.lit(SEP),
        _digits(F.col(id_col)) if numeric else F.col(id_col).cast("string"),
        F.lit(END),
    )
    folded = fold_up(
        nodes,
        id_col,
        parent_col,
        {
            "tree_key": (own, lambda low, up: F.concat(up, low)),
            "depth": (F.lit(1), lambda low, up: low + up),
        },
    )
    rows = folded.where("reached_root").select(F.col("node_id").alias(id_col), "depth", "tree_key")
    return rows.orderBy("tree_key")


def sorted_fields(map_col: Column) -> Column:
    """A field map with its keys in order."""
    return F.map_from_entries(F.array_sort(F.map_entries(map_col)))


def tree_counts(
    nodes: DataFrame, id_col: str, parent_col: str, roots: DataFrame, root_id: str,
    dependents: dict[str, tuple[DataFrame, str]],
) -> DataFrame:
    """How many nodes, and rows of each dependent table, lie in the trees under ``roots``."""
    inside = cut(subtree(nodes, id_col, parent_col, roots, root_id)).select(F.col(id_col).alias("_node"))
    out = inside.agg(F.count("*").alias("n")).select(F.lit("nodes").alias("kind"), "n")
    for kind, (df, key) in dependents.items():
        counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))  # one row per node meets the tree
        hits = counts.join(inside, F.col("_key") == F.col("_node"), "left_semi")
        total = hits.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
        out = out.unionByName(total.select(F.lit(kind).alias("kind"), "n"))
    return out


def renumber(rows: DataFrame, page: str, sort: str, row_id: str, out: str = "row_no") -> DataFrame:
    """Number the rows of each page 1..n by (sort, id), however many share a sort value."""
    return ordinal(rows, [page], [sort, row_id], out)


def assemble_rows(
    rows: DataFrame, paras: DataFrame, page: str, row_id: str, row_sort: str,
    para_row: str, column: str, para_sort: str, para_id: str,
) -> DataFrame:
    """The layout of pages as one flat, numbered table: page → row → column → paragraph.

    A row without paragraphs has one empty column, id 1. The table stays flat so that a page of any
    size spreads over many tasks; ``row_no`` and ``para_no`` carry the order.
    """
    numbered = renumber(rows.select(page, row_id, row_sort), page, row_sort, row_id)
    placed = ordinal(
        paras.select(F.col(para_row).alias("_row"), F.col(column).alias("_col"), F.col(para_sort).alias("_sort"),
                     F.col(para_id).alias("para_id")),
        ["_row", "_col"], ["_sort", "para_id"], "para_no",
    )
    # The paragraphs are the probing side of the join: a row that holds very many may be split there.
    filled = placed.join(numbered, F.col("_row") == F.col(row_id))
    empty = numbered.join(placed.select("_row").distinct(), F.col(row_id) == F.col("_row"), "left_anti")
    out = [page, row_id, "row_no", F.coalesce("_col", F.lit(1)).alias("column_id"), "para_no", "para_id"]
    return filled.select(*out).unionByName(
        empty.select(
            page, row_id, "row_no", F.lit(1).alias("column_id"), F.lit(None).cast("long").alias("para_no"),
            F.lit(None).cast(paras.schema[para_id].dataType).alias("para_id"),
        )
    )


def flatten_tree(nested: DataFrame, keys: list[str], rows_col: str = "rows") -> DataFrame:
    """Every paragraph of nested documents (rows → columns → paragraphs), one row each."""
    rows = nested.select(*keys, F.inline(rows_col))
    columns = rows.select(*[c for c in rows.columns if c != "columns"], F.inline("columns"))
    return columns.select(*[c for c in columns.columns if c != "paragraphs"], F.inline("paragraphs"))


def assign_columns(paras: DataFrame, columns: DataFrame, row: str, column: str) -> DataFrame:
    """Put each paragraph into its column; a missing or unknown column means the row's first one.

    ``columns(row, column, ord)`` lists the columns of each row. Rows without columns hold nothing.
    """
    first = columns.groupBy(F.col(row).alias("_row")).agg(F.min_by(column, F.struct("ord", column)).alias("_first"))
    known = columns.select(F.col(row).alias("_at"), F.col(column).alias("_known")).distinct()
    # NULL columns skip the lookup; they would all meet in one partition.
    named = paras.where(F.col(column).isNotNull())
    named = named.join(known, (F.col(row) == F.col("_at")) & (F.col(column) == F.col("_known")), "left").drop("_at")
    unnamed = paras.where(F.col(column).isNull()).withColumn("_known", F.lit(None).cast(columns.schema[column].dataType))
    both = named.unionByName(unnamed).join(first, F.col(row) == F.col("_row"))
    out = [F.coalesce("_known", "_first").alias(column) if c == column else F.col(c) for c in paras.columns]
    return both.select(*out)
