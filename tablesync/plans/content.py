"""Content: areas, pages in a tree, grid rows, paragraphs and permissions as five tables.

    areas        area_id, properties …
    pages        page_id, guid, parent_id (NULL: root), area_id, menu_text, sort, … fields, property_fields
    rows         row_id, guid, page_id, sort, … fields
    paragraphs   para_id, guid, page_id, row_id, column_id, sort, … fields
    permissions  page_id, owner_id, level_value

Any further columns travel along. Ids are local to one environment; GUIDs are not. All levels of the
tree are handled at once: ids are allocated before anything is written, so no level waits for another.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.text import listed
from tablesync.operators import permissions as perms
from tablesync.operators.identity import allocate_ids
from tablesync.operators.merge import diff_rows, last_incoming, merge_rows, would_fill
from tablesync.operators.placement import cut
from tablesync.operators.quality import asset_refs
from tablesync.operators.refs import link_sweep, rewrite_links, split_acknowledged
from tablesync.operators.selection import compact_fields, exclude_columns, exclude_fields_by_type
from tablesync.operators.tree import cascade_skip, filter_tree, renumber
from tablesync.operators.xmlcols import canonical_xml, drop_xml_elements_by_type
from tablesync.spec import DESTINATION_WINS, FAILED, SKIPPED, SOURCE_WINS, PathRule, TableSpec

MAP = T.MapType(T.StringType(), T.StringType())


@dataclass(frozen=True)
class Content:
    pages: DataFrame
    rows: DataFrame
    paragraphs: DataFrame
    permissions: DataFrame | None = None
    areas: DataFrame | None = None


@dataclass(frozen=True)
class ContentSpec:
    """Which content a snapshot takes and what it leaves out.

    ``exclude_fields`` for all types, ``fields_by_type`` per item type; ``xml_cols`` maps an XML column
    to the column that names its type; ``drop_elements`` and ``elements_by_type`` thin such XML out. ``exclude_area_cols`` are columns that areas do not bring along.
    """

    rules: tuple[PathRule, ...]
    exclude_fields: tuple[str, ...] = ()
    fields_by_type: dict | None = None
    xml_cols: dict | None = None
    drop_elements: tuple[str, ...] = ()
    elements_by_type: dict | None = None
    exclude_area_cols: tuple[str, ...] = ()


def _maps(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType == MAP]


def _thinned(df: DataFrame, spec: ContentSpec) -> DataFrame:
    for col in _maps(df):
        if "item_type" in df.columns:
            df = exclude_fields_by_type(df, col, "item_type", spec.exclude_fields, spec.fields_by_type)
        df = compact_fields(df, col)
    for col, type_col in (spec.xml_cols or {}).items():
        if col in df.columns:
            df = canonical_xml(df, [col])
            if spec.drop_elements or spec.elements_by_type:
                df = drop_xml_elements_by_type(df, [col], type_col, list(spec.drop_elements), spec.elements_by_type or {})
    return df


def snapshot_content(content: Content, spec: ContentSpec, groups: DataFrame | None = None) -> Content:
    """The selected pages, with their path, and everything on them.

    A page is in only if all its ancestors are. Grid rows are renumbered 1..n per page.
    """
    kept = filter_tree(content.pages, "page_id", "parent_id", "menu_text", "area_id", list(spec.rules))
    inside = kept.select(F.col("page_id").alias("_page"))
    pages = content.pages.join(kept.withColumnRenamed("page_id", "_page"), F.col("page_id") == F.col("_page")).drop("_page")

    def on_them(df: DataFrame) -> DataFrame:
        return df.join(inside, F.col("page_id") == F.col("_page"), "left_semi")

    rows = renumber(on_them(content.rows), "page_id", "sort", "row_id", "_n")
    rows = rows.withColumn("sort", F.col("_n").cast(content.rows.schema["sort"].dataType)).drop("_n")
    rules = None
    if content.permissions is not None:
        rules = perms.export_permissions(on_them(content.permissions), groups)
    areas = content.areas
    if areas is not None:
        used = pages.select(F.col("area_id").alias("_area")).distinct()
        areas = exclude_columns(areas.join(used, F.col("area_id") == F.col("_area"), "left_semi"), spec.exclude_area_cols)
    return Content(_thinned(pages, spec), _thinned(rows, spec), _thinned(on_them(content.paragraphs), spec), rules, areas)


def content_texts(content: Content, page_cols=("shortcut", "product_page")) -> DataFrame:
    """Every text that may hold a reference: (kind, owner_id, field, value)."""
    parts = []
    for kind, df, key in (("page", content.pages, "page_id"), ("paragraph", content.paragraphs, "para_id")):
        owner = F.col(key).cast("long").alias("owner_id")
        for col in page_cols if kind == "page" else ():
            if col in df.columns:
                parts.append(df.select(F.lit(kind).alias("kind"), owner, F.lit(col).alias("field"), F.col(col).alias("value")))
        for col in _maps(df):
            entries = df.select(F.lit(kind).alias("kind"), owner, F.explode(col).alias("_k", "value"))
            parts.append(entries.select("kind", "owner_id", F.concat(F.lit(col + "."), "_k").alias("field"), "value"))
    return reduce(DataFrame.unionByName, parts).where("value is not null")


def sweep_content(content: Content, acknowledged=()) -> tuple[DataFrame, DataFrame]:
    """References in a snapshot to pages and paragraphs that it does not hold, acknowledged or fatal."""
    texts = content_texts(content).withColumnRenamed("kind", "owner_kind")
    unresolved, resolved = link_sweep(
        texts, ["owner_kind", "owner_id", "field"], ["value"], content.pages, "page_id", content.paragraphs, "para_id"
    )
    return split_acknowledged(unresolved.drop("col"), acknowledged), resolved


def content_assets(content: Content) -> DataFrame:
    """Layouts, row definitions and item types that the content needs, with the pages that use them."""
    pages = content.pages
    named = [F.when(F.col(c) != "", F.col(c)) for c in ("url_name", "menu_text") if c in pages.columns]
    user = F.coalesce(*named, F.col("guid"))
    users = pages.select(F.col("page_id").alias("_page"), user.alias("_user"))
    parts = []
    for df, kinds in (
        (pages, {"layout": "page-layout", "item_type": "item-type"}),
        (content.rows, {"definition_id": "grid-row", "item_type": "item-type"}),
        (content.paragraphs, {"item_type": "item-type"}),
    ):
        for col, kind in kinds.items():
            if col in df.columns:
                # A page that repeats an asset in many rows meets the page names once.
                used = df.where(F.col(col) != "").select("page_id", F.col(col).alias("_path")).distinct()
                parts.append((used.join(users, F.col("page_id") == F.col("_page")), kind, "_path", "_user"))
    return asset_refs(parts)


def assign_ids(target: DataFrame, incoming: DataFrame, id_col: str, guid_col: str, scope_col: str):
    """Incoming rows under the target's ids, and the id map (source_id, target_id, is_new).

    A row known by GUID in its scope takes the known id, a new row one above the highest.
    """
    scoped = F.concat_ws("|", F.col(scope_col).cast("string"), F.lower(guid_col))
    known = target.select(F.col(id_col).alias("id"), scoped.alias("_scoped"))
    # Rows and map are both used more than once; the new ids are fixed here.
    numbered = cut(allocate_ids(incoming.withColumn("_scoped", scoped), known, "_scoped", "id").drop("_scoped"))
    id_map = numbered.select(F.col(id_col).alias("source_id"), "target_id", "is_new")
    rows = numbered.withColumn(id_col, F.col("target_id").cast(target.schema[id_col].dataType))
    return rows.select(*incoming.columns), id_map


def merge_by_guid(
    target: DataFrame, rows: DataFrame, guid_col: str, scope_col: str, parent_col: str | None = None,
    strategy: str = SOURCE_WINS, keep_fields: tuple[str, ...] = (),
) -> DataFrame:
    """Merge rows that already carry the target's ids; adds ``outcome``.

    The place in the tree is the source's to decide, even where cells are only filled.
    """
    # The id is written like any other value: it is no auto-number here, it was assigned before.
    spec = TableSpec("", (scope_col, guid_col), keep_fields=keep_fields)
    always = (parent_col,) if parent_col else ()
    return merge_rows(target, rows, spec, strategy, always=always).select(*target.columns, "outcome")


def apply_by_guid(
    target: DataFrame, incoming: DataFrame, id_col: str, guid_col: str, scope_col: str,
    parent_col: str | None = None, parent_map: DataFrame | None = None, strategy: str = SOURCE_WINS, **options,
) -> tuple[DataFrame, DataFrame]:
    """Upsert rows found by GUID inside their scope (an area, a page). Returns (table, id map).

    ``parent_col`` holds source ids: they become target ids through this table's own map, or through
    ``parent_map`` when the parents are another table.
    """
    rows, id_map = assign_ids(target, incoming, id_col, guid_col, scope_col)
    if parent_col:
        rows = through_map(rows, parent_col, parent_map if parent_map is not None else id_map)
    return merge_by_guid(target, rows, guid_col, scope_col, parent_col, strategy, **options), id_map


def through_map(df: DataFrame, col: str, id_map: DataFrame) -> DataFrame:
    """Replace source ids in a column by target ids; ids outside the map become NULL."""
    lookup = id_map.select(F.col("source_id").alias("_from"), F.col("target_id").alias("_to"))
    # NULL ids skip the lookup; they would all meet in one partition.
    found = df.where(F.col(col).isNotNull()).join(lookup, F.col(col) == F.col("_from"), "left").drop("_from")
    none = df.where(F.col(col).isNull()).withColumn("_to", F.lit(None).cast(id_map.schema["target_id"].dataType))
    kind = df.schema[col].dataType
    out = [F.col("_to").cast(kind).alias(c) if c == col else F.col(c) for c in df.columns]
    return found.unionByName(none).select(*out)


@dataclass(frozen=True)
class AppliedContent:
    """The merged tables, each with ``outcome``, the id maps and the warnings of an apply.

    ``failed`` (table_name, source_id, outcome, warning) has the rows that were not applied: failed ones, and those skipped
    because what they stand on failed.
    """

    content: Content
    page_map: DataFrame
    para_map: DataFrame
    warnings: DataFrame | None
    failed: DataFrame


def _judged_pages(pages: DataFrame) -> DataFrame:
    """(page_id, outcome, warning) of every page with an id: failed without a GUID or with an unknown parent, skipped below."""
    known = pages.select(F.col("page_id").alias("_known")).where("_known is not null").distinct()
    nodes = pages.where("page_id is not null").select("page_id", "parent_id", "guid")
    nodes = nodes.join(known, F.col("parent_id") == F.col("_known"), "left")
    reason = F.when(F.col("guid").isNull(), "no GUID").when(
        F.col("parent_id").isNotNull() & F.col("_known").isNull(), F.concat(F.lit("unknown parent "), F.col("parent_id").cast("string"))
    )
    nodes = cut(nodes.select("page_id", F.when(F.col("_known").isNotNull(), F.col("parent_id")).alias("parent_id"), reason.alias("warning")))
    bad = nodes.where("warning is not null").select("page_id", "warning")
    outcomes = cascade_skip(nodes, "page_id", "parent_id", bad, "page_id")
    why = bad.select(F.col("page_id").alias("_bad"), "warning").dropDuplicates(["_bad"])
    return outcomes.join(why, F.col("page_id") == F.col("_bad"), "left").select("page_id", "outcome", "warning")


def _on_applied_pages(df: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``_outcome`` and ``_warning`` to rows of pages: failed on an unknown page or without a GUID, skipped on one not applied."""
    state = pages.select(F.col("page_id").alias("_page"), F.col("outcome").alias("_state"))
    # Rows without a page skip the lookup; they would all meet in one partition.
    placed = df.where("page_id is not null").join(state, F.col("page_id") == F.col("_page"), "left").drop("_page")
    placed = placed.unionByName(df.where("page_id is null").withColumn("_state", F.lit(None).cast("string")))
    nowhere = F.concat(F.lit("unknown page "), F.coalesce(F.col("page_id").cast("string"), F.lit("NULL")))
    warning = F.when(F.col("_state").isNull(), nowhere).when(F.col("guid").isNull(), "no GUID")
    outcome = F.when(warning.isNotNull(), FAILED).when(F.col("_state") != "applied", SKIPPED)
    return placed.withColumns({"_outcome": outcome, "_warning": warning}).drop("_state")


def apply_content(
    target: Content, snapshot: Content, strategy: str = SOURCE_WINS, groups: DataFrame | None = None,
    keep_fields: tuple[str, ...] = (), link_cols: tuple[str, ...] = ("shortcut", "product_page", "module_settings"),
) -> AppliedContent:
    """Apply a content snapshot to the content of another environment.

    Pages are found by GUID per area, grid rows and paragraphs by GUID per page, areas by their id. References inside
    texts are rewritten to the target's ids before the merge. Destination-wins reaches areas and pages only:
    known rows and paragraphs take the source's values under either strategy. A page without a GUID or with a parent that
    the snapshot does not hold fails, what lies below it is skipped; so are rows and paragraphs of such pages,
    and those of unknown pages fail. Ids, outcomes and mentioned ids are written at once, to the work folder.
    """
    judged = cut(_judged_pages(snapshot.pages))
    fit = judged.where("outcome = 'applied'").select(F.col("page_id").alias("_fit"))
    pages = snapshot.pages.select([c for c in snapshot.pages.columns if listed(target.pages.columns, c)])
    pages = pages.join(fit, F.col("page_id") == F.col("_fit"), "left_semi")
    pages, page_map = assign_ids(target.pages, pages, "page_id", "guid", "area_id")
    pages = through_map(pages, "parent_id", page_map)
    rows, lost_rows = _fitting(snapshot.rows, target.rows, judged, page_map)
    rows, row_map = assign_ids(target.rows, rows, "row_id", "guid", "page_id")
    paras, lost_paras = _fitting(snapshot.paragraphs, target.paragraphs, judged, page_map)
    paras, para_map = assign_ids(target.paragraphs, paras, "para_id", "guid", "page_id")
    paras = through_map(paras, "row_id", row_map)

    pages = _relinked(pages, "page_id", link_cols, page_map, para_map)
    paras = _relinked(paras, "para_id", link_cols, page_map, para_map)
    areas = target.areas
    if areas is not None and snapshot.areas is not None:
        areas = merge_rows(areas, snapshot.areas, TableSpec("areas", ("area_id",)), strategy).select(*areas.columns, "outcome")
    merged = Content(
        merge_by_guid(target.pages, pages, "guid", "area_id", "parent_id", strategy, keep_fields),
        merge_by_guid(target.rows, rows, "guid", "page_id", keep_fields=keep_fields),
        merge_by_guid(target.paragraphs, paras, "guid", "page_id", keep_fields=keep_fields),
        areas=areas,
    )
    lost_pages = judged.where("outcome <> 'applied'").select(F.col("page_id").alias("_id"), F.col("outcome").alias("_outcome"), F.col("warning").alias("_warning"))
    failed = [
        df.select(F.lit(n).alias("table_name"), F.col(c).cast("long").alias("source_id"), F.col("_outcome").alias("outcome"), F.col("_warning").alias("warning"))
        for n, df, c in (("pages", lost_pages, "_id"), ("rows", lost_rows, "row_id"), ("paragraphs", lost_paras, "para_id"))
    ]
    rules, warnings = _applied_permissions(target, snapshot, page_map, strategy, groups)
    return AppliedContent(replace(merged, permissions=rules), page_map, para_map, warnings, reduce(DataFrame.unionByName, failed))


def _fitting(df: DataFrame, target: DataFrame, judged: DataFrame, page_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that can be applied, with the columns the target has, on the target's pages; and the others."""
    placed = cut(_on_applied_pages(df, judged))
    fit = placed.where("_outcome is null").select([c for c in df.columns if listed(target.columns, c)])
    return through_map(fit, "page_id", page_map), placed.where("_outcome is not null")


def _relinked(df: DataFrame, key: str, link_cols, page_map: DataFrame, para_map: DataFrame) -> DataFrame:
    cols = [c for c in link_cols if c in df.columns]
    return rewrite_links(df, [key], cols, page_map, para_map, _maps(df)) if cols or _maps(df) else df


def _applied_permissions(target: Content, snapshot: Content, page_map: DataFrame, strategy: str, groups):
    """Rules of the target after the apply: written pages take the snapshot's, the others keep theirs."""
    if snapshot.permissions is None or target.permissions is None:
        return target.permissions, None
    written = page_map if strategy != DESTINATION_WINS else page_map.where("is_new")
    moved = snapshot.permissions.join(
        written.select(F.col("source_id").alias("_from"), F.col("target_id").alias("_to")), F.col("page_id") == F.col("_from")
    )
    moved = moved.withColumn("page_id", F.col("_to")).withColumn("_at", F.lower("owner"))
    rules, warnings = perms.import_permissions(moved.drop("_from", "_to"), groups, "_at")
    rules = rules.withColumnRenamed("owner", "owner_id").select(
        *[F.col(c).cast(target.permissions.schema[c].dataType).alias(c) for c in ("page_id", "owner_id", "level_value")]
    )
    touched = rules.select(F.col("page_id").alias("_page")).distinct()
    kept = target.permissions.join(touched, F.col("page_id") == F.col("_page"), "left_anti")
    return kept.select("page_id", "owner_id", "level_value").unionByName(rules), warnings


def content_outcomes(applied: AppliedContent) -> DataFrame:
    """(table_name, outcome) of every applied row, for ``run_summary``."""
    parts = {"pages": applied.content.pages, "rows": applied.content.rows, "paragraphs": applied.content.paragraphs}
    if applied.content.areas is not None and "outcome" in applied.content.areas.columns:
        parts["areas"] = applied.content.areas
    out = [df.where("outcome <> 'kept'").select(F.lit(n).alias("table_name"), "outcome") for n, df in parts.items()]
    return reduce(DataFrame.unionByName, [*out, applied.failed.select("table_name", "outcome")])


def content_diffs(target: Content, snapshot: Content, strategy: str = SOURCE_WINS) -> DataFrame:
    """Dry run of the pages: (area_id, guid, col, old_value, new_value) of cells and fields that an apply would change.

    Ids are local to an environment and left out. Under destination-wins only unset cells count.
    """
    local = ("page_id", "parent_id")
    spec = TableSpec("pages", ("area_id", "guid"), auto_cols=local)
    own = target.pages.drop(*local)
    seeds = snapshot.pages.select([c for c in snapshot.pages.columns if listed(own.columns, c)])
    if strategy != DESTINATION_WINS:
        return diff_rows(own, last_incoming(seeds, spec), spec)
    fills = would_fill(own, seeds, spec)
    return fills.select("area_id", "guid", "col", F.lit(None).cast("string").alias("old_value"), F.col("seed").alias("new_value"))


