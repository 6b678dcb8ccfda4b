"""References inside text: extraction, rewriting through id maps, sweeps and clean-up."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import links
from tablesync.functions.text import any_of, like_any, string_columns
from tablesync.operators.placement import cut
from tablesync.spec import check_columns

NO_ANCHOR = -1


def _hits(name: str) -> Column:
    """All references of one cell: (col, kind, target_id, anchor_id, ref)."""
    col = F.col(f"`{name}`")
    none = F.lit(None).cast("int")
    found = F.concat(
        F.transform(links.links_in(col), lambda m: _hit(name, "link", links.page_of(m), links.anchor_of(m), m)),
        F.transform(links.selections_in(col), lambda m: _hit(name, "selected", links.id_of(m), none, m)),
    )
    return F.coalesce(found, F.array().cast(f"array<{HIT}>"))


HIT = "struct<col:string,kind:string,target_id:int,anchor_id:int,ref:string>"


def _hit(name, kind, target, anchor, ref) -> Column:
    return F.struct(
        F.lit(name).alias("col"),
        F.lit(kind).alias("kind"),
        target.alias("target_id"),
        anchor.alias("anchor_id"),
        ref.alias("ref"),
    ).cast(HIT)


def extract_links(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row per page link or JSON selection in the listed columns. No shuffle."""
    check_columns(df, cols, "link columns")
    hits = reduce(lambda a, b: F.concat(a, b), [_hits(c) for c in cols])
    return df.select(*keys, F.inline(hits))


def _needed_ids(texts: Column) -> Column:
    """Distinct (kind, id) that a row's texts may look up, whole-number texts included."""

    def entry(kind: str, number: Column) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), number.alias("_id"))

    def one(text: Column) -> Column:
        of_links = F.transform(
            links.links_in(text), lambda m: F.array(entry("page", links.page_of(m)), entry("para", links.anchor_of(m)))
        )
        of_selections = F.transform(links.selections_in(text), lambda m: entry("page", links.id_of(m)))
        return F.concat(F.array(entry("page", links.whole_number(text))), F.flatten(of_links), of_selections)

    found = F.array_distinct(F.flatten(F.transform(texts, one)))
    return F.filter(found, lambda e: e["_id"].isNotNull())


def _row_maps(df: DataFrame, keys: list[str], texts: Column, page_map: DataFrame, para_map: DataFrame | None) -> DataFrame:
    """The part of the id maps that each row needs, for rows that mention a mapped page.

    Only distinct (row, id) pairs are written and travel to the id maps. How often a page is mentioned shows
    in nothing but the number of its small pairs, which an adaptive join may split at will.
    """
    pairs = cut(df.select(*keys, F.inline(_needed_ids(F.array_compact(texts)))))

    def known(kind: str, id_map: DataFrame) -> DataFrame:
        source, target = F.col("source_id").cast("int").alias("_id"), F.col("target_id").cast("int").alias("_target")
        return id_map.select(F.lit(kind).alias("_kind"), source, target)

    def part(kind: str) -> Column:
        entry = F.when(F.col("_kind") == kind, F.struct("_id", "_target"))
        return F.map_from_entries(F.collect_list(entry))  # bounded by the ids one row mentions

    id_maps = known("page", page_map)
    if para_map is not None:
        id_maps = id_maps.unionByName(known("para", para_map))
    return (
        pairs.join(id_maps, ["_kind", "_id"])
        .groupBy(*keys)
        .agg(part("page").alias("_page_map"), part("para").alias("_para_map"))
        .where(F.size("_page_map") > 0)  # without a mapped page nothing of the row changes
    )


def _rewritten(text: Column) -> Column:
    """Texts of rows without a mapped page id stay untouched."""
    new = links.rewrite_text(text, F.col("_page_map"), F.col("_para_map"))
    return F.when(F.col("_page_map").isNotNull(), new).otherwise(text)


def rewrite_links(
    df: DataFrame, keys: list[str], cols: list[str], page_map: DataFrame, para_map: DataFrame | None = None,
    map_cols: list[str] = (), only_changed: bool = False,
) -> DataFrame:
    """Rewrite page and paragraph ids inside the listed text columns and field maps.

    Unmapped references stay. ``keys`` identify a row; each map has one ``target_id`` per ``source_id``, and no
    ``para_map`` is an empty one. ``only_changed`` returns just the rows that a reference changed in. The mentioned ids
    are extracted and written at once; the texts are then scanned once, beside the map of their row.
    """
    check_columns(df, [*cols, *map_cols], "link columns")
    none = F.array().cast("array<string>")
    held = [F.coalesce(F.map_values(m), none) for m in map_cols]
    texts = F.concat(F.array(*[F.col(f"`{c}`") for c in cols]) if cols else none, *held)
    maps = _row_maps(df, keys, texts, page_map, para_map)
    new = {c: _rewritten(F.col(f"`{c}`")) for c in cols}
    new |= {m: F.transform_values(m, lambda _, v: _rewritten(v)) for m in map_cols}
    if not only_changed:
        out = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
        return df.join(maps, keys, "left").select(*out)
    linked = df.join(maps, keys).withColumns({f"_new_{c}": v for c, v in new.items()})
    changed = [~F.col(f"`_new_{c}`").eqNullSafe(F.col(f"`{c}`")) for c in cols]
    changed += [~F.map_values(f"_new_{m}").eqNullSafe(F.map_values(m)) for m in map_cols]
    out = [F.col(f"`_new_{c}`").alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    return linked.where(any_of(changed)).select(*out)


def rewrite_links_in_fields(
    df: DataFrame, keys: list[str], map_col: str, page_map: DataFrame, para_map: DataFrame | None = None, only_changed: bool = True
) -> DataFrame:
    """The same over every value of a field map; by default only rows that changed are returned."""
    return rewrite_links(df, keys, [], page_map, para_map, [map_col], only_changed)


def _known_ids(df: DataFrame, col: str, flag: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(F.col(col).cast("int").alias("_id")).distinct().withColumn(
        flag, F.lit(True)
    )


def _judged(tokens: DataFrame, pages: DataFrame, paras: DataFrame) -> DataFrame:
    """Add ``page_known`` and ``para_known`` to distinct (kind, target_id, anchor_id) tokens.

    ``para_known`` speaks of the anchor of a link and of the id of a selection.
    """
    para_id = F.when(F.col("kind") == "link", F.col("anchor_id")).otherwise(F.col("target_id"))
    p = pages.withColumnRenamed("_id", "_page")
    a = paras.withColumnRenamed("_id", "_para")
    return (
        tokens.withColumn("_para_id", para_id)
        .join(p, F.col("target_id") == F.col("_page"), "left")
        .join(a, F.col("_para_id") == F.col("_para"), "left")
        .select(
            *tokens.columns,
            F.coalesce("page_known", F.lit(False)).alias("page_known"),
            F.coalesce("para_known", F.lit(False)).alias("para_known"),
        )
    )


def link_sweep(
    df: DataFrame, keys: list[str], cols: list[str], pages: DataFrame, page_id: str, paras: DataFrame, para_id: str
):
    """References whose page, or anchor paragraph, is not in the snapshot. Returns (unresolved, resolved).

    ``unresolved`` has one row per reference and the id that is missing; ``resolved`` is one count.
    The references are extracted once and written, at once. They are counted per distinct target before they meet the
    ids, so a page linked from everywhere is one row there; only the targets found missing are looked up again.
    """
    refs = cut(link_postings(df, keys, cols).withColumn("n", F.lit(1).cast("long")))
    unresolved, resolved = sweep_postings(refs, pages, page_id, paras, para_id)
    return unresolved.select(*keys, "col", "kind", "missing_id", "ref"), resolved


def link_postings(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """The references of rows to a target: keys, col, kind, target_id, anchor_id (``NO_ANCHOR`` without one), ref."""
    refs = extract_links(df, keys, cols).where("target_id is not null")
    return refs.withColumn("anchor_id", F.coalesce("anchor_id", F.lit(NO_ANCHOR)))


def sweep_postings(refs: DataFrame, pages: DataFrame, page_id: str, paras: DataFrame, para_id: str) -> tuple[DataFrame, DataFrame]:
    """The sweep over extracted references, each of which occurs ``n`` times: (unresolved, resolved)."""
    token = ["kind", "target_id", "anchor_id"]
    counts = refs.groupBy(*token).agg(F.sum("n").alias("n"))
    judged = _judged(counts, _known_ids(pages, page_id, "page_known"), _known_ids(paras, para_id, "para_known"))
    link = F.col("kind") == "link"
    has_anchor = F.col("anchor_id") != NO_ANCHOR
    fine = F.when(link, F.col("page_known") & (~has_anchor | F.col("para_known"))).otherwise(
        F.col("page_known") | F.col("para_known")
    )
    missing = F.when(link & F.col("page_known"), F.col("anchor_id")).otherwise(F.col("target_id"))
    judged = judged.withColumn("_fine", fine)
    broken = judged.where(~F.col("_fine")).select(*token, missing.alias("missing_id"))
    found = refs.join(broken, token).drop("target_id", "anchor_id")
    unresolved = found.withColumn("n", F.explode(F.array_repeat("n", F.col("n").cast("int")))).drop("n")
    resolved = judged.agg(F.coalesce(F.sum(F.when(F.col("_fine"), F.col("n"))), F.lit(0)).alias("resolved"))
    return unresolved, resolved


def split_acknowledged(unresolved: DataFrame, acknowledged) -> DataFrame:
    """Mark references to ids that are known to be broken as warnings, all others as fatal.

    ``acknowledged`` is a short list of ids or a frame with an ``id`` column.
    """
    if isinstance(acknowledged, DataFrame):
        known = acknowledged.select(F.col("id").cast("int").alias("_ack")).distinct()
        rows = unresolved.join(known, F.col("missing_id") == F.col("_ack"), "left")
        is_known = F.col("_ack").isNotNull()
    else:
        rows, is_known = unresolved, F.col("missing_id").isin([int(i) for i in acknowledged])
    return rows.select(*unresolved.columns, F.when(is_known, "warning").otherwise("fatal").alias("severity"))


def link_stats(df: DataFrame, cols: list[str], page_map: DataFrame, para_map: DataFrame) -> DataFrame:
    """What a rewrite resolves: pages and anchors, mapped and not. Selections are not counted."""
    texts = F.array_compact(F.array(*[F.col(f"`{c}`") for c in cols]))
    numbers = F.array_compact(F.transform(texts, links.whole_number))
    refs = extract_links(df, [], cols).where("kind = 'link' and target_id is not null")
    tokens = (
        refs.select("kind", "target_id", F.coalesce("anchor_id", F.lit(NO_ANCHOR)).alias("anchor_id"))
        .unionByName(
            df.select(
                F.lit("number").alias("kind"), F.explode(numbers).alias("target_id"), F.lit(NO_ANCHOR).alias("anchor_id")
            )
        )
        .groupBy("kind", "target_id", "anchor_id")
        .agg(F.count("*").alias("n"))
    )
    judged = _judged(
        tokens, _known_ids(page_map, "source_id", "page_known"), _known_ids(para_map, "source_id", "para_known")
    )
    link, page, para = F.col("kind") == "link", F.col("page_known"), F.col("para_known")
    anchored = link & page & (F.col("anchor_id") != NO_ANCHOR)

    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    return judged.agg(
        total(page, "resolved"),
        total(link & ~page, "unresolved"),
        total(anchored & para, "paragraph_resolved"),
        total(anchored & ~para, "paragraph_unresolved"),
    )


def clear_orphan_refs(df: DataFrame, keys: list[str], ids: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove every mention of the page ids in ``ids`` (id), in all columns that are neither ``keys`` nor in ``keep``.

    Links to them are cut out of texts, texts that are just such an id become '', integers NULL. ``keys``
    identify a row. Each row's mentions are extracted and written at once; only those (row, id) pairs meet the ids.
    """
    kept = {k.lower() for k in (*keep, *keys)}
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    fields = [f for f in df.schema.fields if f.name.lower() not in kept]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in fields if isinstance(f.dataType, kinds) and f.nullable]
    if not texts and not numbers:
        return df
    held = [F.col(f"`{c}`").cast("long") for c in numbers]
    for c in texts:
        col = F.col(f"`{c}`")
        held.append(links.whole_number(col).cast("long"))
    found = F.array(*held)
    for c in texts:
        pages = F.transform(links.page_links(F.col(f"`{c}`")), lambda m: links.page_link_id(m).cast("long"))
        found = F.concat(found, F.coalesce(pages, F.array().cast("array<bigint>")))
    pairs = cut(df.select(*keys, F.explode(F.array_distinct(F.array_compact(found))).alias("_id")))
    gone = ids.select(F.col("id").cast("long").alias("_id")).distinct()
    marked = pairs.join(gone, "_id", "left_semi").groupBy(*keys).agg(F.collect_set("_id").alias("_gone"))  # ids of one row
    rows = df.join(marked, keys, "left")
    hit = lambda number: F.coalesce(F.array_contains("_gone", number.cast("long")), F.lit(False))
    out = {}
    for c in texts:
        col = F.col(f"`{c}`")
        cleared = F.when(hit(links.whole_number(col)), "").otherwise(links.without_pages(col, F.col("_gone")))
        out[c] = F.when(F.col("_gone").isNull(), col).otherwise(cleared)
    for c in numbers:
        out[c] = F.when(~hit(F.col(f"`{c}`")), F.col(f"`{c}`"))
    return rows.withColumns(out).select(*[f"`{c}`" for c in df.columns])


def clear_stale_values(df: DataFrame, fragments: list[str], not_null: tuple[str, ...] = (), keep: tuple[str, ...] = ()):
    """Blank every text cell that mentions one of the fragments: '' in NOT NULL columns, else NULL."""
    strict, kept = {c.lower() for c in not_null}, {k.lower() for k in keep}
    out = {}
    for name in string_columns(df):
        if name.lower() not in kept:
            col = F.col(f"`{name}`")
            blank = F.lit("") if name.lower() in strict else F.lit(None).cast("string")
            out[name] = F.when(like_any(col, fragments), blank).otherwise(col)
    return df.withColumns(out)


def value_census(tables: dict[str, DataFrame], patterns: dict[str, str]) -> DataFrame:
    """Cells that match a pattern, counted per table, column and pattern; one pass per table."""
    union = None
    for table, df in tables.items():
        names = string_columns(df)
        slots = [(c, p) for c in names for p in patterns]
        counts = df.agg(
            *[F.count_if(F.col(f"`{c}`").rlike(patterns[p])).alias(f"n{i}") for i, (c, p) in enumerate(slots)]
        )
        rows = F.array(
            *[
                F.struct(F.lit(c).alias("col"), F.lit(p).alias("pattern"), F.col(f"n{i}").alias("n"))
                for i, (c, p) in enumerate(slots)
            ]
        )
        part = counts.select(F.lit(table).alias("table_name"), F.inline(rows)).where("n > 0")
        union = part if union is None else union.unionByName(part)
    return union


def contains_any(fragments) -> str:
    """A census pattern for literal fragments."""
    return "|".join(re.escape(f) for f in fragments)
