"""The whole apply of a table snapshot."""

from __future__ import annotations

import copy
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.text import actual_name, any_of, listed
from tablesync.operators.merge import merge_once, replace_all
from tablesync.operators.placement import cut
from tablesync.operators.quality import assert_no_warnings, run_summary
from tablesync.operators.refs import rewrite_links
from tablesync.operators.schema import align_to_schema, coerce, fill_not_null
from tablesync.plans.content import AppliedContent
from tablesync.spec import CREATED, FAILED, SOURCE_WINS, SyncSpec


@dataclass(frozen=True)
class ApplyResult:
    """Everything an apply yields. The merge has run, into the work folder; the target is untouched.

    ``table``     the merged table
    ``outcomes``  (table_name, outcome), one row per incoming row
    ``rejects``   cells that did not parse; ``failed`` rows that cannot be written
    ``warnings``  one row per column dropped for schema drift
    """

    table: DataFrame
    outcomes: DataFrame
    rejects: DataFrame
    failed: DataFrame
    warnings: DataFrame

    def summary(self) -> DataFrame:
        return run_summary(self.outcomes)


def prepare_incoming(incoming: DataFrame, target: DataFrame, spec: SyncSpec, page_map=None, para_map=None, order=None):
    """Incoming rows fitted to the target: known columns, types, defaults, links; ``order`` becomes ``_order``."""
    table = spec.table
    schema = copy.deepcopy(target.schema)  # the frame keeps its own
    for field in schema.fields:
        if listed(table.not_null, field.name) or listed(table.keys, field.name):
            field.nullable = False
    place = [F.col(order).alias("_order")] if order else []
    aligned, warnings = align_to_schema(incoming.drop(order) if order else incoming, schema, table.table)
    if order:
        aligned = incoming.select(*[F.col(f"`{actual_name(incoming, c)}`").alias(c) for c in aligned.columns], *place)
    keys = [c for c in aligned.columns if listed(table.keys, c)]
    rows, rejects = coerce(aligned, schema, keys)
    rows = fill_not_null(rows, schema)
    linked = [c for c in rows.columns if listed(spec.link_cols, c)]
    if linked and page_map is not None:
        # Keys may repeat or be missing, so rows go by a number, which is fixed by writing them.
        rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()))
        rows = rewrite_links(rows, ["_row"], linked, page_map, para_map).drop("_row")
    return rows, rejects, warnings


def apply_snapshot(
    target: DataFrame, snapshot: DataFrame, spec: SyncSpec, strategy: str = SOURCE_WINS,
    page_map: DataFrame | None = None, para_map: DataFrame | None = None, order: str | None = None,
) -> ApplyResult:
    """Apply a snapshot to a target table.

    Nothing is written to the target, so a dry run is the same call without a write of ``table``. The merge is computed
    once, at once, into the work folder; table and outcomes read it there. ``order`` names the column (a
    file path) that decides which of several rows with one key counts; the others are skipped.
    """
    table = spec.table
    rows, rejects, warnings = prepare_incoming(snapshot, target, spec, page_map, para_map, order)
    name = F.lit(table.table).alias("table_name")
    if not table.keys:
        rows = rows.drop("_order")
        return ApplyResult(
            replace_all(target, rows), rows.select(name, F.lit(CREATED).alias("outcome")),
            rejects, rows.where(F.lit(False)), warnings,
        )
    # A key that stayed NULL has no default; the target could not store it.
    keys = [c for c in rows.columns if listed(table.keys, c)]
    no_key = any_of(F.col(f"`{k}`").isNull() for k in keys)
    failed, rows = rows.where(no_key), rows.where(~no_key)
    merged, outcomes = merge_once(target, rows, table, strategy, "_order" if order else None)
    outcomes = outcomes.select(name, "outcome").unionByName(failed.select(name, F.lit(FAILED).alias("outcome")))
    return ApplyResult(merged, outcomes, rejects, failed.drop("_order"), warnings)


@dataclass(frozen=True)
class ApplyAllResult:
    """The result per table, and over all of them: ``summary`` counts outcomes, ``warnings`` lists what was noticed.

    ``warnings`` (table_name, warning) has dropped columns, cells that did not parse, and rows without a key.
    """

    results: dict[str, ApplyResult]
    warnings: DataFrame

    def summary(self) -> DataFrame:
        return run_summary(reduce(DataFrame.unionByName, [r.outcomes for r in self.results.values()]))


def apply_all(
    targets: dict[str, DataFrame], snapshots: dict[str, DataFrame], specs: list[SyncSpec], strategy: str = SOURCE_WINS,
    content: AppliedContent | None = None, order: str | None = None, strict: bool = False,
) -> ApplyAllResult:
    """Apply the snapshots of several tables, in the order of ``specs``.

    Links in the tables go through the id maps of a ``content`` apply. All warnings, those of the content included, pass one
    gate at the end: a strict run fails if there is any, before the caller writes a table. Tables without a snapshot stay out.
    """
    page_map, para_map = (content.page_map, content.para_map) if content else (None, None)
    results, notes = {}, []
    for spec in specs:
        name = spec.table.table
        if name not in snapshots:
            continue
        done = apply_snapshot(targets[name], snapshots[name], spec, strategy, page_map, para_map, order)
        results[name] = done
        label = F.lit(name).alias("table_name")
        notes.append(done.warnings.select(label, "warning"))
        cell = F.concat(F.lit("no value for "), "col", F.lit(": "), "value")
        notes.append(done.rejects.select(label, cell.alias("warning")))
        notes.append(done.failed.select(label, F.lit("a row without a key").alias("warning")))
    if not results:
        raise ValueError("no table has a snapshot")
    if content is not None:
        lost = F.concat(F.lit("row "), F.col("source_id").cast("string"), F.lit(" "), "outcome", F.lit(": "), F.coalesce("warning", F.lit("above it")))
        notes.append(content.failed.select("table_name", lost.alias("warning")))
        if content.warnings is not None:
            notes.append(content.warnings.select(F.lit("permissions").alias("table_name"), F.concat(F.lit("unknown group "), "group_name").alias("warning")))
    warnings = cut(reduce(DataFrame.unionByName, notes))
    assert_no_warnings(warnings, strict)
    return ApplyAllResult(results, warnings)
