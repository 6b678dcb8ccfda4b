"""Applying incoming rows to a target table: upsert, seed fill, subset update, dry-run reports.

A merge is one join of target and incoming rows on the folded key and one projection. The result is
a new table; write it to a new place and swap, never onto the path that is being read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from tablesync.functions.text import actual_name, all_of, any_of, is_blank, listed
from tablesync.functions.unset import default_value, is_unset
from tablesync.operators.identity import (
    folded_identity,
    last_by_identity,
    last_per,
    row_checksum,
    with_match_keys,
)
from tablesync.operators.placement import cut, prefixed
from tablesync.operators.selection import fill_map, fill_map_counts, lowered, overwrite_map
from tablesync.spec import CREATED, DESTINATION_WINS, KEPT, SKIPPED, SOURCE_WINS, UPDATED, TableSpec

T, S = "t__", "s__"
UNFOLD = 10_000


def last_incoming(incoming: DataFrame, spec: TableSpec, order: str | None = None) -> DataFrame:
    """One row per key, as keys are matched: the last in ``order`` (a file path), without one by a hash of the content."""
    keyed, names = with_match_keys(incoming, spec)
    return last_per(keyed, names, [order] if order else []).drop(*names)


def superseded(incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """An outcome, ``skipped``, for each row that gives way to a later one of its key. Counted before it is unfolded."""
    keyed, names = with_match_keys(incoming, spec)
    n = keyed.groupBy(*names).agg((F.count("*") - 1).alias("n")).where("n > 0")
    parts = n.select("n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / UNFOLD))).alias("part"))
    size = F.least(F.lit(UNFOLD), F.col("n") - F.col("part") * UNFOLD).cast("int")
    return parts.select(F.explode(F.array_repeat(F.lit(SKIPPED), size)).alias("outcome"))


def pair_rows(target: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """Target and incoming rows side by side (``t__*``, ``s__*``), each also where it has no partner.

    One full outer join. Incoming keys must be unique: see ``last_incoming``, whose shuffle by key this join reuses.
    """
    t, keys = with_match_keys(target, spec)
    s, _ = with_match_keys(incoming, spec)
    t = prefixed(t.withColumn("in", F.lit(True)), T, keys)
    s = prefixed(s.withColumn("in", F.lit(True)), S, keys)
    return t.join(s, keys, "full_outer")


def _plain_value(spec: TableSpec, target: DataFrame, incoming: DataFrame, col: str, overwrite: Column):
    """The merged cell of ``col`` when ``overwrite`` tells whether the incoming value replaces it."""
    name = actual_name(incoming, col)
    mine, present = F.col(f"`{T}{col}`"), F.coalesce(F.col(f"`{T}in`"), F.lit(False))
    dtype = target.schema[col].dataType
    key, auto = listed(spec.keys, col), listed(spec.auto_cols, col)
    if name is None or (auto and not key):
        return mine  # unknown to the source, or numbered by the target itself
    theirs = F.col(f"`{S}{name}`")
    if incoming.schema[name].dataType.simpleString() != dtype.simpleString():
        theirs = theirs.cast(dtype)
    if key:
        default = default_value(dtype)
        return F.when(present, mine).otherwise(theirs if default is None else F.coalesce(theirs, default))
    if isinstance(dtype, types.MapType):
        merged = overwrite_map(mine, theirs, lowered(spec.keep_fields))
        return F.when(~present, theirs).when(overwrite, merged).otherwise(mine)
    return F.when(present & ~overwrite, mine).otherwise(theirs)


def upsert(target: DataFrame, incoming: DataFrame, spec: TableSpec, order: str | None = None) -> DataFrame:
    """Source wins: overwrite the columns the incoming rows bring, insert unknown keys, delete nothing.

    Of several incoming rows with one key the last in ``order`` counts.
    """
    incoming = last_incoming(incoming, spec, order)
    pairs = pair_rows(target, incoming, spec)
    wins = F.coalesce(F.col(f"{S}in"), F.lit(False))
    return pairs.select([_plain_value(spec, target, incoming, c, wins).alias(c) for c in target.columns])


def _fillable(target: DataFrame, incoming: DataFrame, spec: TableSpec) -> list[str]:
    return [
        c
        for c in target.columns
        if listed(incoming.columns, c) and not listed(spec.keys, c) and not listed(spec.auto_cols, c)
    ]


def _fill_plan(pairs: DataFrame, target: DataFrame, incoming: DataFrame, spec: TableSpec, seed: Column):
    """Add ``_filled``, the columns a seed value goes into, for rows where ``seed`` holds."""
    flags = []
    for c in _fillable(target, incoming, spec):
        mine, theirs = F.col(f"`{T}{c}`"), F.col(f"`{S}{actual_name(incoming, c)}`")
        kind = target.schema[c].dataType
        if isinstance(kind, types.MapType):
            changed = fill_map_counts(mine, theirs, lowered(spec.keep_fields))[0] > 0
        elif _shares_members(kind, incoming, c):
            changed = theirs.isNotNull() & (mine.isNull() | any_of(_open_members(mine, theirs, kind, incoming, c).values()))
        else:
            changed = is_unset(mine, kind)
        flags.append(F.when(seed & F.coalesce(changed, F.lit(False)), F.lit(c)))
    filled = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return pairs.withColumn("_filled", filled)


def _shares_members(kind, incoming: DataFrame, col: str) -> bool:
    """Both sides hold a struct, which is filled member by member."""
    return isinstance(kind, types.StructType) and isinstance(incoming.schema[actual_name(incoming, col)].dataType, types.StructType)


def _open_members(mine: Column, theirs: Column, kind: types.StructType, incoming: DataFrame, col: str) -> dict[str, Column]:
    """Members that are unset here and set there."""
    other = {f.name: f.dataType for f in incoming.schema[actual_name(incoming, col)].dataType.fields}
    return {
        f.name: is_unset(mine[f.name], f.dataType) & ~is_unset(theirs[f.name], other[f.name]) for f in kind.fields if f.name in other
    }


def _filled_value(target: DataFrame, incoming: DataFrame, spec: TableSpec, col: str):
    """What a filled field map or struct becomes; None for columns that are filled as one value."""
    name = actual_name(incoming, col)
    if name and isinstance(target.schema[col].dataType, types.MapType):
        return fill_map(F.col(f"`{T}{col}`"), F.col(f"`{S}{name}`"), lowered(spec.keep_fields))
    kind = target.schema[col].dataType
    if name and _shares_members(kind, incoming, col):
        mine, theirs = F.col(f"`{T}{col}`"), F.col(f"`{S}{name}`")
        open_ = _open_members(mine, theirs, kind, incoming, col)
        cells = [
            F.when(open_[f.name], theirs[f.name]).otherwise(mine[f.name]).alias(f.name) if f.name in open_ else mine[f.name].alias(f.name)
            for f in kind.fields
        ]
        return F.when(mine.isNull(), theirs.cast(kind)).otherwise(F.struct(*cells))
    return None


def _seed_value(target: DataFrame, incoming: DataFrame, spec: TableSpec, col: str, whole: Column):
    """The merged cell under destination-wins: filled cells and rows where ``whole`` holds change."""
    mine = F.col(f"`{T}{col}`")
    merged = _filled_value(target, incoming, spec, col)
    if merged is not None:
        filled = F.when(F.array_contains("_filled", col), merged).otherwise(mine)
        return F.when(whole, _plain_value(spec, target, incoming, col, whole)).otherwise(filled)
    return _plain_value(spec, target, incoming, col, whole | F.array_contains("_filled", col))


def _same_cells(target: DataFrame, incoming: DataFrame, spec: TableSpec) -> Column:
    """What equal checksums say, asked of paired rows directly: no hash to compute and none to move.

    Blank text equals NULL; a compared column that one side lacks counts as blank there.
    """
    if spec.compare_cols:
        names = list(spec.compare_cols)
    else:
        names = [c for c in target.columns if not listed(spec.auto_cols, c)]

    def side(df: DataFrame, prefix: str, name: str):
        found = actual_name(df, name)
        if found is None:
            return F.lit(None).cast("string"), None
        return F.col(f"`{prefix}{found}`"), df.schema[found].dataType

    checks = []
    for name in names:
        (mine, my_type), (theirs, their_type) = side(target, T, name), side(incoming, S, name)
        if isinstance(my_type, types.MapType) and isinstance(their_type, types.MapType):
            mine, theirs = (F.array_sort(F.map_entries(v)) for v in (mine, theirs))
        elif my_type is None or my_type != their_type or my_type.typeName() == "string":
            mine, theirs = (F.when(~is_blank(v.cast("string")), v.cast("string")) for v in (mine, theirs))
        checks.append(mine.eqNullSafe(theirs))
    return all_of(checks)


def merge_rows(
    target: DataFrame, incoming: DataFrame, spec: TableSpec, strategy: str = SOURCE_WINS, order: str | None = None,
    always: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``incoming`` to ``target``; add ``outcome`` and ``filled`` to the merged rows.

    Of several incoming rows with one key the last in ``order`` counts. ``always`` names columns that the source
    decides under either strategy. Where rows go by their key, everything is decided in one join. With a separate
    name column the name decides what is skipped or filled and the key what is written; see ``_merge_by_name``.
    """
    if not spec.goes_by_key:
        return _merge_by_name(target, incoming, spec, strategy, order)
    incoming = last_incoming(incoming, spec, order)
    pairs = pair_rows(target, incoming, spec)
    in_t = F.coalesce(F.col(f"{T}in"), F.lit(False))
    in_s = F.coalesce(F.col(f"{S}in"), F.lit(False))
    same = in_t & in_s & _same_cells(target, incoming, spec)
    if strategy == DESTINATION_WINS:
        pairs = _fill_plan(pairs, target, incoming, spec, in_t & in_s & ~same)
        moved = any_of(
            ~F.col(f"`{T}{c}`").eqNullSafe(F.col(f"`{S}{actual_name(incoming, c)}`").cast(target.schema[c].dataType))
            for c in target.columns if listed(always, c) and actual_name(incoming, c)
        )
        quiet = same | (F.size("_filled") == 0) & ~moved
        cells = [
            (_plain_value(spec, target, incoming, c, in_s) if listed(always, c) else _seed_value(target, incoming, spec, c, ~in_t)).alias(c)
            for c in target.columns
        ]
    else:
        pairs = pairs.withColumn("_filled", F.array().cast("array<string>"))
        quiet = same
        cells = [_plain_value(spec, target, incoming, c, in_s & ~same).alias(c) for c in target.columns]
    outcome = F.when(~in_s, KEPT).when(~in_t, CREATED).when(quiet, SKIPPED).otherwise(UPDATED)
    seeds = [F.col(f"`{S}{actual_name(incoming, c)}`").alias(f"_seed_{c}") for c in _fillable(target, incoming, spec)]
    return pairs.select(*cells, outcome.alias("outcome"), F.col("_filled").alias("filled"), *seeds)


def _judge_by_name(target: DataFrame, incoming: DataFrame, spec: TableSpec, strategy: str):
    """Incoming rows beside the target row of the same identity, with what is to happen to them.

    Returns the pairs and two conditions: the row changes nothing; the row only fills cells.
    """
    s = incoming.select(
        *incoming.columns,
        folded_identity(incoming, spec).alias("_identity"),
        row_checksum(incoming, spec, target.columns).alias("_sum"),
    )
    t = last_by_identity(target, spec)
    t = t.withColumn("_sum", row_checksum(t, spec, target.columns))
    sides = prefixed(s, S, ("_identity",)).join(
        prefixed(t.withColumn("in", F.lit(True)), T, ("_identity",)), "_identity", "left"
    )
    found = F.coalesce(F.col(f"{T}in"), F.lit(False))
    same = F.coalesce(F.col(f"{T}_sum") == F.col(f"{S}_sum"), F.lit(False))
    seeded = found & F.lit(strategy == DESTINATION_WINS)
    sides = _fill_plan(sides, target, incoming, spec, seeded & ~same)
    quiet = same | (seeded & (F.size("_filled") == 0))
    return sides, quiet, seeded


def _changes_by_name(target: DataFrame, incoming: DataFrame, spec: TableSpec, strategy: str, order: str | None):
    """Incoming rows as changes addressed by the key of the row they change, and whether a row is ``_quiet``.

    A change is ``_whole`` (all cells) or fills the cells in ``_filled``; ``_place`` decides between changes of one key.
    """
    sides, quiet, seeded = _judge_by_name(target, incoming, spec, strategy)
    cells = []
    for c in incoming.columns:
        col = F.col(f"`{S}{c}`")
        mine = actual_name(target, c)
        merged = _filled_value(target, incoming, spec, mine) if mine else None
        if merged is not None:
            col = F.when(F.array_contains("_filled", mine), merged).otherwise(col)
        if mine and listed(spec.keys, c):
            col = F.when(seeded, F.col(f"`{T}{mine}`")).otherwise(col)
        cells.append(col.alias(c))
    place = F.col(f"`{S}{order}`") if order else F.lit(None).cast("string")
    return sides.select(*cells, (~seeded).alias("_whole"), "_filled", place.alias("_place"), quiet.alias("_quiet"))


def _merge_by_name(target: DataFrame, incoming: DataFrame, spec: TableSpec, strategy: str, order: str | None) -> DataFrame:
    """Identity finds the row to skip or fill, the key finds the row to write.

    The first join turns the incoming rows into changes, each addressed by the key of the row it
    changes; the second applies them.
    """
    return _apply_changes(target, _changes_by_name(target, incoming, spec, strategy, order), incoming, spec)


def _apply_changes(target: DataFrame, changes: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    keyed, names = with_match_keys(changes.where("not _quiet").drop("_quiet"), spec)
    changes = last_per(keyed, names, ["_whole", "_place"]).drop(*names, "_place")
    pairs = pair_rows(target, changes, spec)
    in_t = F.coalesce(F.col(f"{T}in"), F.lit(False))
    in_s = F.coalesce(F.col(f"{S}in"), F.lit(False))
    whole = F.coalesce(F.col(f"{S}_whole"), F.lit(False))
    filled = F.coalesce(F.col(f"{S}_filled"), F.array().cast("array<string>"))
    out = [
        _plain_value(spec, target, incoming, c, in_s & (whole | F.array_contains(filled, c))).alias(c)
        for c in target.columns
    ]
    outcome = F.when(~in_s, KEPT).when(~in_t, CREATED).otherwise(UPDATED)
    seeds = [F.col(f"`{S}{actual_name(incoming, c)}`").alias(f"_seed_{c}") for c in _fillable(target, incoming, spec)]
    return pairs.select(*out, outcome.alias("outcome"), filled.alias("filled"), *seeds)


def merge_once(
    target: DataFrame, incoming: DataFrame, spec: TableSpec, strategy: str = SOURCE_WINS, order: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The merged table and the ``outcome`` of every incoming row, both read from one written merge. Runs at once.

    A row that gives way to another incoming row of the same key is skipped, so outcomes are as many as rows.
    """
    if spec.goes_by_key:
        merged = cut(merge_rows(target, incoming, spec, strategy, order).select(*target.columns, F.col("outcome").alias("_outcome")))
        own, idle = merged, superseded(incoming, spec)
    else:
        changes = cut(_changes_by_name(target, incoming, spec, strategy, order))
        own = cut(_apply_changes(target, changes, incoming, spec).select(*target.columns, F.col("outcome").alias("_outcome")))
        idle = changes.where("_quiet").select(F.lit(SKIPPED).alias("outcome")).unionByName(superseded(changes.where("not _quiet"), spec))
    outcomes = own.where(F.col("_outcome") != KEPT).select(F.col("_outcome").alias("outcome"))
    return own.select(*target.columns), outcomes.unionByName(idle)


def seed_fill(target: DataFrame, incoming: DataFrame, spec: TableSpec, order: str | None = None) -> DataFrame:
    """Destination wins: fill only unset cells of known rows, insert the others.

    Adds ``outcome`` and ``filled`` (the names of the filled columns, comma-separated).
    """
    merged = merge_rows(target, incoming, spec, DESTINATION_WINS, order)
    return merged.select(*target.columns, "outcome", F.array_join("filled", ",").alias("filled"))


def would_fill(target: DataFrame, incoming: DataFrame, spec: TableSpec, order: str | None = None) -> DataFrame:
    """Dry run of ``seed_fill``: one row per cell that would be filled."""
    merged = merge_rows(target, incoming, spec, DESTINATION_WINS, order).where("outcome = 'updated'")
    key_cols = [actual_name(target, k) for k in spec.keys]
    lines = [
        F.when(
            F.array_contains("filled", c),
            F.struct(F.lit(c).alias("col"), F.col(f"`_seed_{c}`").cast("string").alias("seed")),
        )
        for c in _fillable(target, incoming, spec)
    ]
    fills = F.array_compact(F.array(*lines)) if lines else F.array().cast("array<struct<col:string,seed:string>>")
    return merged.select(*key_cols, F.inline(fills))


def replace_all(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """A keyless table takes the incoming rows as they are, auto-numbers included."""
    cells = []
    for f in target.schema.fields:
        name = actual_name(incoming, f.name)
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        cells.append(value.cast(f.dataType).alias(f.name))
    return incoming.select(*cells)


def update_subset(target: DataFrame, patch: DataFrame, keys: list[str], cols: list[str], order: str | None = None) -> DataFrame:
    """Overwrite just ``cols`` of the rows whose keys the patch names. No columns: nothing happens.

    Of several patches with one key the last in ``order`` counts.
    """
    if not cols:
        return target
    spec = TableSpec("", tuple(keys))
    patch = last_incoming(patch, spec, order)
    t, names = with_match_keys(target, spec)
    p, _ = with_match_keys(patch, spec)
    p = p.select(*names, F.lit(True).alias(f"{S}in"), *[F.col(f"`{actual_name(patch, c)}`").alias(S + c) for c in cols])
    joined = t.join(p, names, "left")
    hit = F.coalesce(F.col(f"{S}in"), F.lit(False))
    cells = [
        F.when(hit, F.col(f"`{S}{next(n for n in cols if n.lower() == c.lower())}`"))
        .otherwise(F.col(f"`{c}`"))
        .cast(target.schema[c].dataType)
        .alias(c)
        if listed(cols, c)
        else F.col(f"`{c}`")
        for c in target.columns
    ]
    return joined.select(*cells)


def diff_rows(target: DataFrame, incoming: DataFrame, spec: TableSpec, order: str | None = None) -> DataFrame:
    """Dry run of an update: one row per cell that differs, old and new as text. The last incoming row of a key counts.

    The rows are joined once; the differing cells are unfolded afterwards, so the join does not grow
    with the number of columns.
    """
    t, keys = with_match_keys(target, spec)
    s, _ = with_match_keys(last_incoming(incoming, spec, order), spec)
    pairs = prefixed(t, T, keys).join(prefixed(s, S, keys), keys)
    cells = []
    fields = []
    for c in _fillable(target, incoming, spec):
        mine, theirs = F.col(f"`{T}{c}`"), F.col(f"`{S}{actual_name(incoming, c)}`")
        if isinstance(target.schema[c].dataType, types.MapType):
            fields.append(_field_diffs(c, mine, theirs))
            continue
        old, new = mine.cast("string"), theirs.cast(target.schema[c].dataType).cast("string")
        cell = F.struct(F.lit(c).alias("col"), old.alias("old_value"), new.alias("new_value"))
        cells.append(F.when(~old.eqNullSafe(new), cell))
    differing = F.array_compact(F.array(*cells)) if cells else F.array().cast(DIFF)
    if fields:
        differing = F.concat(differing.cast(DIFF), *fields)
    shown = [F.col(f"`{T}{actual_name(target, k)}`").alias(actual_name(target, k)) for k in spec.keys]
    return pairs.select(*shown, F.inline(differing))


DIFF = "array<struct<col:string,old_value:string,new_value:string>>"


def _field_diffs(col: str, mine: Column, theirs: Column) -> Column:
    """Entries of an incoming field map that differ from the target's, as ``col[key]``."""
    own = F.coalesce(mine, F.create_map().cast("map<string,string>"))
    entries = F.coalesce(F.map_entries(theirs), F.array().cast("array<struct<key:string,value:string>>"))
    changed = F.filter(entries, lambda e: ~F.try_element_at(own, e["key"]).eqNullSafe(e["value"]))
    return F.transform(
        changed,
        lambda e: F.struct(
            F.concat(F.lit(col + "["), e["key"], F.lit("]")).alias("col"),
            F.try_element_at(own, e["key"]).alias("old_value"),
            e["value"].alias("new_value"),
        ),
    ).cast(DIFF)


def dedupe_incoming(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of several incoming rows with one key the last in ``order`` (the file path) counts."""
    return last_per(df, keys, [order])


def fill_scalars(
    target: DataFrame, incoming: DataFrame, keys: list[str], scalars: list[str], groups: dict[str, list[str]],
    always: list[str] = (), when_present: list[str] = (), whole_if_missing: tuple[str, ...] = (),
    enabled_by: dict[str, str] | None = None, order: str | None = None,
) -> DataFrame:
    """Fill the unset scalars and sub-object members of known pages; count what was filled and left.

    Of several incoming rows with one key the last in ``order`` counts.

    ``groups``            struct columns and their members; a NULL struct in the source changes nothing
    ``always``            columns the source decides (parent, area)
    ``when_present``      columns considered only where the source has a value (dates)
    ``whole_if_missing``  structs that are taken whole, as one fill, where the target has none
    ``enabled_by``        struct → member that must be true in the source for the struct to count
    """
    enabled_by = enabled_by or {}
    spec = TableSpec("", tuple(keys))
    t, names = with_match_keys(target, spec)
    s, _ = with_match_keys(last_incoming(incoming, spec, order), spec)
    s = prefixed(s.withColumn("in", F.lit(True)), S, names)
    rows = t.join(s, names, "left")
    hit = F.coalesce(F.col(f"{S}in"), F.lit(False))
    filled, left, out = [], [], {}

    for c in [*scalars, *when_present]:
        theirs = F.col(f"{S}{c}")
        considered = hit & theirs.isNotNull() if c in when_present else hit
        empty = is_unset(F.col(c), target.schema[c].dataType)
        filled.append(considered & empty)
        left.append(considered & ~empty)
        out[c] = F.when(considered & empty, theirs).otherwise(F.col(c))
    for g, members in groups.items():
        theirs, fields = F.col(f"{S}{g}"), target.schema[g].dataType
        considered = hit & theirs.isNotNull()
        if g in enabled_by:
            considered = considered & F.coalesce(theirs[enabled_by[g]], F.lit(False))
        built = considered & F.col(g).isNull() if g in whole_if_missing else F.lit(False)
        each = considered & ~built
        cells = []
        for f in fields.fields:
            if f.name in members:
                empty = is_unset(F.col(g)[f.name], f.dataType)
                filled.append(each & empty)
                left.append(each & ~empty)
                cells.append(F.when(each & empty, theirs[f.name]).otherwise(F.col(g)[f.name]).alias(f.name))
            else:
                cells.append(F.col(g)[f.name].alias(f.name))
        filled.append(built)
        out[g] = F.when(built, theirs).when(each, F.struct(*cells)).otherwise(F.col(g))
    for c in always:
        out[c] = F.when(hit, F.col(f"{S}{c}")).otherwise(F.col(c))

    def total(flags):
        return sum((f.cast("int") for f in flags), F.lit(0))

    cells = [out[c].cast(target.schema[c].dataType).alias(c) if c in out else F.col(c) for c in target.columns]
    n_filled = total(filled)
    outcome = F.when(~hit, KEPT).when(n_filled == 0, SKIPPED).otherwise(UPDATED)
    return rows.select(*cells, n_filled.alias("n_filled"), total(left).alias("n_left"), outcome.alias("outcome"))
