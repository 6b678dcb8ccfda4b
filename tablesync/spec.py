"""What to synchronise and how rows are recognised. Plain declarations, no Spark objects."""

from __future__ import annotations

from dataclasses import dataclass

SOURCE_WINS = "source_wins"
DESTINATION_WINS = "destination_wins"

CREATED, UPDATED, SKIPPED, FAILED, KEPT = "created", "updated", "skipped", "failed", "kept"

# Columns that only the running site maintains, per table.
RUNTIME_COLUMNS = {
    "UrlPath": ("UrlPathVisitsCount",),
    "EcomShops": (
        "ShopIndexRepository",
        "ShopIndexName",
        "ShopIndexDocumentType",
        "ShopIndexUpdate",
        "ShopIndexBuilder",
    ),
}

# Bookkeeping keys of a field map that never take part in a merge.
SYSTEM_FIELDS = ("Id", "ItemInstanceType", "Sort", "GlobalRecordPageGuid")


@dataclass(frozen=True)
class TableSpec:
    """How the rows of one table are recognised and compared.

    ``keys``          key columns (empty for a keyless table)
    ``name_col``      column whose value identifies a row instead of the keys
    ``compare_cols``  columns that decide whether a row changed (default: all but ``auto_cols``)
    ``auto_cols``     auto-number columns, local to one environment
    ``keep_fields``   map fields left out of snapshots, which an overwrite therefore must not clear
    ``not_null``      columns that must not be NULL
    """

    table: str
    keys: tuple[str, ...] = ()
    name_col: str | None = None
    compare_cols: tuple[str, ...] = ()
    auto_cols: tuple[str, ...] = ()
    keep_fields: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()

    @property
    def goes_by_key(self) -> bool:
        """Rows are recognised by their key: no name column, or the name column is the key."""
        return not self.name_col or [k.lower() for k in self.keys] == [self.name_col.lower()]


@dataclass(frozen=True)
class SyncSpec:
    """One selection to snapshot and apply. ``drop_elements`` are taken out of ``xml_text_cols``."""

    table: TableSpec
    where: str | None = None
    exclude: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    xml_text_cols: tuple[str, ...] = ()
    drop_elements: tuple[str, ...] = ()
    link_cols: tuple[str, ...] = ()


@dataclass(frozen=True)
class PathRule:
    """Select the content below ``path`` of one area, without the ``excludes`` below it."""

    area: int
    path: str
    excludes: tuple[str, ...] = ()


def check_columns(df, names, what: str) -> None:
    """Raise if a declared column does not exist (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    unknown = [n for n in names if n.lower() not in have]
    if unknown:
        raise ValueError(f"{what}: unknown column(s) {', '.join(sorted(unknown))}")
