"""Column expressions over cell text. All of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space when a cell is trimmed.
WHITESPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """NULL, empty or only white space."""
    return F.coalesce(F.ltrim(col, F.lit(WHITESPACE)) == "", F.lit(True))


def is_empty(col: Column) -> Column:
    """NULL or empty; white space counts as a value."""
    return F.coalesce(col == "", F.lit(True))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def actual_name(df: DataFrame, name: str) -> str | None:
    """The column's own spelling of ``name``, or None if the frame does not have it."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def listed(names, name: str) -> bool:
    """Is ``name`` among ``names``, whatever its spelling?"""
    return name.lower() in {n.lower() for n in names}


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")]


def cell(df: DataFrame, name: str) -> Column:
    """The cell as text; NULL when empty or when the frame lacks the column."""
    found = actual_name(df, name)
    return F.lit(None).cast("string") if found is None else F.col(f"`{found}`").cast("string")


def safe_name(col: Column) -> Column:
    """A file name from free text: trimmed, ``_unnamed`` when blank, ``/`` and NUL become ``_``."""
    name = F.regexp_replace(trimmed(F.coalesce(col, F.lit(""))), "[/\\x00]", "_")
    return F.when(name == "", F.lit("_unnamed")).otherwise(name)


def like_any(col: Column, fragments) -> Column:
    """True where the text contains one of the literal fragments."""
    return any_of(F.coalesce(F.contains(col, F.lit(f)), F.lit(False)) for f in fragments)
