"""Registered queries: each operator on the given tables, beside the SQL that must give the same rows."""

from checks import contents, documents, files, graphs, identities, merges, references, reports, tables  # noqa: F401
from checks.base import CASES

__all__ = ["CASES"]
