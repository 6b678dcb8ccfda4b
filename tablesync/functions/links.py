"""Patterns and expressions for page references inside text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesync.functions.text import trimmed

# The two reference notations.
LINK = r"(?i)(Default\.aspx\?ID=)([0-9]+)(#([0-9]+))?"
SELECTED = r'("SelectedValue":\s*")([0-9]+)(")'

PAGE = r"(?i)Default\.aspx\?ID=[0-9]+"

PREFIX_LENGTH = len("Default.aspx?ID=")


def as_id(digits: Column) -> Column:
    """Digits as an id; NULL beyond the 32-bit range, which no id reaches."""
    return digits.try_cast("int")


def whole_number(text: Column) -> Column:
    """The id when the entire text is one whole number, else NULL."""
    clean = trimmed(text)
    return F.when(clean.rlike(r"^[+-]?[0-9]+$"), as_id(clean))


def links_in(text: Column) -> Column:
    """All links of a text, as they stand there: prefix, digits, perhaps ``#`` and digits."""
    return F.regexp_extract_all(text, F.lit(LINK), F.lit(0))


def selections_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SELECTED), F.lit(0))


def _numbers(link: Column) -> Column:
    return F.split(F.substring(link, PREFIX_LENGTH + 1, F.length(link)), "#", -1)


def page_of(link: Column) -> Column:
    return as_id(_numbers(link)[0])


def anchor_of(link: Column) -> Column:
    """The paragraph id behind ``#``, NULL without one."""
    return as_id(F.try_element_at(_numbers(link), F.lit(2)))


def id_of(selection: Column) -> Column:
    return as_id(F.regexp_extract(selection, SELECTED, 2))


def _bound(value: Column, use) -> Column:
    """Compute ``value`` once and use it several times."""
    return F.transform(F.array(value), use)[0]


def _rewrite_all(text: Column, pattern: str, found, replacement) -> Column:
    """Put the text together again from what stands between the references and their replacements."""
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(
        between, found(text), lambda b, m: F.when(m.isNull(), b).otherwise(F.concat(b, replacement(m)))
    )
    return F.array_join(pairs, "")


def rewrite_text(text: Column, page_map: Column, para_map: Column) -> Column:
    """Rewrite every reference of one text through two id maps held by the same row.

    A text that is nothing but a mapped id becomes the mapped id. Otherwise JSON selections are
    rewritten first, then links with their anchors. Unmapped pages leave the whole link as it is.
    """

    def mapped(lookup: Column, number: Column) -> Column:
        return F.try_element_at(lookup, number).cast("string")

    def selection(m: Column) -> Column:
        new = mapped(page_map, id_of(m))
        return F.when(new.isNull(), m).otherwise(F.concat(F.regexp_extract(m, SELECTED, 1), new, F.lit('"')))

    def link(m: Column) -> Column:
        page = mapped(page_map, page_of(m))
        digits = F.try_element_at(_numbers(m), F.lit(2))
        anchor = F.coalesce(mapped(para_map, as_id(digits)), as_id(digits).cast("string"), digits)
        tail = F.when(digits.isNull(), "").otherwise(F.concat(F.lit("#"), anchor))
        return F.when(page.isNull(), m).otherwise(F.concat(F.substring(m, 1, PREFIX_LENGTH), page, tail))

    whole = mapped(page_map, whole_number(text))
    chosen = F.when(F.contains(text, F.lit('"SelectedValue"')), _rewrite_all(text, SELECTED, selections_in, selection))
    rewritten = _bound(F.coalesce(chosen, text), lambda t: _rewrite_all(t, LINK, links_in, link))
    return F.when(whole.isNotNull(), whole).otherwise(rewritten)


def page_links(text: Column) -> Column:
    """The page part of all links of a text, without anchors."""
    return F.regexp_extract_all(text, F.lit(PAGE), F.lit(0))


def page_link_id(link: Column) -> Column:
    return as_id(F.substring(link, PREFIX_LENGTH + 1, F.length(link)))


def without_pages(text: Column, gone: Column) -> Column:
    """Cut out the page part of links to the ids in ``gone`` (array of long)."""
    def left(m: Column) -> Column:
        return F.when(F.array_contains(gone, page_link_id(m).cast("long")), "").otherwise(m)

    return _rewrite_all(text, PAGE, page_links, left)
