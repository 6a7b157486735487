"""The few things read from listing markup, as regular expressions over the whole page."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioline.fixed import PAGE_KEY, YEAR_KEY, YEAR_SELECT_ID
from folioline.functions.text import to_int, trim_space
from folioline.functions.urls import query_param


def anchor_tags(html: Column) -> Column:
    """All opening ``<a …>`` tags, in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s(?:[^"'>]|"[^"]*"|'[^']*')*>"""), F.lit(0))


def has_attribute(tag: Column, name: str) -> Column:
    return tag.rlike(rf"(?i)\s{name}\s*=")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, with character references resolved."""
    quoted = F.regexp_extract(tag, rf"""(?i)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return resolve_references(F.regexp_replace(quoted, r"""^["']|["']\z""", ""))


def resolve_references(text: Column) -> Column:
    """Resolve the common character references; ``&amp;`` last, so that nothing is resolved twice."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                       ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def hrefs(html: Column) -> Column:
    """Targets of all anchors of a page, in order."""
    linked = F.filter(anchor_tags(html), lambda tag: has_attribute(tag, "href"))
    return F.transform(linked, lambda tag: attribute(tag, "href"))


def table_rows(html: Column) -> Column:
    """The markup of each table row, from its ``<tr`` up to its end, the next one or the end of the table."""
    parts = F.filter(F.split(html, r"(?i)<tr(?=[\s>])"), lambda part, i: i > 0)
    return F.transform(parts, lambda part: F.get(F.split(part, r"(?i)</(?:tr|tbody|table)(?=[\s>])"), F.lit(0)))


def first_cell_text(row: Column) -> Column:
    cell = F.regexp_extract(row, r"(?is)<t[dh](?:\s[^>]*)?>(.*?)</t[dh]>", 1)
    return trim_space(resolve_references(F.regexp_replace(cell, r"<[^>]*>", "")))


def first_href_of_type(row: Column, link_type: str) -> Column:
    """``href`` of the first anchor with ``type=link_type`` in any cell; NULL where there is none."""
    typed = F.filter(anchor_tags(row), lambda tag: attribute(tag, "type") == link_type)
    targets = F.transform(typed, lambda tag: F.when(has_attribute(tag, "href"), attribute(tag, "href")))
    return F.get(targets, F.lit(0))


def year_options(html: Column) -> Column:
    """Texts of the year selector's options."""
    box = F.regexp_extract(
        html, rf"""(?is)<select\s[^>]*id\s*=\s*["']?{YEAR_SELECT_ID}["']?[^>]*>(.*?)</select>""", 1)
    return F.regexp_extract_all(box, F.lit(r"(?i)<option(?:\s[^>]*)?>([^<]*)"), F.lit(1))


def last_page(html: Column, year: Column | None = None) -> Column:
    """Greatest page number any link to a listing page carries; NULL where no such link exists.

    With ``year`` links to the listings of another year do not count.
    """
    listing = F.filter(hrefs(html), lambda href: href.rlike(r"^[^?]*list\.py\?[^?]*\z"))
    if year is not None:
        listing = F.filter(listing, lambda href: query_param(href, YEAR_KEY).isin("") | (query_param(href, YEAR_KEY) == year))
    return F.array_max(F.transform(listing, lambda href: to_int(query_param(href, PAGE_KEY))))
