"""URL columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioline.fixed import (
    LINK_BASE, LISTING_BASE, LISTING_COURT, LISTING_KIND, PAGE_KEY, PATH_FORMAT, PATH_KEYS, YEAR_KEY,
)


def query_string(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1)


def query_param(url: Column, key: str) -> Column:
    """First well-formed value of parameter ``key``, both decoded; '' where there is none.

    A pair with a bare ``;`` or a broken ``%`` escape is not well-formed and is passed over.
    ``parse_url`` would fail on blanks in the URL and leave the value encoded.
    """
    pairs = F.filter(F.split(query_string(url), "&"), lambda pair: ~pair.rlike(r";|%(?![0-9A-Fa-f]{2})"))
    named = F.filter(pairs, lambda pair: F.try_url_decode(F.substring_index(pair, "=", 1)) == key)
    value = F.regexp_extract(F.get(named, F.lit(0)), r"(?s)^[^=]*=(.*)\z", 1)
    return F.coalesce(F.try_url_decode(value), F.lit(""))


def is_malformed(url: Column) -> Column:
    """Control characters, no scheme before ':', a blank in the host, or a broken escape outside the query."""
    outside_query = F.regexp_replace(url, r"\?[^#]*", "")
    return (
        url.rlike(r"[\x00-\x1f\x7f]")
        | url.startswith(":")
        | url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]* ")
        | outside_query.rlike(r"%(?![0-9A-Fa-f]{2})")
    )


def path_from_url(url: Column, keys: list[str] = PATH_KEYS, fmt: str = PATH_FORMAT) -> Column:
    """Storage path made of the values of ``keys``; NULL where one is empty or the URL is malformed."""
    values = [query_param(url, key) for key in keys]
    usable = ~is_malformed(url)
    for value in values:
        usable = usable & (value != "")
    return F.when(usable, F.format_string(fmt, *values))


def listing_url(year: Column, page: Column, base: str = LISTING_BASE) -> Column:
    """Address of a listing page, parameters in key order; the first page carries no page number."""
    first = F.concat(
        F.lit(f"{base}?Art={LISTING_KIND}&{YEAR_KEY}="), year.cast("string"),
        F.lit(f"&Gericht={LISTING_COURT}"),
    )
    more = F.concat(F.lit(f"&{PAGE_KEY}="), page.cast("string"))
    return F.concat(first, F.when(page > 1, more).otherwise(F.lit("")))


def absolute_link(href: Column, base: Column | str = LINK_BASE) -> Column:
    """``base/href`` with no normalising."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(base, F.lit("/"), href)


def host(url: Column) -> Column:
    """Lower-case host without user and port; NULL where the URL has none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def allowed_host(url: Column, hosts: list[str]) -> Column:
    """True only for URLs on one of ``hosts``."""
    return F.coalesce(host(url).isin([h.lower() for h in hosts]), F.lit(False))


def last_segment(url: Column) -> Column:
    """Last non-empty path segment; '' where the path is empty."""
    return F.regexp_extract(url, r"^https?://[^/?#]+/(?:[^?#]*/)?([^/?#]+)/?(?:[?#].*)?$", 1)
