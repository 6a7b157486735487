"""From listing pages to the set of links. Everything up to the last ``distinct`` is map-only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from folioline.fixed import LINK_BASE, LINK_TYPE, WANTED_CHAMBERS
from folioline.functions import html as H
from folioline.functions.text import to_int, trim_space
from folioline.functions.urls import absolute_link, allowed_host


def parse_years(df: DataFrame, texts_col: str, out: str = "year") -> DataFrame:
    """One row per array element that is a whole number; the others are skipped."""
    year = F.explode(texts_col).alias(out)
    return (
        df.select(*[c for c in df.columns if c != texts_col], year)
        .withColumn(out, to_int(F.col(out)))
        .where(F.col(out).isNotNull())
    )


def read_years(listings: DataFrame) -> DataFrame:
    """Distinct years offered by the year selector of any listing page."""
    return parse_years(listings.select(H.year_options(F.col("html")).alias("years")), "years").distinct()


def max_page(df: DataFrame, group_cols: list[str], page_col: str, out: str = "max_page") -> DataFrame:
    """Greatest page number per listing; partial maxima travel, not rows."""
    return df.groupBy(*group_cols).agg(F.max(page_col).alias(out))


def listing_frontier(df: DataFrame, n_col: str, out: str = "page", at_least_one: bool = False) -> DataFrame:
    """Pages 1 … n for each row; none where n is below 1.

    With ``at_least_one`` a listing whose pagination is missing still yields page 1.
    """
    n = F.coalesce(F.col(n_col), F.lit(0))
    if at_least_one:
        n = F.greatest(n, F.lit(1))
    # sequence(1, 0) would count down
    pages = F.when(n >= 1, F.sequence(F.lit(1).cast("long"), n.cast("long")))
    return df.select(*[c for c in df.columns if c != n_col], F.explode(pages).alias(out))


def extract_links(listings: DataFrame, keep: list[str], html_col: str = "html", out: str = "href") -> DataFrame:
    """One row per anchor target of a page."""
    return listings.select(*keep, F.explode(H.hrefs(F.col(html_col))).alias(out))


def extract_row_links(
    listings: DataFrame, keep: list[str], html_col: str = "html", link_type: str = LINK_TYPE
) -> DataFrame:
    """``(…, chamber, href)`` per table row; ``href`` is NULL where the row has no wanted anchor."""
    rows = listings.select(*keep, F.explode(H.table_rows(F.col(html_col))).alias("row"))
    return rows.select(
        *keep,
        H.first_cell_text(F.col("row")).alias("chamber"),
        H.first_href_of_type(F.col("row"), link_type).alias("href"),
    )


def filter_in(df: DataFrame, col: str, values: list[str] = WANTED_CHAMBERS) -> DataFrame:
    """Rows whose trimmed ``col`` is one of ``values``."""
    return df.where(trim_space(F.col(col)).isin(values))


def has_link(df: DataFrame, col: str = "href") -> tuple[DataFrame, DataFrame]:
    """(rows with a link, rows without)."""
    return df.where(F.col(col).isNotNull()), df.where(F.col(col).isNull())


def absolute_links(df: DataFrame, col: str = "href", base: str = LINK_BASE, out: str = "link") -> DataFrame:
    return df.withColumn(out, absolute_link(F.col(col), base))


def on_allowed_host(df: DataFrame, col: str, hosts: list[str]) -> DataFrame:
    return df.where(allowed_host(F.col(col), hosts))


def distinct_links(df: DataFrame, col: str = "link") -> DataFrame:
    """The set of links. Copies collapse before the shuffle, so a link with very many copies is no hot spot."""
    return df.select(col).distinct()


def union_links(frames: list[DataFrame], col: str = "link") -> DataFrame:
    """Links of all frames merged into one set, with a single shuffle."""
    return distinct_links(reduce(DataFrame.unionByName, [f.select(col) for f in frames]), col)


def crawl_counts(links: DataFrame, group_col: str, link_col: str = "link") -> DataFrame:
    """Number of listings, of links and of unique links, in one pass; values collapse before the shuffle."""
    return links.agg(
        F.count_distinct(group_col).alias("n_listings"),
        F.count("*").alias("n_links"),
        F.count_distinct(link_col).alias("n_unique"),
    )
