"""Listing pages to the set of document links, as one plan with one shuffle per result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from folioline.fixed import LINK_BASE, LINK_TYPE, SITE_HOST, WANTED_CHAMBERS, YEAR_KEY
from folioline.functions import html as H
from folioline.functions.text import to_int
from folioline.functions.urls import listing_url, query_param
from folioline.operators.links import (
    absolute_links, distinct_links, extract_row_links, filter_in, has_link, listing_frontier, max_page,
    on_allowed_host,
)
from folioline.schema import NO_HREF


@dataclass
class Crawl:
    links: DataFrame
    rejects: DataFrame


def next_listings(listings: DataFrame, at_least_one: bool = True) -> DataFrame:
    """``(year, page, url)`` of all listing pages of the years seen so far, for the next fetch.

    The page count of a year is the greatest that any of its pages mentions. A year whose
    pagination is missing has one page, unless ``at_least_one`` is off: then it has none.
    """
    asked = query_param(F.col("url"), YEAR_KEY)
    seen = listings.select(to_int(asked).alias("year"), H.last_page(F.col("html"), asked).alias("n")).where("year is not null")
    counted = max_page(seen, ["year"], "n", out="n")
    pages = listing_frontier(counted, "n", at_least_one=at_least_one)
    return pages.withColumn("url", listing_url(F.col("year"), F.col("page")))


def crawl(
    listings: DataFrame,
    chambers: list[str] = WANTED_CHAMBERS,
    hosts: list[str] = [SITE_HOST],
    link_type: str = LINK_TYPE,
    base: str = LINK_BASE,
) -> Crawl:
    """``listings (url, html)`` to unique links; a wanted row without a link is a reject."""
    rows = filter_in(extract_row_links(on_allowed_host(listings, "url", hosts), ["url"], link_type=link_type),
                     "chamber", chambers)
    linked, bare = has_link(rows)
    return Crawl(
        links=distinct_links(absolute_links(linked, base=base)),
        rejects=bare.select(
            F.col("url").alias("link"), F.lit("crawl").alias("stage"),
            F.lit(NO_HREF).alias("error")),
    )
