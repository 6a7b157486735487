"""The registered queries: each operator over the whole of a test table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame`` and ``ORACLES`` the same name to SQL
that gives equal rows. All times are fixed instants, as the current time could not be compared.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioline.fixed import SITE_HOST
from folioline.functions import html as H, ids as I, text as T, urls as U
from folioline.operators import audit, checks, links as L, lookup, pages as P, search, upsert
from folioline.operators.embed import embed, hash_embed, hashed_terms
from folioline.operators.extract import extract_text
from folioline.operators import lsh
from folioline.operators.nearest import knn_cosine
from folioline.plans.crawl import crawl
from folioline.plans.ingest import Ingest
from folioline.schema import INVALID_URL
from folioline.session import scratch_dir, settle, small_frame, spread
from folioline.sinks.blobs import read_saved, save_blobs, write_text_files
from folioline.sinks.runlog import write_run_log
from folioline.sinks.store import PageStore
from folioline.sources.blobs import landed_files, read_blobs
from folioline.sources.fetch import fetch_from_landing
from folioline.sources.listings import read_listings
from folioline.sources.runlog import read_run_log
from folioline.streaming.ingest import ingest_stream, stream_links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TERMS = ["der", "die", "und"]
STEMS = [("der", "d"), ("die", "d"), ("das", "d"), ("des", "d"), ("den", "d"), ("dem", "d"),
         ("und", "und"), ("von", "von"), ("zu", "zu"), ("nicht", "nicht")]
HOSTS = ["m.tionsh.example.net", "blog.tionsh.example.net", "blog.tionsh.example.com", "spam-farm.example.org"]


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table whose texts are taken apart; a single small file is spread over the cores first."""
    return spread(_table(spark, sf_dir, name))


def _instant(day: int):
    return F.to_timestamp(F.lit(f"2024-09-{day:02d} 12:00:00"))


def _shown(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def _doc_path(col: str):
    return F.concat(F.lit("doc/"), F.col(col).cast("string"))


def _hex(col) -> object:
    return F.md5(F.col(col) if isinstance(col, str) else col)


SQL_UUID = r"regexp_replace(md5({}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\1-\2-\3-\4-\5')"
SQL_HOST = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"
SQL_SEGMENT = r"regexp_extract(url, '^https?://[^/?#]+/(?:[^?#]*/)?([^/?#]+)/?(?:[?#].*)?$', 1)"
SQL_PARAM = "regexp_extract(url, '[?&]{}=([^&#]*)', 1)"
SQL_HREFS = """regexp_extract_all(html, '<a href="([^"]*)"', 1)"""
SQL_WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')"
SQL_LINES = "unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS page"
SQL_NOW = "'2024-09-{:02d} 12:00:00'"


# sources

@register("listing_scan", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def listing_scan(spark, sf_dir):
    return read_listings(spark, f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("long").alias("n_chars"))


_WRITTEN: dict[tuple[str, str], str] = {}


def _files(spark, sf_dir) -> str:
    """A folder with a text file for each page, named by its number; written once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        root = scratch_dir(spark, "files")
        write_text_files(_table(spark, sf_dir, "pages"), root, "page_id", "html")
        _WRITTEN[key] = root
    return _WRITTEN[key]


def _page_of_path():
    return F.regexp_extract("path", r"/page_id=(\d+)(?:/[^/]+|\.txt)\z", 1).cast("long").alias("page_id")


@register("blob_scan", "SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS length, md5(html || chr(10)) AS digest FROM pages")
def blob_scan(spark, sf_dir):
    return read_blobs(spark, _files(spark, sf_dir), "*.txt").select(_page_of_path(), "length", _hex("content").alias("digest"))


@register("landed_files", "SELECT page_id, CAST(strlen(html) + 1 AS BIGINT) AS length FROM pages")
def landed(spark, sf_dir):
    return landed_files(spark, _files(spark, sf_dir), "*.txt").select(_page_of_path(), "length")


def _log(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    rows = events.select(
        F.col("event_id").cast("string").alias("link"), F.col("event_type").alias("stage"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
        F.col("value").alias("seconds"))
    path = scratch_dir(spark, "log")
    write_run_log(audit.as_log(rows, _instant(1), 0), path)
    return read_run_log(spark, path)


@register("run_log_scan", """
    SELECT CAST(event_id AS VARCHAR) AS link, event_type AS stage, value AS seconds,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'debug' END AS level,
           CASE WHEN event_type = 'error' THEN 'failed error: ' || props ELSE 'finished ' || event_type END AS msg,
           'processor' AS domain, '2024-09-01 12:00:00' AS time
    FROM events""")
def run_log_scan(spark, sf_dir):
    return _log(spark, sf_dir).select("link", "stage", "seconds", "level", "msg", "domain", _shown("time"))


@register("stage_summary", """
    SELECT event_type AS stage, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
           count(*) AS n, round(avg(value), 6) AS avg_seconds
    FROM events GROUP BY 1, 2""")
def stage_summary(spark, sf_dir):
    return audit.stage_summary(_log(spark, sf_dir), percentile=False).withColumn(
        "avg_seconds", F.round("avg_seconds", 6))


@register("fetch_from_landing", f"""
    WITH links AS (
        SELECT url AS link FROM pages
        UNION SELECT 'https://' || {SQL_HOST} || '/' || unnest({SQL_HREFS}) FROM pages)
    SELECT link, octet_length(encode(html)) AS n_bytes,
           CASE WHEN url IS NULL THEN 'not found in landing table' END AS error
    FROM links LEFT JOIN pages ON link = url""")
def fetched(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    links = L.union_links([pages.select(F.col("url").alias("link")), _absolute(pages)])
    return fetch_from_landing(settle(links, "links"), pages, content_col="html").select(
        "link", F.octet_length("content").cast("long").alias("n_bytes"), "error")


# links and URLs

def _absolute(pages):
    base = F.concat(F.lit("https://"), U.host(F.col("url")))
    hrefs = L.extract_links(pages.withColumn("base", base), ["page_id", "base"])
    return hrefs.select("page_id", U.absolute_link(F.col("href"), F.col("base")).alias("link"))


def _segments(pages, keep):
    texts = pages.select(*keep, F.array(U.last_segment(F.col("url"))).alias("texts"))
    return L.parse_years(texts, "texts", "seg")


@register("parse_int_segment", f"""
    SELECT page_id, CAST({SQL_SEGMENT} AS BIGINT) AS seg FROM pages
    WHERE regexp_full_match({SQL_SEGMENT}, '[+-]?[0-9]+')""")
def parse_int_segment(spark, sf_dir):
    return _segments(_table(spark, sf_dir, "pages"), ["page_id"])


@register("url_query_param", f"""
    SELECT page_id, {SQL_PARAM.format('page')} AS page_no, {SQL_PARAM.format('ref')} AS ref,
           {SQL_PARAM.format('utm_source')} AS utm_source FROM pages""")
def url_query_param(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id", U.query_param(url, "page").alias("page_no"), U.query_param(url, "ref").alias("ref"),
        U.query_param(url, "utm_source").alias("utm_source"))


PATH_ARGS = {"keys": ["page", "ref"], "fmt": "listings/%s/%s.html"}


@register("path_from_url", f"""
    SELECT url AS link, 'listings/' || {SQL_PARAM.format('page')} || '/' || {SQL_PARAM.format('ref')} || '.html' AS path
    FROM pages WHERE {SQL_PARAM.format('page')} <> '' AND {SQL_PARAM.format('ref')} <> ''""")
def path_from_url(spark, sf_dir):
    links = _table(spark, sf_dir, "pages").select(F.col("url").alias("link"))
    return lookup.with_path(links, **PATH_ARGS)[0]


@register("invalid_paths", f"""
    SELECT url AS link, 'path' AS stage, '{INVALID_URL}' AS error
    FROM pages WHERE {SQL_PARAM.format('page')} = '' OR {SQL_PARAM.format('ref')} = ''""")
def invalid_paths(spark, sf_dir):
    links = _table(spark, sf_dir, "pages").select(F.col("url").alias("link"))
    return lookup.with_path(links, **PATH_ARGS)[1]


@register("listing_url", f"""
    WITH s AS (SELECT page_id, {SQL_SEGMENT} AS seg,
                      coalesce(TRY_CAST({SQL_PARAM.format('page')} AS BIGINT), 1) AS n FROM pages)
    SELECT page_id, 'https://juris.bundesgerichtshof.de/cgi-bin/rechtsprechung/list.py?Art=en&Datum=' ||
           CAST(seg AS BIGINT) || '&Gericht=bgh' || CASE WHEN n > 1 THEN '&Seite=' || n ELSE '' END AS listing
    FROM s WHERE regexp_full_match(seg, '[+-]?[0-9]+')""")
def listing_url(spark, sf_dir):
    number = F.coalesce(T.to_int(U.query_param(F.col("url"), "page")), F.lit(1))
    pages = _table(spark, sf_dir, "pages").withColumn("n", number)
    return _segments(pages.select("page_id", "n", "url"), ["page_id", "n"]).select(
        "page_id", U.listing_url(F.col("seg"), F.col("n")).alias("listing"))


@register("max_page", f"""
    SELECT {SQL_HOST} AS host, max(CAST({SQL_SEGMENT} AS BIGINT)) AS max_page FROM pages
    WHERE regexp_full_match({SQL_SEGMENT}, '[+-]?[0-9]+') GROUP BY 1""")
def max_page(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("url", U.host(F.col("url")).alias("host"))
    return L.max_page(_segments(pages, ["host"]), ["host"], "seg")


@register("listing_frontier", f"""
    WITH n AS (SELECT {SQL_HOST} AS host, count(*) FILTER ({SQL_PARAM.format('page')} <> '') AS n FROM pages GROUP BY 1)
    SELECT host, unnest(range(1, n + 1)) AS page FROM n""")
def listing_frontier(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    counts = pages.groupBy(U.host(F.col("url")).alias("host")).agg(
        F.count_if(U.query_param(F.col("url"), "page") != "").alias("n"))
    return L.listing_frontier(counts, "n")


@register("extract_links", f"SELECT page_id, unnest({SQL_HREFS}) AS href FROM pages")
def extract_links(spark, sf_dir):
    return L.extract_links(_table(spark, sf_dir, "pages"), ["page_id"])


@register("absolute_links", f"SELECT page_id, 'https://' || {SQL_HOST} || '/' || unnest({SQL_HREFS}) AS link FROM pages")
def absolute_links(spark, sf_dir):
    return _absolute(_table(spark, sf_dir, "pages"))


@register("pages_without_link", f"""
    SELECT page_id, url FROM pages WHERE len(list_filter({SQL_HREFS}, lambda h: h LIKE '%.')) = 0""")
def pages_without_link(spark, sf_dir):
    ending = F.filter(H.hrefs(F.col("html")), lambda h: h.endswith("."))
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.get(ending, F.lit(0)).alias("href"))
    return L.has_link(pages)[1].drop("href")


@register("allowed_host", f"SELECT page_id, url FROM pages WHERE {SQL_HOST} IN {tuple(HOSTS)}")
def allowed_host(spark, sf_dir):
    return L.on_allowed_host(_table(spark, sf_dir, "pages").select("page_id", "url"), "url", HOSTS)


@register("distinct_links", f"SELECT DISTINCT unnest({SQL_HREFS}) AS link FROM pages")
def distinct_links(spark, sf_dir):
    return L.distinct_links(L.extract_links(_table(spark, sf_dir, "pages"), [], out="link"))


@register("union_links", f"""
    SELECT unnest({SQL_HREFS}) AS link FROM pages UNION SELECT url FROM pages""")
def union_links(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return L.union_links([L.extract_links(pages, [], out="link"), pages.select(F.col("url").alias("link"))])


@register("crawl_counts", f"""
    WITH l AS (SELECT {SQL_HOST} AS host, unnest({SQL_HREFS}) AS link FROM pages)
    SELECT count(DISTINCT host) AS n_listings, count(*) AS n_links, count(DISTINCT link) AS n_unique FROM l""")
def crawl_counts(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").withColumn("host", U.host(F.col("url")))
    return L.crawl_counts(L.extract_links(pages, ["host"], out="link"), "host")


@register("crawl", f"""
    SELECT DISTINCT 'https://juris.bundesgerichtshof.de/cgi-bin/rechtsprechung/' || unnest({SQL_HREFS}) AS link
    FROM pages""")
def crawl_links(spark, sf_dir):
    # navigation items as table rows of a wanted chamber, their anchors as document anchors
    rows = F.replace(F.col("html"), F.lit("<li>"), F.lit("<tr><td> X. Zivilsenat\n</td><td>"))
    listing = F.replace(rows, F.lit("<a href"), F.lit("<a type='application/pdf' href"))
    # all hosts are looked at here; the list of allowed ones has a query of its own
    own = F.concat(F.lit(f"https://{SITE_HOST}/"), F.col("url"))
    return crawl(_table(spark, sf_dir, "pages").select(own.alias("url"), listing.alias("html"))).links


# text and pages

@register("trim_space", "SELECT doc_id, md5(trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) AS digest FROM documents")
def trim_space(spark, sf_dir):
    padded = F.concat(F.lit(" \t\f\n "), F.col("text"), F.lit(" \r\n"))
    return _texts(spark, sf_dir).select("doc_id", _hex(T.trim_space(padded)).alias("digest"))


@register("filter_in", "SELECT doc_id, source FROM documents WHERE source IN ('src3', 'src7')")
def filter_in(spark, sf_dir):
    padded = _table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" "), F.col("source"), F.lit("\t\n")).alias("source"))
    return L.filter_in(padded, "source", ["src3", "src7"]).withColumn("source", T.trim_space(F.col("source")))


def _broken_text(breaks: str = "\f"):
    """Lines stand in for pages."""
    return F.replace(F.col("text"), F.lit("\n"), F.lit(breaks))


@register("split_pages", """
    SELECT doc_id, unnest(generate_series(0, len(p) - 1)) AS pos, md5(unnest(p)) AS digest
    FROM (SELECT doc_id, string_split(replace(text, chr(10), chr(12) || chr(12)), chr(12)) AS p FROM documents)""")
def split_pages(spark, sf_dir):
    parts = T.split_pages(_broken_text("\f\f"))
    return _texts(spark, sf_dir).select("doc_id", F.posexplode(parts).alias("pos", "part")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), _hex("part").alias("digest"))


@register("number_pages", f"SELECT doc_id, page, md5(text) AS digest FROM (SELECT doc_id, {SQL_LINES} FROM documents)")
def number_pages(spark, sf_dir):
    # each second part is empty and has to be dropped
    docs = _texts(spark, sf_dir).select("doc_id", _broken_text("\f\f").alias("text"))
    return P.number_pages(docs, ["doc_id"]).select(
        "doc_id", F.col("page").cast("long").alias("page"), _hex("text").alias("digest"))


@register("number_page_rows", """
    SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS page
    FROM conversations WHERE role <> 'user' AND length(text) > 0""")
def number_page_rows(spark, sf_dir):
    blanked = _table(spark, sf_dir, "conversations").withColumn(
        "text", F.when(F.col("role") == "user", F.lit("")).otherwise(F.col("text")))
    return P.number_page_rows(blanked, "conv_id", "turn", width=2).select(
        "conv_id", "turn", "role", F.col("page").cast("long").alias("page"))


def _turn_pages(spark, sf_dir):
    return _texts(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("document_id"), (F.col("turn") + 1).alias("page"), "text")


def _flat(pages_col: str):
    item = lambda p: F.concat(p["page"].cast("string"), F.lit(":"), F.md5(p["text"]))
    return F.array_join(F.transform(pages_col, item), ",")


SQL_FLAT = "string_agg((turn + 1) || ':' || md5(text), ',' ORDER BY turn)"


@register("collect_pages", f"""
    SELECT conv_id AS document_id, turn // 4 AS part, count(*) AS n_pages, {SQL_FLAT} AS pages
    FROM conversations GROUP BY 1, 2""")
def collect_pages(spark, sf_dir):
    nested = P.collect_pages(_turn_pages(spark, sf_dir), "document_id", ["text"], pages_per_part=4)
    return nested.select("document_id", F.col("part").cast("long").alias("part"),
                         F.size("pages").cast("long").alias("n_pages"), _flat("pages").alias("pages"))


@register("document_with_pages", f"""
    WITH p AS (SELECT conv_id, turn // 4 AS part, count(*) AS n_pages, {SQL_FLAT} AS pages
               FROM conversations GROUP BY 1, 2)
    SELECT doc_id AS id, quality, coalesce(part, 0) AS part, coalesce(n_pages, 0) AS n_pages, coalesce(pages, '') AS pages
    FROM labels LEFT JOIN p ON conv_id = doc_id""")
def document_with_pages(spark, sf_dir):
    documents = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    nested = P.document_with_pages(documents, _turn_pages(spark, sf_dir), ["text"], pages_per_part=4)
    return nested.select("id", "quality", F.col("part").cast("long").alias("part"),
                         F.size("pages").cast("long").alias("n_pages"), _flat("pages").alias("pages"))


@register("pages_in_order", "SELECT conv_id AS document_id, turn + 1 AS page, md5(text) AS digest FROM conversations ORDER BY 1, 2")
def pages_in_order(spark, sf_dir):
    return P.pages_in_order(_turn_pages(spark, sf_dir).select("document_id", "page", _hex("text").alias("digest")))


@register("document_ids", f"SELECT doc_id, {SQL_UUID.format('doc_id::VARCHAR')} AS id FROM documents")
def document_ids(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", I.document_id(F.col("doc_id")).alias("id"))


@register("record_id", "SELECT conv_id AS document_id, turn + 1 AS page, role, conv_id AS id_document, turn + 1 AS id_page FROM conversations")
def record_id(spark, sf_dir):
    pages = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("document_id"), (F.col("turn") + 1).alias("page"), "role")
    keyed = pages.withColumn("id", I.record_id(F.col("document_id"), F.col("page")))
    return keyed.select("document_id", "page", "role", F.col("id.document_id").alias("id_document"),
                        F.col("id.page").alias("id_page"))


# lookups and checks

def _paths(spark, sf_dir, table, col):
    return _table(spark, sf_dir, table).select(_doc_path(col).alias("path"))


@register("pending_links", """
    SELECT 'doc/' || doc_id AS path FROM documents
    WHERE NOT (doc_id IN (SELECT doc_id FROM labels) AND doc_id IN (SELECT conv_id FROM conversations))""")
def pending_links(spark, sf_dir):
    return lookup.pending_links(
        _paths(spark, sf_dir, "documents", "doc_id"), _paths(spark, sf_dir, "labels", "doc_id"),
        _paths(spark, sf_dir, "conversations", "conv_id"))


@register("should_process", """
    SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS landed,
           doc_id IN (SELECT conv_id FROM conversations) AS known,
           NOT (doc_id IN (SELECT doc_id FROM labels) AND doc_id IN (SELECT conv_id FROM conversations)) AS todo
    FROM documents""")
def should_process(spark, sf_dir):
    landed = _table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("landed", F.lit(True))
    known = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")).distinct().withColumn(
        "known", F.lit(True))
    both = _table(spark, sf_dir, "documents").select("doc_id").join(landed, "doc_id", "left").join(known, "doc_id", "left")
    return both.select(
        "doc_id", F.coalesce("landed", F.lit(False)).alias("landed"), F.coalesce("known", F.lit(False)).alias("known"),
        lookup.should_process(F.col("landed"), F.col("known")).alias("todo"))


@register("lookup_by_path", "SELECT doc_id, source FROM documents WHERE source = 'src7'")
def lookup_by_path(spark, sf_dir):
    return lookup.by_file_path(_table(spark, sf_dir, "documents").select("doc_id", "source"), "src7", "source")


@register("lookup_ids", f"""
    SELECT 'doc/' || d.doc_id AS file_path,
           CASE WHEN l.doc_id IS NOT NULL THEN {SQL_UUID.format("'doc/' || d.doc_id")} END AS id
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def lookup_ids(spark, sf_dir):
    stored = _paths(spark, sf_dir, "labels", "doc_id").select(
        F.col("path").alias("file_path"), I.document_id(F.col("path")).alias("id"))
    asked = _paths(spark, sf_dir, "documents", "doc_id").withColumnRenamed("path", "file_path")
    return lookup.lookup_ids(asked, stored)


@register("lookup_ids_exactly_one", """
    WITH one AS (SELECT text, min(doc_id) AS id FROM documents GROUP BY text HAVING count(*) = 1)
    SELECT d.doc_id, one.id FROM documents d LEFT JOIN one ON d.text = one.text""")
def lookup_ids_exactly_one(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    stored = docs.select("text", F.col("doc_id").alias("id"))
    return lookup.lookup_ids(docs.select("doc_id", "text"), stored, "exactly_one", "text").select("doc_id", "id")


@register("orphan_pages", """
    SELECT conv_id AS document_id, turn + 1 AS page FROM conversations
    WHERE conv_id NOT IN (SELECT doc_id FROM labels)""")
def orphan_pages(spark, sf_dir):
    pages = _turn_pages(spark, sf_dir).select("document_id", "page")
    return checks.orphan_pages(pages, _table(spark, sf_dir, "labels"), id_col="doc_id")


def _document_rules(spark, sf_dir):
    return checks.Constraints(
        rows={"n_chars_positive": F.col("n_chars") > 0, "text_not_empty": F.length("text") > 0,
              "n_chars_bounded": F.col("n_chars") < 20000},
        unique={"text_unique": ["text"]},
        references={"labelled": ("doc_id", _table(spark, sf_dir, "labels"), "doc_id")})


@register("constraint_violations", """
    SELECT 'n_chars_positive' AS rule, count(*) FILTER (NOT n_chars > 0) AS n_rows FROM documents
    UNION ALL SELECT 'text_not_empty', count(*) FILTER (NOT length(text) > 0) FROM documents
    UNION ALL SELECT 'n_chars_bounded', count(*) FILTER (NOT n_chars < 20000) FROM documents
    UNION ALL SELECT 'text_unique', CAST(coalesce(sum(n), 0) AS BIGINT)
              FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)
    UNION ALL SELECT 'labelled', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def constraint_violations(spark, sf_dir):
    return checks.count_violations(_table(spark, sf_dir, "documents"), _document_rules(spark, sf_dir))


@register("check_constraints", """
    SELECT doc_id, concat_ws(',', CASE WHEN NOT n_chars > 0 THEN 'n_chars_positive' END,
           CASE WHEN NOT length(text) > 0 THEN 'text_not_empty' END,
           CASE WHEN NOT n_chars < 20000 THEN 'n_chars_bounded' END,
           CASE WHEN text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1) THEN 'text_unique' END,
           CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'labelled' END) AS rules
    FROM documents""")
def check_constraints(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    valid, broken = checks.check_constraints(docs, _document_rules(spark, sf_dir))
    return valid.select("doc_id", F.lit("").alias("rules")).unionByName(
        broken.select("doc_id", F.array_join("rules", ",").alias("rules")))


@register("embedding_dim_check", "SELECT vec_id, len(embedding) = 64 AS ok FROM embeddings")
def embedding_dim_check(spark, sf_dir):
    good, bad = checks.check_dim(_table(spark, sf_dir, "embeddings"), "embedding", 64)
    return good.select("vec_id", F.lit(True).alias("ok")).unionByName(bad.select("vec_id", F.lit(False).alias("ok")))


# sinks

@register("save_blobs_roundtrip", """
    SELECT 'judgements/' || lang || '/' || source || '/' || doc_id || '.txt' AS path,
           md5(CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'v2: ' || text ELSE text END) AS digest
    FROM documents""")
def save_blobs_roundtrip(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.lit("judgements"), "lang", "source", F.concat(F.col("doc_id"), F.lit(".txt")))
    root = scratch_dir(spark, "blobs")
    save_blobs(docs.select(path.alias("path"), F.col("text").cast("binary").alias("content")), root, 0)
    again = docs.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        path.alias("path"), F.concat(F.lit("v2: "), "text").cast("binary").alias("content"))
    save_blobs(again, root, 1)
    return read_saved(spark, root).select("path", _hex("content").alias("digest"))


@register("upsert_documents", f"""
    WITH old AS (SELECT doc_id FROM labels), new AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT {SQL_UUID.format("'doc/' || coalesce(doc_id, conv_id)")} AS id, 'doc/' || coalesce(doc_id, conv_id) AS file_path,
           CASE WHEN doc_id IS NULL THEN {SQL_NOW.format(2)} ELSE {SQL_NOW.format(1)} END AS created_at,
           CASE WHEN conv_id IS NULL THEN {SQL_NOW.format(1)} ELSE {SQL_NOW.format(2)} END AS updated_at
    FROM old FULL JOIN new ON doc_id = conv_id""")
def upsert_documents(spark, sf_dir):
    first = _paths(spark, sf_dir, "labels", "doc_id").withColumnRenamed("path", "file_path")
    second = _paths(spark, sf_dir, "conversations", "conv_id").withColumnRenamed("path", "file_path")
    old = upsert.with_defaults(first, I.document_id(F.col("file_path")), _instant(1))
    merged = upsert.upsert_documents(old, second, _instant(2))
    return merged.select("id", "file_path", _shown("created_at"), _shown("updated_at"))


def _two_page_batches(spark, sf_dir):
    """Turns of conversations, then lines of documents, under the same document numbers."""
    first = _turn_pages(spark, sf_dir).withColumn("document_id", F.col("document_id").cast("string"))
    docs = _texts(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("document_id"), _broken_text().alias("text"))
    second = P.number_pages(docs, ["document_id"]).withColumn("page", F.col("page").cast("long"))
    return first, second


def _upserted_pages(spark, sf_dir, mode):
    first, second = _two_page_batches(spark, sf_dir)
    old = upsert.with_defaults(first, I.page_id(F.col("document_id"), F.col("page")), _instant(1))
    merged = upsert.upsert_pages(old, second, _instant(2), mode)
    return merged.select("id", "document_id", "page", _hex("text").alias("digest"),
                         _shown("created_at"), _shown("updated_at"))


def _sql_upserted_pages(first: str, second: str) -> str:
    key = "coalesce(o.document_id, n.document_id) || '/' || coalesce(o.page, n.page)"
    return f"""
    WITH o AS (SELECT CAST(conv_id AS VARCHAR) AS document_id, turn + 1 AS page, text FROM conversations),
         n AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, {SQL_LINES} FROM documents)
    SELECT {SQL_UUID.format(key)} AS id, coalesce(o.document_id, n.document_id) AS document_id,
           coalesce(o.page, n.page) AS page, md5(coalesce({first}.text, {second}.text)) AS digest,
           CASE WHEN o.page IS NULL THEN {SQL_NOW.format(2)} ELSE {SQL_NOW.format(1)} END AS created_at,
           CASE WHEN n.page IS NULL THEN {SQL_NOW.format(1)} ELSE {SQL_NOW.format(2)} END AS updated_at
    FROM o FULL JOIN n ON o.document_id = n.document_id AND o.page = n.page"""


@register("upsert_pages_keep_first", _sql_upserted_pages("o", "n"))
def upsert_pages_keep_first(spark, sf_dir):
    return _upserted_pages(spark, sf_dir, "keep_first")


@register("upsert_pages_replace", _sql_upserted_pages("n", "o"))
def upsert_pages_replace(spark, sf_dir):
    return _upserted_pages(spark, sf_dir, "replace")


@register("insert_strict_conflicts", """
    SELECT 'doc/' || conv_id AS path FROM conversations GROUP BY conv_id
    HAVING count(*) > 1 OR conv_id IN (SELECT doc_id FROM labels)""")
def insert_strict_conflicts(spark, sf_dir):
    return upsert.strict_conflicts(
        _paths(spark, sf_dir, "labels", "doc_id"), _paths(spark, sf_dir, "conversations", "conv_id"), ["path"])


@register("commit_batch", f"""
    WITH o AS (SELECT conv_id AS d, turn + 1 AS page, text FROM conversations),
         n AS (SELECT doc_id AS d, {SQL_LINES} FROM documents),
         p AS (SELECT coalesce(o.d, n.d) AS d, coalesce(o.page, n.page) AS page, coalesce(o.text, n.text) AS text
               FROM o FULL JOIN n ON o.d = n.d AND o.page = n.page)
    SELECT 'doc/' || d AS file_path, page, md5(text) AS digest, 16 AS width FROM p""")
def commit_batch(spark, sf_dir):
    store = PageStore(spark, scratch_dir(spark, "store"))
    for number, pages in enumerate(_two_page_batches(spark, sf_dir)):
        pages = pages.withColumn("file_path", F.concat(F.lit("doc/"), "document_id")).drop("document_id")
        pages = hash_embed(pages, "text", 16)
        for _ in range(2):  # a repeated batch changes nothing
            store.commit(pages.select("file_path"), pages, number, _instant(number + 1))
    documents, pages = store.snapshot()
    return pages.join(documents.withColumnRenamed("id", "document_id"), "document_id").select(
        "file_path", F.col("page").cast("long").alias("page"), _hex("text").alias("digest"),
        F.size("embeddings").alias("width"))


def _checked_pages(spark, sf_dir, batch: int):
    """Every line of every document as a page, with rows planted to break each rule: empty paths, page 0, empty lines,
    a short vector, a vector of NaN, a repeated (path, page), pages of paths offered as no document. Batch 1 offers
    first lines again, in strict mode."""
    docs = _table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "text"))
    d, line = F.col("doc_id"), F.col("i") + 1
    path = F.when(d % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("doc/"), d.cast("string")))
    vector = (F.when(d % 11 == 0, F.array_repeat(F.lit(1.0).cast("float"), 15))
              .when((d % 7 == 0) & (line == 2), F.array_repeat(F.lit(float("nan")).cast("float"), 16))
              .otherwise(F.array_repeat(line.cast("float"), 16)))
    page = F.when((d % 5 == 0) & (line == 1), 0).otherwise(line).cast("long")
    rows = lines.select("doc_id", path.alias("file_path"), page.alias("page"), "text", vector.alias("embeddings"))
    if batch:
        return rows.where((d % 23 == 0) & (F.col("page") <= 1))
    again = docs.where(d % 17 == 0).select("doc_id", path.alias("file_path"), F.lit(1).cast("long").alias("page"),
                                           F.lit("again").alias("text"), F.array_repeat(F.lit(1.0).cast("float"), 16).alias("embeddings"))
    return rows.unionByName(again)


SQL_CHECKED = """
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    r AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '' ELSE 'doc/' || doc_id END AS file_path,
                 CAST(CASE WHEN doc_id % 5 = 0 AND i = 1 THEN 0 ELSE i END AS BIGINT) AS page, text,
                 CASE WHEN doc_id % 11 = 0 THEN 15 ELSE 16 END AS width, doc_id % 11 <> 0 AND doc_id % 7 = 0 AND i = 2 AS nan FROM l),
    p0 AS (SELECT * FROM r UNION ALL
           SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '' ELSE 'doc/' || doc_id END, 1, 'again', 16, false FROM documents WHERE doc_id % 17 = 0),
    p1 AS (SELECT * FROM r WHERE doc_id % 23 = 0 AND page <= 1),
    o0 AS (SELECT DISTINCT file_path FROM p0 WHERE doc_id % 19 <> 0),
    stored AS (SELECT file_path FROM o0 WHERE length(file_path) > 0),
    b AS (SELECT 0 AS batch, *, count(*) OVER (PARTITION BY file_path, page) AS n,
                 file_path IN (SELECT file_path FROM o0) AS there, false AS stored FROM p0
          UNION ALL
          SELECT 1, *, count(*) OVER (PARTITION BY file_path, page), true, file_path IN (SELECT file_path FROM stored) FROM p1),
    x AS (SELECT batch, file_path, page, list_sort(list_filter([
            CASE WHEN NOT coalesce(length(file_path) > 0, false) THEN 'file_path_not_empty' END,
            CASE WHEN NOT coalesce(page > 0, false) THEN 'page_positive' END,
            CASE WHEN NOT coalesce(length(text) > 0, false) THEN 'text_not_empty' END,
            CASE WHEN width <> 16 OR nan THEN 'embedding_width' END,
            CASE WHEN n > 1 THEN 'document_page_unique' END,
            CASE WHEN NOT there THEN 'document_exists' END,
            CASE WHEN stored THEN 'file_path_unique' END], lambda v: v IS NOT NULL)) AS rules FROM b)
    SELECT batch, file_path, page, array_to_string(rules, ',') AS rules FROM x WHERE len(rules) > 0"""


@register("commit_rejects", SQL_CHECKED)
def commit_rejects(spark, sf_dir):
    """A checked commit of every line of the documents, then a strict one; the rows each rejects and the rules they break."""
    store = PageStore(spark, scratch_dir(spark, "checked"))
    out = []
    for batch, mode in ((0, "keep_first"), (1, "strict")):
        pages = settle(_checked_pages(spark, sf_dir, batch), "checked")
        offered = pages.where((F.col("doc_id") % 19 != 0) | F.lit(batch == 1)).select("file_path")
        _, rejects = store.commit_checked(offered, pages.drop("doc_id"), batch, _instant(batch + 1), mode, width=16)
        out.append(rejects.select(F.lit(batch).alias("batch"), "file_path", "page", F.array_join("rules", ",").alias("rules")))
    return out[0].unionByName(out[1])


# search

@register("analyze_tokens", f"SELECT token, count(*) AS n FROM (SELECT unnest({SQL_WORDS}) AS token FROM documents) GROUP BY token")
def analyze_tokens(spark, sf_dir):
    tokens = search.analyze_tokens(_texts(spark, sf_dir), [])
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@register("analyze_tokens_stem_map", f"""
    WITH s(token, stem) AS (VALUES {', '.join(str(pair) for pair in STEMS)}),
         t AS (SELECT doc_id, unnest({SQL_WORDS}) AS token FROM documents)
    SELECT coalesce(stem, t.token) AS token, count(*) AS n FROM t LEFT JOIN s ON t.token = s.token GROUP BY 1""")
def analyze_tokens_stem_map(spark, sf_dir):
    stems = small_frame(spark, STEMS, ["token", "stem"])
    tokens = search.analyze_tokens(_texts(spark, sf_dir), [], stem_map=stems)
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@register("text_stats", f"SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({SQL_WORDS})) AS term FROM documents) GROUP BY term")
def text_stats(spark, sf_dir):
    return search.term_stats(_texts(spark, sf_dir))


@register("length_stats", f"SELECT count(*) AS n_pages, CAST(sum(len({SQL_WORDS})) AS BIGINT) AS n_tokens, round(avg(len({SQL_WORDS})), 6) AS avg_len FROM documents")
def length_stats(spark, sf_dir):
    return search.length_stats(_texts(spark, sf_dir)).withColumn("avg_len", F.round("avg_len", 6))


def _sql_bm25(queries: str, k: int, words: str = SQL_WORDS) -> str:
    return f"""
    WITH q AS ({queries}),
         w AS (SELECT doc_id, {words} AS words FROM documents),
         s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(words)) AS al FROM w),
         tf AS (SELECT doc_id, len, term, CAST(count(*) AS DOUBLE) AS tf
                FROM (SELECT doc_id, len(words) AS len, unnest(words) AS term FROM w)
                WHERE term IN (SELECT term FROM q) GROUP BY ALL),
         df AS (SELECT term, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY term),
         sc AS (SELECT query_id, doc_id,
                       sum(ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
                           / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / al))) AS score
                FROM tf JOIN df USING (term) JOIN q USING (term), s GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM sc)
    SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


def _rounded(df, col):
    return df.withColumns({col: F.round(col, 6), "rank": F.col("rank").cast("long")})


SQL_TERMS = "SELECT 'q' AS query_id, unnest(['der', 'die', 'und']) AS term"


@register("bm25_topk", _sql_bm25(SQL_TERMS, 10))
def bm25_topk(spark, sf_dir):
    docs = _texts(spark, sf_dir)
    return _rounded(search.bm25_topk(docs, {"q": TERMS}, 10, "doc_id"), "score")


@register("bm25_many_queries", _sql_bm25(f"SELECT DISTINCT item_id AS query_id, unnest({SQL_WORDS}) AS term FROM benchmark", 5))
def bm25_many_queries(spark, sf_dir):
    queries = search.analyze_tokens(_table(spark, sf_dir, "benchmark"), ["item_id"], out="term")
    queries = queries.withColumnRenamed("item_id", "query_id")
    return _rounded(search.bm25_topk(_texts(spark, sf_dir), queries, 5, "doc_id"), "score")


@register("bm25_blocks", _sql_bm25(f"SELECT DISTINCT item_id AS query_id, unnest({SQL_WORDS}) AS term FROM benchmark", 5))
def bm25_blocks(spark, sf_dir):
    queries = search.analyze_tokens(_table(spark, sf_dir, "benchmark"), ["item_id"], out="term")
    queries = queries.withColumnRenamed("item_id", "query_id")
    found = search.bm25_topk(_texts(spark, sf_dir), queries, 5, "doc_id", inline_terms=0, broadcast_pairs=0, query_rows=16, page_rows=512)
    return _rounded(found, "score")


@register("highlight", f"""
    WITH best AS ({_sql_bm25(SQL_TERMS, 10)})
    SELECT best.doc_id, array_to_string(list_transform(string_split_regex(text, '\\s+'),
           lambda w: CASE WHEN w IN {tuple(TERMS)} THEN '<b>' || w || '</b>' ELSE w END), ' ') AS marked
    FROM best JOIN documents USING (doc_id)""")
def highlight(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    best = search.bm25_topk(docs, {"q": TERMS}, 10, "doc_id").select("doc_id")
    # stored, so that Spark knows that these are few and leaves the texts where they are
    marked = docs.join(settle(best, "best"), "doc_id").select("doc_id", T.highlight(F.col("text"), TERMS).alias("marked"))
    return marked.withColumn("marked", F.regexp_replace("marked", r"\s+", " "))


# stemmed search: the S stemmer's rules in SQL (T.S_RULES), on the same words
def _sql_stem(w: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({w}, '{p}') THEN regexp_replace({w}, '{p}', '\\1{e}')" for p, e in T.S_RULES)
    return f"CASE {cases} ELSE {w} END"


def _stemmed(words: list[str]) -> list[str]:
    """The stems of a few fixed words, written into SQL as values."""
    out = []
    for w in words:
        for pattern, ending in T.S_RULES:
            if re.search(pattern, w):
                w = re.sub(pattern, lambda m: m.group(1) + ending, w)
                break
        out.append(w)
    return sorted(set(out))


SQL_STEMMED_WORDS = f"list_transform({SQL_WORDS}, lambda x: {_sql_stem('x')})"
STEM_TERMS = ["the", "ores", "shes"]
SQL_STEM_TERMS = f"SELECT DISTINCT 'q' AS query_id, {_sql_stem('t')} AS term FROM (SELECT unnest({STEM_TERMS}) AS t)"


@register("bm25_topk_stem_map", _sql_bm25(SQL_STEM_TERMS, 10, SQL_STEMMED_WORDS))
def bm25_topk_stem_map(spark, sf_dir):
    """"thes", "ores", "shes" of the texts count as "the", "ore", "she": one tf, one df, one saturation a stem."""
    return _rounded(search.bm25_topk(_texts(spark, sf_dir), {"q": STEM_TERMS}, 10, "doc_id", stemmer=T.s_stem), "score")


@register("bm25_stem_many_queries", _sql_bm25(
    f"SELECT DISTINCT item_id AS query_id, unnest({SQL_STEMMED_WORDS}) AS term FROM benchmark", 5, SQL_STEMMED_WORDS))
def bm25_stem_many_queries(spark, sf_dir):
    """Every benchmark item as a query, stemmed like the pages; the broadcast route."""
    queries = search.analyze_tokens(_table(spark, sf_dir, "benchmark"), ["item_id"], out="term").withColumnRenamed("item_id", "query_id")
    return _rounded(search.bm25_topk(_texts(spark, sf_dir), queries, 5, "doc_id", stemmer=T.s_stem), "score")


@register("highlight_stem_map", f"""
    WITH best AS ({_sql_bm25(SQL_STEM_TERMS, 10, SQL_STEMMED_WORDS)})
    SELECT best.doc_id, array_to_string(list_transform(string_split_regex(text, '\\s+'),
           lambda w: CASE WHEN {_sql_stem('w')} IN {tuple(_stemmed(STEM_TERMS))} THEN '<b>' || w || '</b>' ELSE w END), ' ') AS marked
    FROM best JOIN documents USING (doc_id)""")
def highlight_stem_map(spark, sf_dir):
    """The ten best pages of the stemmed search, every form of an asked stem marked: the forms are those of these pages."""
    docs = _table(spark, sf_dir, "documents")
    best = settle(search.bm25_topk(docs, {"q": STEM_TERMS}, 10, "doc_id", stemmer=T.s_stem).select("doc_id"), "best")
    texts = docs.join(best, "doc_id").select("doc_id", "text")
    asked = small_frame(spark, [(t,) for t in STEM_TERMS], ["t"]).select(T.s_stem(F.col("t")).alias("s"))
    stems = sorted({r["s"] for r in asked.collect()})
    vocabulary = texts.select(F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("w")).distinct()
    forms = [r["w"] for r in vocabulary.where(T.s_stem(F.col("w")).isin(stems)).collect()]
    marked = texts.select("doc_id", T.highlight(F.col("text"), forms).alias("marked"))
    return marked.withColumn("marked", F.regexp_replace("marked", r"\s+", " "))


def _sql_knn(queries: str) -> str:
    return f"""
    WITH q AS ({queries}),
         s AS (SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], vector) AS sim FROM embeddings, q),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, vec_id) AS rank FROM s
               WHERE query_id <> vec_id OR NOT {{self}})
    SELECT query_id, vec_id, round(sim, 6) AS similarity, rank FROM r WHERE rank <= 5"""


SQL_CENTROIDS = """
    SELECT label AS query_id, list(mean ORDER BY i) AS vector
    FROM (SELECT label, i, avg(x::DOUBLE) AS mean
          FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2)
    GROUP BY 1"""


def _centroids(vectors):
    """The mean vector of each label; element by element, so that only sums are shuffled."""
    cells = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    rows = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "mean"))).alias("m"))
    return rows.select(F.col("label").alias("query_id"), F.col("m.mean").alias("vector"))


@register("knn_cosine", _sql_knn(SQL_CENTROIDS).format(self="FALSE"))
def knn(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return _rounded(knn_cosine(vectors, _centroids(vectors), 5, "vec_id", "embedding"), "similarity")


@register("knn_cosine_blocks", _sql_knn(SQL_CENTROIDS).format(self="FALSE"))
def knn_blocks(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    found = knn_cosine(vectors, _centroids(vectors), 5, "vec_id", "embedding", method="blocks", broadcast_queries=2, block_rows=64)
    return _rounded(found, "similarity")


@register("knn_cosine_all", _sql_knn("SELECT vec_id AS query_id, embedding::DOUBLE[] AS vector FROM embeddings").format(self="TRUE"))
def knn_all(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _rounded(knn_cosine(vectors, queries, 5, "vec_id", "embedding", exclude_self=True), "similarity")


@register("knn_lsh")
def knn_lsh(spark, sf_dir):
    """Every vector whose id is divisible by 50 asks for its 10 nearest others, through the index; recall in tests/test_lsh.py."""
    vectors = _table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _rounded(lsh.knn_lsh(vectors, queries, 10, "vec_id", "embedding", exclude_self=True), "similarity")


# embedding, extraction, ingest

SQL_BUCKET = "('0x' || substr(md5(w), 1, 8))::BIGINT % {}"


def _sql_buckets(width: int) -> str:
    return f"""
    SELECT doc_id, {SQL_BUCKET.format(width)} AS bucket, count(*) AS n
    FROM (SELECT doc_id, unnest({SQL_WORDS}) AS w FROM documents) GROUP BY 1, 2"""


@register("embed_hashed", _sql_buckets(64))
def embed_hashed(spark, sf_dir):
    terms = hashed_terms(_texts(spark, sf_dir), ["doc_id"], "text", 64)
    return terms.select("doc_id", F.col("bucket").cast("long").alias("bucket"), F.col("n").cast("long").alias("n"))


def counting_embedder():
    """A stand-in for a model: counts of tokens by length, up to 15."""
    def run(texts):
        return [np.bincount([min(len(word), 15) for word in text.split()], minlength=16) for text in texts]
    return run


@register("embed_udf", f"""
    SELECT doc_id, least(length(w), 15) AS bucket, count(*) AS n
    FROM (SELECT doc_id, unnest({SQL_WORDS}) AS w FROM documents) GROUP BY 1, 2""")
def embed_udf(spark, sf_dir):
    docs = _texts(spark, sf_dir).select("doc_id", "text")
    done = embed(docs, "text", counting_embedder, distinct=True)
    return done.select("doc_id", F.posexplode("embeddings").alias("bucket", "n")).where(F.col("n") > 0).select(
        "doc_id", F.col("bucket").cast("long").alias("bucket"), F.col("n").cast("long").alias("n"))


@register("extract_text", """
    SELECT doc_id, CASE WHEN lang <> 'es' THEN md5(text) END AS digest, lang = 'es' AS failed FROM documents""")
def extracted(spark, sf_dir):
    # Spanish documents are stored in an encoding the extractor refuses
    blobs = _table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "es", F.encode("text", "UTF-16"))
        .otherwise(F.encode("text", "UTF-8")).alias("content"))
    texts = extract_text(blobs, lambda content: content.decode("utf-8"))
    return texts.select("doc_id", _hex("text").alias("digest"), F.col("error").isNotNull().alias("failed"))


def _page_vectors(spark, sf_dir, width):
    docs = _texts(spark, sf_dir).select("doc_id", _broken_text().alias("text"))
    pages = hash_embed(P.number_pages(docs, ["doc_id"]), "text", width)
    return pages.withColumn("id", F.concat_ws("/", "doc_id", "page"))


@register("nearest_pages", f"""
    WITH t AS (
        SELECT 'p' AS kind, doc_id || '/' || page AS id, unnest({SQL_WORDS}) AS w FROM (SELECT doc_id, {SQL_LINES} FROM documents)
        UNION ALL SELECT 'q', CAST(item_id AS VARCHAR), unnest({SQL_WORDS}) FROM benchmark),
    c AS (SELECT kind, id, {SQL_BUCKET.format(64)} AS b, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY 1, 2, 3),
    v AS (SELECT kind, id, b, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY kind, id)) AS FLOAT) AS DOUBLE) AS x FROM c),
    u AS (SELECT kind, id, b, x / sqrt(sum(x * x) OVER (PARTITION BY kind, id)) AS x FROM v),
    s AS (SELECT q.id AS query_id, p.id AS id, sum(p.x * q.x) AS sim
          FROM u p JOIN u q ON p.b = q.b WHERE p.kind = 'p' AND q.kind = 'q' GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 9) DESC, id) AS rank FROM s)
    SELECT query_id, id, round(sim, 6) AS similarity, rank FROM r WHERE rank <= 5""")
def nearest_pages(spark, sf_dir):
    """Text to numbered pages to vectors to the pages nearest to each benchmark text."""
    asked = hash_embed(_table(spark, sf_dir, "benchmark"), "text", 64)
    queries = asked.select(F.col("item_id").cast("string").alias("query_id"), F.col("embeddings").alias("vector"))
    return _rounded(knn_cosine(_page_vectors(spark, sf_dir, 64), queries, 5), "similarity")


def _link():
    """Documents as links of the form the path rule expects."""
    return F.concat(
        F.lit("https://example.org/document.py?Gericht="), "lang", F.lit("&Datum="), "source", F.lit("&nr="), "doc_id",
        F.lit("&anz="), "n_chars", F.lit("&pos=1"))


SQL_PATH = "'judgements/' || lang || '/' || source || '/' || doc_id || '_' || n_chars || '_1.pdf'"


def _ingest(spark, sf_dir, **settings):
    docs = _texts(spark, sf_dir)
    landing = docs.select(_link().alias("url"), _broken_text("\f\f").cast("binary").alias("content"))
    return docs.select(_link().alias("link")), Ingest(
        spark, scratch_dir(spark, "ingest"), landing=landing, width=16, **settings)


def _stored_pages(ingest):
    documents, pages = ingest.store.snapshot()
    return pages.join(documents.withColumnRenamed("id", "document_id"), "document_id").select(
        "file_path", F.col("page").cast("long").alias("page"), _hex("text").alias("digest"))


@register("ingest_stream", f"SELECT {SQL_PATH} AS file_path, page, md5(text) AS digest FROM (SELECT lang, source, doc_id, n_chars, {SQL_LINES} FROM documents)")
def streamed(spark, sf_dir):
    links, ingest = _ingest(spark, sf_dir)
    arriving = scratch_dir(spark, "links")
    links.repartition(4).write.parquet(arriving)
    stream = stream_links(spark, arriving, files_per_trigger=2)
    ingest_stream(stream, ingest, scratch_dir(spark, "offsets"), _instant(1))
    return _stored_pages(ingest)


@register("rejects", f"""
    WITH l AS (SELECT *, url || '&nr=' || page_id AS link FROM pages)
    SELECT link, 'path' AS stage, '{INVALID_URL}' AS error, 7::BIGINT AS batch_id
    FROM l WHERE {SQL_PARAM.format('page')} = ''
    UNION ALL
    SELECT link, 'embed', 'too long', 7::BIGINT FROM l WHERE {SQL_PARAM.format('page')} <> '' AND length(html) > 1500""")
def rejects(spark, sf_dir):
    link = F.concat("url", F.lit("&nr="), "page_id")
    pages = _table(spark, sf_dir, "pages").select(link.alias("url"), F.col("html").alias("content"))
    ingest = Ingest(
        spark, scratch_dir(spark, "rejects"), landing=pages, embedder=strict_embedder, width=4,
        path_args={"keys": ["page", "nr"], "fmt": "listings/%s/%s.html"})
    ingest.run(pages.select(F.col("url").alias("link")), 7, _instant(1))
    return ingest.rejects()


def strict_embedder():
    """A stand-in for a model with a limit on the text length."""
    def run(texts):
        if any(len(text) > 1500 for text in texts):
            raise ValueError("too long")
        return [[1.0, 0.0, 0.0, 0.0] for _ in texts]
    return run


@register("rerun_is_noop", """
    SELECT count(*) AS n_documents, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_pages,
           0::BIGINT AS n_pending, 1::BIGINT AS version FROM documents""")
def rerun_is_noop(spark, sf_dir):
    links, ingest = _ingest(spark, sf_dir)
    ingest.run(links, 0, _instant(1))
    version = ingest.run(links, 0, _instant(2))
    documents, pages = ingest.store.snapshot()
    counts = [df.agg(F.count("*").alias("n")).scalar() for df in (documents, pages, ingest.pending(links))]
    return spark.range(1).select(
        counts[0].alias("n_documents"), counts[1].alias("n_pages"), counts[2].alias("n_pending"),
        F.lit(version).cast("long").alias("version"))
