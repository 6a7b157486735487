"""Stemmed search: the S stemmer's rules, one tf/df/saturation per stem, and the same results from all three routes."""

from pyspark.sql import functions as F

from folioline.functions import text as T
from folioline.operators import search

PAGES = [(1, "flies fly Fly tables table"), (2, "the thes shes she"), (3, "bus buses glass glasses status"),
         (4, "ties aies eies toes goes ies s"), (5, None), (None, "flies flies"), (6, "tables tables tables table")]


def test_rules(spark):
    words = ["flies", "ties", "aies", "eies", "toes", "goes", "thes", "tables", "bus", "glass", "status", "ies", "s", "es",
             "Tables", None]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(T.s_stem(F.col("w"))).collect()]
    assert got == ["fly", "ty", "aie", "eie", "toe", "goe", "the", "table", "bus", "glass", "status", "ie", "s", "e",
                   "Table", None]


def _rows(df):
    return sorted((r.query_id, r.id, round(r.score, 9), r["rank"]) for r in df.collect())


def test_forms_share_one_stem(spark):
    pages = spark.createDataFrame(PAGES, "id long, text string")
    stemmed = _rows(search.bm25_topk(pages, {"q": ["tables"], "r": ["fly", "thes"]}, 5, stemmer=T.s_stem))
    # the same as searching texts whose words were stemmed beforehand
    pre = pages.select("id", F.array_join(F.transform(T.tokens(F.col("text")), T.s_stem), " ").alias("text"))
    assert stemmed == _rows(search.bm25_topk(pre, {"q": ["table"], "r": ["fly", "the"]}, 5))
    by_page = {(q, i) for q, i, _, _ in stemmed}
    assert {("q", 1), ("q", 6), ("r", 1), ("r", 2)} <= by_page


def test_routes_agree(spark):
    pages = spark.createDataFrame(PAGES, "id long, text string")
    asked = spark.createDataFrame([("a", "tables"), ("a", "flies"), ("b", "goes"), ("b", "glasses"), ("c", "thes"), ("c", None)],
                                  "query_id string, term string")
    inline = _rows(search.bm25_topk(pages, {"a": ["tables", "flies"], "b": ["goes", "glasses"], "c": ["thes"]}, 3, stemmer=T.s_stem))
    broadcast = _rows(search.bm25_topk(pages, asked, 3, stemmer=T.s_stem, inline_terms=0))
    blocks = _rows(search.bm25_topk(pages, asked, 3, stemmer=T.s_stem, inline_terms=0, broadcast_pairs=0, query_rows=1, page_rows=2))
    assert inline == broadcast == blocks and len(inline) == 5
