"""The routes that a size chooses between give the same rows, and the judged cases of listings and keys."""

import pytest
from pyspark.sql import functions as F

from folioline.functions import html as H, urls as U
from folioline.operators.nearest import knn_cosine, knn_rejects
from folioline.operators.search import bm25_topk
from folioline.plans.crawl import next_listings
from folioline.sinks.store import PageStore
from folioline.operators.upsert import ConflictError

ROUTES = [{"inline_terms": 64}, {"inline_terms": 0}, {"inline_terms": 0, "broadcast_pairs": 0, "query_rows": 1, "page_rows": 2}]


@pytest.mark.parametrize("pages", [
    [("a", "x y"), ("b", "x y"), ("c", None), (None, "x x x"), ("d", ""), ("e", "y z z"), ("f", "x")],
    [("a", " "), ("b", ""), ("c", None)],
    [(None, "x")],
])
@pytest.mark.parametrize("id_type", ["string", "long"])
def test_bm25_routes(spark, rows, pages, id_type):
    table = spark.createDataFrame(pages, "id string, text string")
    if id_type == "long":
        table = table.withColumn("id", F.ascii("id").cast("long") + (1 << 60))
    queries = spark.createDataFrame([("p", "x"), ("p", "z"), ("q", "y"), (None, "x"), ("q", None), ("none", "w")], "query_id string, term string")
    found = []
    for route in ROUTES:
        best = bm25_topk(table, queries, 2, **route)
        found.append(rows(best.withColumn("score", F.round("score", 9))))
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("id_type", ["string", "long"])
def test_knn_routes(spark, rows, id_type):
    vectors = [("a", [1.0, 0.0]), ("b", [1.0, 0.0]), (None, [1.0, 0.0]), ("c", None), ("d", [0.0, 0.0]), ("e", [1.0]), ("f", [0.5, 0.5, 0.1]),
               ("g", [0.2, 0.9]), ("h", [float("nan"), 1.0])]
    table = spark.createDataFrame(vectors, "id string, embeddings array<double>")
    if id_type == "long":
        table = table.withColumn("id", F.ascii("id").cast("long") + (1 << 60))
    queries = spark.createDataFrame([("p", [1.0, 0.1]), (None, [1.0, 0.1]), ("q", [1.0]), ("r", [0.0, 1.0])], "query_id string, vector array<double>")
    found = [rows(knn_cosine(table, queries, 2, method=m, block_rows=2, broadcast_queries=b).withColumn("similarity", F.round("similarity", 9)))
             for m, b in (("broadcast", 10), ("blocks", 1))]
    assert found[0] == found[1] and len(found[0]) == 4


@pytest.mark.parametrize("method, most", [("broadcast", 10), ("blocks", 1)])
def test_knn_with_malformed_vectors(spark, rows, method, most):
    vectors = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [0.6, 0.8]), ("wide", [1.0, 0.0, 0.0]), ("wider", [1.0] * 9), ("thin", [1.0])]
    table = spark.createDataFrame(vectors, "id string, embeddings array<double>")
    queries = table.toDF("query_id", "vector")
    limits = {"method": method, "broadcast_queries": most, "block_rows": 2}
    found = rows(knn_cosine(table, queries, 1, exclude_self=True, **limits), "query_id", "id")
    assert found == [("a", "c"), ("b", "c"), ("c", "b")]
    # malformed queries in the majority, and a width that is given
    odd = queries.where("query_id in ('a', 'wide', 'wider')").union(queries.where("query_id = 'wider'"))
    assert rows(knn_cosine(table, odd, 1, **limits), "query_id", "id") == [("a", "a")]
    assert rows(knn_cosine(table, odd, 1, width=3, **limits), "query_id", "id") == [("wide", "wide")]
    assert rows(knn_rejects(table, odd)) == [
        ("page", "thin", 1), ("page", "wide", 3), ("page", "wider", 9), ("query", "wide", 3), ("query", "wider", 9), ("query", "wider", 9)]


def test_table_row_ends(spark):
    page = ("<table><tr><td>X. Zivilsenat</td><td>none</td></tr></table><p><a type='application/pdf' href='imprint.pdf'>"
            "<table><tr><td>I. Zivilsenat</td><td><a title='a > b' type='application/pdf' href='x.pdf'>x</a></table>")
    found = spark.createDataFrame([(page,)], "html string").select(F.explode(H.table_rows(F.col("html"))).alias("row")).select(
        H.first_cell_text(F.col("row")), H.first_href_of_type(F.col("row"), "application/pdf")).collect()
    assert [tuple(r) for r in found] == [("X. Zivilsenat", None), ("I. Zivilsenat", "x.pdf")]


def test_pages_of_another_year_do_not_count(spark, rows):
    page = "<a href='list.py?Datum=2023&Seite=120'>x</a><a href='list.py?Datum=2024&Seite=2'>y</a><a href='list.py?Seite=3'>z</a>"
    found = next_listings(spark.createDataFrame([("https://h/list.py?Datum=2024", page)], "url string, html string"))
    assert [r[:2] for r in rows(found)] == [(2024, 1), (2024, 2), (2024, 3)]


@pytest.mark.parametrize("url, value", [
    ("https://h/x?%44atum=2021", "2021"), ("https://h/x?Datum=a%20b&Datum=c", "a b"), ("https://h/x?Datum=%zz&Datum=c", "c"),
    ("https://h/x?Datum", ""), ("https://h/x?Datum=a=b", "a=b"), ("https://h/x?a;Datum=1", ""), ("https://h/x", "")])
def test_keys_are_decoded(spark, url, value):
    assert spark.createDataFrame([(url,)], "u string").select(U.query_param(F.col("u"), "Datum")).first()[0] == value


def test_strict_commit_refuses_repeats(spark, tmp_path):
    store = PageStore(spark, str(tmp_path))
    pages = spark.createDataFrame([("p", 1, "t", None), ("p", 1, "u", None)], "file_path string, page int, text string, embeddings array<float>")
    one = spark.createDataFrame([("p",)], "file_path string")
    now = F.to_timestamp(F.lit("2024-09-01 00:00:00"))
    with pytest.raises(ConflictError):
        store.commit(one.union(one), pages.limit(1), 0, now, mode="strict")
    with pytest.raises(ConflictError):
        store.commit(one, pages, 0, now, mode="strict")
    assert store.version() == 0


def test_fetch_in_parts(spark):
    from folioline.sources.fetch import fetch

    def fetcher(link):
        if link.endswith("7"):
            raise OSError("gone")
        return link.encode() * 1000

    links = spark.createDataFrame([(f"l{i}", i) for i in range(40)], "link string, n long")
    found = fetch(links, fetcher, slots=2, most_bytes=5000).collect()
    assert sorted(r.n for r in found) == list(range(40))
    assert all((r.error == "gone" and r.content is None) if r.link.endswith("7") else r.content == r.link.encode() * 1000 for r in found)
