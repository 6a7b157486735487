import random

import pytest
from pyspark.sql import functions as F

from folioline.operators import pages as P


@pytest.mark.parametrize("text, expected", [
    ("a\fb\f", ["a", "b"]), ("a\f\fb", ["a", "b"]), ("\n\f", ["\n"]), ("\f", []), ("", []), (None, [])])
def test_number_pages(spark, text, expected):
    df = spark.createDataFrame([("d", text)], "doc string, text string")
    found = P.number_pages(df, ["doc"]).orderBy("page").collect()
    assert [(r["page"], r["text"]) for r in found] == list(enumerate(expected, 1))


def test_documents_without_pages_can_stay(spark, rows):
    df = spark.createDataFrame([("d", "\f"), ("e", "x")], "doc string, text string")
    assert rows(P.number_pages(df, ["doc"], outer=True)) == [("d", None, None), ("e", 1, "x")]


def test_number_page_rows_of_one_long_document(spark):
    rng = random.Random(1)
    data = [(doc, pos, rng.choice(["", "x", "\n"])) for doc, n in (("long", 5000), ("short", 3), ("empty", 0))
            for pos in rng.sample(range(n * 3), n)]
    df = spark.createDataFrame(data, "doc string, pos long, text string").repartition(8)
    found = {(r["doc"], r["pos"]): r["page"] for r in P.number_page_rows(df, "doc", "pos", width=16).collect()}
    expected = {}
    for doc in ("long", "short"):
        kept = sorted(pos for d, pos, text in data if d == doc and text)
        expected.update({(doc, pos): i for i, pos in enumerate(kept, 1)})
    assert found == expected


def test_collect_pages_keeps_order_and_bound(spark):
    df = spark.range(1, 2501).select(F.lit("d").alias("doc"), F.col("id").cast("int").alias("page"),
                                     F.col("id").cast("string").alias("text")).repartition(8)
    found = P.collect_pages(df, "doc", ["text"]).orderBy("part").collect()
    assert [len(r["pages"]) for r in found] == [1024, 1024, 452]
    assert [p["page"] for r in found for p in r["pages"]] == list(range(1, 2501))
    assert all(p["text"] == str(p["page"]) for r in found for p in r["pages"])


def test_document_with_pages(spark):
    documents = spark.createDataFrame([("a", "pa"), ("b", "pb")], "id string, file_path string")
    pages = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("c", 1, "z")], "document_id string, page int, text string")
    found = {r["id"]: [tuple(p) for p in r["pages"]] for r in P.document_with_pages(documents, pages, ["text"]).collect()}
    assert found == {"a": [(1, "x"), (2, "y")], "b": []}


def test_pages_in_order(spark):
    pages = spark.createDataFrame([("a", 2), ("b", 1), ("a", 10), ("a", 1)], "document_id string, page int")
    assert [r["page"] for r in P.pages_in_order(pages, "a").collect()] == [1, 2, 10]
    assert [tuple(r) for r in P.pages_in_order(pages).collect()] == [("a", 1), ("a", 2), ("a", 10), ("b", 1)]
