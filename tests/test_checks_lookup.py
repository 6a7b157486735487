import pytest
from pyspark.sql import functions as F

from folioline.operators import checks as C, lookup as K

PAGES = "document_id string, page int, text string, embeddings array<float>"


def test_bad_pages(spark):
    vector = [0.0, 1.0]
    data = [("a", 1, "ok", vector), ("a", 0, "x", vector), ("a", 2, "", vector), ("a", 3, "x", [1.0]),
            ("a", 4, "x", None), ("a", 5, "x", [None, 1.0]), ("b", 1, "x", vector), ("b", 1, "y", vector),
            ("zz", 1, "x", vector), (None, 1, "x", vector), ("a", None, None, vector)]
    pages = spark.createDataFrame(data, PAGES)
    documents = spark.createDataFrame([("a",), ("b",)], "id string")
    spec = C.page_constraints(documents, width=2)
    valid, broken = C.check_constraints(pages, spec)
    assert [tuple(r)[:3] for r in valid.collect()] == [("a", 1, "ok")]
    assert valid.count() + broken.count() == len(data)
    rules = {(r["document_id"], r["page"], r["text"]): sorted(r["rules"]) for r in broken.collect()}
    assert rules == {
        ("a", 0, "x"): ["page_positive"], ("a", 2, ""): ["text_not_empty"], ("a", 3, "x"): ["embedding_width"],
        ("a", 4, "x"): ["embedding_width"], ("a", 5, "x"): ["embedding_width"],
        ("b", 1, "x"): ["document_page_unique"], ("b", 1, "y"): ["document_page_unique"],
        ("zz", 1, "x"): ["document_exists"], (None, 1, "x"): ["document_id_not_null"],
        ("a", None, None): ["page_positive", "text_not_empty"]}
    counts = {r["rule"]: r["n_rows"] for r in C.count_violations(pages, spec).collect()}
    assert counts == {"document_id_not_null": 1, "page_positive": 2, "text_not_empty": 2, "embedding_width": 3,
                      "document_page_unique": 2, "document_exists": 1}


def test_documents_rules(spark):
    df = spark.createDataFrame([("a",), ("a",), ("",), (None,), ("b",)], "file_path string")
    counts = {r["rule"]: r["n_rows"] for r in C.count_violations(df, C.document_constraints()).collect()}
    assert counts == {"file_path_not_empty": 2, "file_path_unique": 2}


def test_check_dim(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, e array<float>")
    good, bad = C.check_dim(df, "e", 2)
    assert [r["id"] for r in good.collect()] == [1] and sorted(r["id"] for r in bad.collect()) == [2, 3]


@pytest.mark.parametrize("landed, known, todo", [
    (True, True, False), (True, False, True), (False, True, True), (False, False, True), (None, True, True)])
def test_skip_matrix(spark, landed, known, todo):
    df = spark.createDataFrame([(landed, known)], "l boolean, k boolean")
    assert df.select(K.should_process(F.col("l"), F.col("k"))).first()[0] is todo


def test_pending(spark, rows):
    links = spark.createDataFrame([(p, f"u{p}") for p in ("tt", "tf", "ft", "ff", "ff")], "path string, link string")
    landed = spark.createDataFrame([("tt",), ("tf",), ("tt",)], "path string")
    known = spark.createDataFrame([("tt",), ("ft",)], "path string")
    assert rows(K.pending_links(links, landed, known), "path") == [("ff",), ("ff",), ("ft",), ("tf",)]
    two = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", "c")], "path string, link string")
    assert rows(K.one_link_per_path(two)) == [("p", "a"), ("q", "c")]


def test_lookup(spark, rows):
    stored = spark.createDataFrame([("p", "1"), ("q", "2"), ("q", "3")], "file_path string, id string")
    asked = spark.createDataFrame([("p",), ("q",), ("r",)], "file_path string")
    assert rows(K.lookup_ids(asked, stored, "exactly_one")) == [("p", "1"), ("q", None), ("r", None)]
    assert rows(K.lookup_ids(asked, stored.where("id < 3"))) == [("p", "1"), ("q", "2"), ("r", None)]
    assert rows(K.by_file_path(stored, "p"), "id") == [("1",)]
