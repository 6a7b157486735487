"""The constraint-checked commit: each rule of the schema rejects its rows, the rest is stored, a rerun changes nothing."""

import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from folioline.sinks.store import PageStore

NAN = float("nan")


def test_each_rule_rejects_its_rows(spark):
    store = PageStore(spark, tempfile.mkdtemp(prefix="checked-"))
    ok = [0.5, 0.5]
    pages = spark.createDataFrame([
        ("a", 1, "fine", ok), ("a", 2, "also fine", ok),
        ("", 1, "empty path", ok), (None, 1, "no path", ok),
        ("b", 0, "page zero", ok), ("b", None, "no page", ok),
        ("c", 1, "", ok), ("c", 2, None, ok),
        ("d", 1, "short", [0.5]), ("d", 2, "nan", [NAN, 0.5]), ("d", 3, "null element", [None, 0.5]), ("d", 4, "none", None),
        ("e", 1, "twice", ok), ("e", 1, "twice again", ok),
        ("f", 1, "no document", ok)], "file_path string, page int, text string, embeddings array<float>")
    offered = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), ("",), ("a",)], "file_path string")
    version, rejects = store.commit_checked(offered, pages, 0, datetime(2024, 1, 1), width=2)
    got = sorted(((r.file_path, r.page, tuple(r.rules)) for r in rejects.collect()), key=repr)
    assert got == sorted([
        ("", 1, ("file_path_not_empty",)), (None, 1, ("file_path_not_empty",)),  # a NULL reference is no broken reference
        ("b", 0, ("page_positive",)), ("b", None, ("page_positive",)),
        ("c", 1, ("text_not_empty",)), ("c", 2, ("text_not_empty",)),
        ("d", 1, ("embedding_width",)), ("d", 2, ("embedding_width",)), ("d", 3, ("embedding_width",)),
        ("d", 4, ("embedding_width",)),
        ("e", 1, ("document_page_unique",)), ("e", 1, ("document_page_unique",)),
        ("f", 1, ("document_exists",))], key=repr)
    documents, stored = store.snapshot()
    assert sorted(r.file_path for r in documents.collect()) == ["a", "b", "c", "d", "e"]
    assert stored.count() == 2
    # the same batch again changes nothing and gives the same rejects
    again, rejects_again = store.commit_checked(offered, pages, 0, datetime(2024, 1, 2), width=2)
    assert again == version and rejects_again.count() == len(got)
    # strict: a stored path is a broken primary key
    more = spark.createDataFrame([("a", 3, "new page of a stored path", ok), ("g", 1, "new", ok)],
                                 "file_path string, page int, text string, embeddings array<float>")
    _, strict = store.commit_checked(more.select("file_path"), more, 1, datetime(2024, 1, 3), "strict", width=2)
    assert [(r.file_path, tuple(r.rules)) for r in strict.collect()] == [("a", ("file_path_unique",))]
    assert store.pages().count() == 3 and store.documents().where(F.col("file_path") == "g").count() == 1
