from datetime import datetime

import pytest
from pyspark.sql import functions as F

from folioline.functions import ids as I
from folioline.operators import upsert as U
from folioline.schema import DOCUMENT_PAGES, DOCUMENTS
from folioline.session import empty_frame

T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 2)
PAGES = "document_id string, page int, text string, embeddings array<float>"


def documents(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "file_path string")


def pages(spark, *rows):
    return spark.createDataFrame([(d, p, t, [float(len(t))]) for d, p, t in rows], PAGES)


def seen(df):
    return {(r["document_id"], r["page"]): (r["text"], r["created_at"], r["updated_at"]) for r in df.collect()}


def test_documents(spark):
    first = U.upsert_documents(empty_frame(spark, DOCUMENTS), documents(spark, "a", "b", "a"), T1)
    second = U.upsert_documents(first, documents(spark, "b", "c"), T2)
    found = {r["file_path"]: (r["id"], r["created_at"], r["updated_at"]) for r in second.collect()}
    ids = {r["file_path"]: r["id"] for r in first.collect()}
    assert found["a"] == (ids["a"], T1, T1)
    assert found["b"] == (ids["b"], T1, T2)
    assert found["c"][1:] == (T2, T2)
    assert len(found["c"][0]) == 36 and second.columns == DOCUMENTS.names


def test_a_stored_id_is_kept_whatever_made_it(spark):
    old = U.with_defaults(documents(spark, "a"), F.lit("some-id"), T1)
    assert U.upsert_documents(old, documents(spark, "a"), T2).first()["id"] == "some-id"


def test_pages_keep_first(spark):
    first = U.upsert_pages(empty_frame(spark, DOCUMENT_PAGES), pages(spark, ("d", 1, "x"), ("d", 2, "y")), T1)
    second = U.upsert_pages(first, pages(spark, ("d", 2, "new"), ("d", 3, "z")), T2)
    assert seen(second) == {("d", 1): ("x", T1, T1), ("d", 2): ("y", T1, T2), ("d", 3): ("z", T2, T2)}
    assert set(second.columns) == set(DOCUMENT_PAGES.names)


def test_pages_replace(spark):
    first = U.upsert_pages(empty_frame(spark, DOCUMENT_PAGES), pages(spark, ("d", 1, "x"), ("d", 2, "y")), T1)
    second = U.upsert_pages(first, pages(spark, ("d", 2, "new")), T2, mode="replace")
    assert seen(second) == {("d", 1): ("x", T1, T1), ("d", 2): ("new", T1, T2)}
    assert {r["page"]: r["embeddings"] for r in second.collect()} == {1: [1.0], 2: [3.0]}


def test_fewer_pages_delete_nothing_and_twice_is_once(spark):
    first = U.upsert_pages(empty_frame(spark, DOCUMENT_PAGES), pages(spark, ("d", 1, "x"), ("d", 2, "y")), T1)
    batch = pages(spark, ("d", 1, "x"))
    once = U.upsert_pages(first, batch, T2)
    assert seen(once) == seen(U.upsert_pages(once, batch, T2))
    assert len(seen(once)) == 2


def test_copies_within_a_batch(spark):
    batch = pages(spark, *[("d", 1, "b")] * 500, ("d", 1, "a"), ("d", 1, "c")).repartition(8)
    found = U.upsert_pages(empty_frame(spark, DOCUMENT_PAGES), batch, T1).collect()
    assert [(r["text"], r["embeddings"]) for r in found] == [("a", [1.0])]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        U.upsert_pages(empty_frame(spark, DOCUMENT_PAGES), pages(spark, ("d", 1, "x")), T1, mode="other")


def test_strict(spark, rows):
    old, new = documents(spark, "a", "b"), documents(spark, "b", "c", "d", "d")
    assert rows(U.strict_conflicts(old, new, ["file_path"])) == [("b",), ("d",)]
    with pytest.raises(U.ConflictError):
        U.insert_strict(old, new, ["file_path"])
    assert U.insert_strict(old, documents(spark, "c"), ["file_path"]).count() == 1


def test_ids(spark):
    row = spark.range(1).select(
        I.format_uuid(F.lit("00112233445566778899aabbccddeeff")).alias("u"),
        I.record_id(F.lit("d"), F.lit(3)).alias("r")).first()
    assert row["u"] == "00112233-4455-6677-8899-aabbccddeeff"
    assert row["r"].asDict() == {"document_id": "d", "page": 3}
