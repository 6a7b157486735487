"""Stored tables: pages, files, run log."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioline.operators.audit import as_log, stage_summary
from folioline.functions.ids import document_id
from folioline.operators.upsert import ConflictError, upsert_documents, upsert_pages
from folioline.schema import DOCUMENT_PAGES, DOCUMENTS
from folioline.session import empty_frame, scratch_dir
from folioline.sinks.blobs import BlobExistsError, landed_paths, read_batch, read_saved, save_blobs, write_text_files
from folioline.sinks.runlog import write_run_log
from folioline.sinks.store import PageStore
from folioline.sources.blobs import landed_files, read_blobs
from folioline.sources.listings import read_listings, stream_listings
from folioline.sources.runlog import read_run_log
from tests.conftest import plan_of

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 2), datetime(2024, 3, 3)
PAGES = "file_path string, page int, text string, embeddings array<float>"


def batch(spark, *rows):
    pages = spark.createDataFrame([(f, p, t, [1.0]) for f, p, t in rows], PAGES)
    return pages.select("file_path").distinct(), pages


def contents(store):
    documents, pages = store.snapshot()
    joined = pages.join(documents.select(F.col("id").alias("document_id"), "file_path"), "document_id")
    return {(r["file_path"], r["page"]): (r["text"], r["created_at"], r["updated_at"]) for r in joined.collect()}


def test_commits(spark):
    store = PageStore(spark, scratch_dir(spark, "t"))
    assert store.version() == 0 and store.documents().count() == 0 and store.pages().count() == 0
    assert store.commit(*batch(spark, ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), 10, T1) == 1
    assert store.commit(*batch(spark, ("a", 2, "new"), ("c", 1, "w")), 11, T2) == 2
    expected = {("a", 1): ("x", T1, T1), ("a", 2): ("y", T1, T2), ("b", 1): ("z", T1, T1), ("c", 1): ("w", T2, T2)}
    assert contents(store) == expected
    # a batch that comes again, and a writer that knows nothing but the folder
    again = PageStore(spark, store.root)
    assert again.commit(*batch(spark, ("a", 2, "other")), 11, T3) == 2
    assert contents(again) == expected and again.committed(10) and not again.committed(12)
    again.commit(*batch(spark, ("a", 2, "other")), 12, T3, mode="replace")
    assert contents(store)[("a", 2)] == ("other", T1, T3)


def test_readers_see_whole_versions(spark, monkeypatch):
    store = PageStore(spark, scratch_dir(spark, "t"))
    store.commit(*batch(spark, ("a", 1, "x")), 0, T1)
    before = contents(store)
    monkeypatch.setattr(PageStore, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.commit(*batch(spark, ("a", 1, "y"), ("b", 1, "z")), 1, T2, mode="replace")
    assert contents(store) == before and store.version() == 1 and not store.committed(1)
    monkeypatch.undo()
    Path(f"{store.root.removeprefix('file:')}/manifest/v=000000000002/_temporary").mkdir(parents=True)
    assert contents(store) == before
    store.commit(*batch(spark, ("a", 1, "y"), ("b", 1, "z")), 1, T2, mode="replace")
    assert {k: v[0] for k, v in contents(store).items()} == {("a", 1): "y", ("b", 1): "z"}


def test_strict_commit(spark):
    store = PageStore(spark, scratch_dir(spark, "t"))
    store.commit(*batch(spark, ("a", 1, "x")), 0, T1, mode="strict")
    with pytest.raises(ConflictError):
        store.commit(*batch(spark, ("a", 2, "x"), ("b", 1, "y")), 1, T2, mode="strict")
    assert set(contents(store)) == {("a", 1)}


def test_documents_without_pages(spark):
    store = PageStore(spark, scratch_dir(spark, "t"))
    _, pages = batch(spark, ("a", 1, "x"))
    store.commit(spark.createDataFrame([("a",), ("empty",)], "file_path string"), pages, 0, T1)
    assert store.documents().count() == 2 and store.pages().count() == 1
    store.commit(spark.createDataFrame([("empty2",)], "file_path string"), pages.limit(0), 1, T1)
    assert store.documents().count() == 3 and store.pages().count() == 1


@pytest.mark.parametrize("mode", ["keep_first", "replace"])
def test_store_equals_upserts(spark, mode):
    """Commits give what the whole-table upserts give, before and after compaction."""
    rng = random.Random(5)
    store = PageStore(spark, scratch_dir(spark, "t"))
    documents, pages = empty_frame(spark, DOCUMENTS), empty_frame(spark, DOCUMENT_PAGES)
    for number in range(4):
        rows = [(f"f{rng.randrange(8)}", rng.randrange(1, 5), f"t{rng.randrange(99)}") for _ in range(12)]
        docs, new = batch(spark, *rows)
        now = datetime(2024, 1, number + 1)
        store.commit(docs, new, number, now, mode)
        documents = upsert_documents(documents, docs, now)
        keyed = new.withColumn("document_id", document_id(F.col("file_path"))).drop("file_path")
        pages = upsert_pages(pages, keyed, now, mode)
        if number == 2:
            assert store.compact() == 4
    def seen(df):
        return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert seen(store.documents()) == seen(documents)
    assert seen(store.pages()) == seen(pages)


def test_reading_texts_needs_no_join(spark):
    store = PageStore(spark, scratch_dir(spark, "t"))
    store.commit(*batch(spark, ("a", 1, "x")), 0, T1)
    assert "touched" not in plan_of(store.pages().select("document_id", "text"))
    assert "touched" not in plan_of(store.documents().select("file_path"))


def blobs(spark, *rows):
    return spark.createDataFrame([(p, c.encode() if c is not None else None) for p, c in rows], "path string, content binary")


def saved(spark, root):
    return {r["path"]: bytes(r["content"]).decode() for r in read_saved(spark, root).collect()}


def test_blob_policies(spark):
    root = scratch_dir(spark, "t")
    assert landed_paths(spark, root).count() == 0
    save_blobs(blobs(spark, ("j/bgh/2021/1.pdf", "one"), ("j/bgh/2022/2.pdf", "two"), ("j/bgh/2022/3.pdf", None)), root, 0)
    assert saved(spark, root) == {"j/bgh/2021/1.pdf": "one", "j/bgh/2022/2.pdf": "two"}
    assert read_batch(spark, root, 0).where("status = 'failed'").count() == 1
    save_blobs(blobs(spark, ("j/bgh/2021/1.pdf", "new"), ("j/bgh/2022/3.pdf", "three")), root, 1, "skip")
    assert saved(spark, root) == {"j/bgh/2021/1.pdf": "one", "j/bgh/2022/2.pdf": "two", "j/bgh/2022/3.pdf": "three"}
    with pytest.raises(BlobExistsError):
        save_blobs(blobs(spark, ("j/bgh/2021/1.pdf", "new")), root, 2, "fail")
    save_blobs(blobs(spark, ("j/bgh/2021/1.pdf", "new")), root, 2)
    save_blobs(blobs(spark, ("j/bgh/2021/1.pdf", "newer")), root, 2)  # the batch replaces itself
    assert saved(spark, root)["j/bgh/2021/1.pdf"] == "newer"
    assert landed_paths(spark, root).count() == 3 and landed_paths(spark, root, other_than=1).count() == 2
    with pytest.raises(ValueError):
        save_blobs(blobs(spark, ("x", "y")), root, 3, "other")


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.pdf").write_bytes(b"abc")
    (tmp_path / "b.txt").write_bytes(b"x")
    assert [bytes(r["content"]) for r in read_blobs(spark, str(tmp_path), "*.pdf").collect()] == [b"abc"]
    listed = landed_files(spark, str(tmp_path))
    assert sorted(r["length"] for r in listed.collect()) == [1, 3]
    assert "content" not in plan_of(listed)
    with pytest.raises(Exception):
        landed_files(spark, str(tmp_path / "missing")).count()


def test_listings(spark, tmp_path):
    (tmp_path / "p.html").write_text("<a>\n</a>")
    found = read_listings(spark, str(tmp_path), "html").collect()
    assert [(r["url"].rsplit("/", 1)[1], r["html"]) for r in found] == [("p.html", "<a>\n</a>")]
    table = scratch_dir(spark, "t")
    spark.createDataFrame([("u", "h")], "url string, html string").write.parquet(table)
    stream = stream_listings(spark, table, "url string, html string")
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("listed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("listed").count() == 1


def test_run_log(spark, tmp_path):
    lines = [f'{{"level":"{level}","msg":"This is a {level} message","time":"2024-08-16T20:25:11+02:00","domain":"test"}}'
             for level in ("debug", "info", "warning", "error")]
    (tmp_path / "log.json").write_text("\n".join(lines))
    found = {r["level"]: (r["msg"], r["time"], r["domain"]) for r in read_run_log(spark, str(tmp_path)).collect()}
    assert set(found) == {"debug", "info", "warning", "error"}
    assert found["error"][0] == "This is a error message" and found["info"][2] == "test"
    assert len({time for _, time, _ in found.values()}) == 1 and found["info"][1] is not None


def test_log_and_summary(spark):
    events = spark.createDataFrame(
        [("a", "fetch", None, 1.0), ("b", "fetch", None, 3.0), ("c", "fetch", "HTTP status 404", 0.5)],
        "link string, stage string, error string, seconds double")
    path = scratch_dir(spark, "t")
    write_run_log(as_log(events, F.lit(T1), 4), path)
    log = read_run_log(spark, path)
    assert log.where("level = 'error'").first()["msg"] == "failed fetch: HTTP status 404"
    found = {(r["stage"], r["status"]): (r["n"], r["avg_seconds"]) for r in stage_summary(log).collect()}
    assert found == {("fetch", "ok"): (2, 2.0), ("fetch", "failed"): (1, 0.5)}
    assert {r["batch_id"] for r in log.collect()} == {4}


def test_text_files_without_a_folder_each(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"<p>ä {i}</p>") for i in range(200)] + [(7, None), (300, None), (301, "")], "page_id long, html string")
    write_text_files(pages, f"{tmp_path}/pages", "page_id", "html")
    files = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in read_blobs(spark, f"{tmp_path}/pages", "*.txt").collect()}
    expected = {f"page_id={i}.txt": f"<p>ä {i}</p>\n".encode() for i in range(200) if i != 7}
    assert sorted(files.pop("page_id=7.txt").split(b"\n")) == sorted(["".encode(), b"", "<p>ä 7</p>".encode()])
    assert files == {**expected, "page_id=300.txt": b"\n", "page_id=301.txt": b"\n"}
    # folders are as many as the writing tasks, however many the files
    assert len({p.parent for p in tmp_path.rglob("*.txt")}) <= 4 * spark.sparkContext.defaultParallelism
