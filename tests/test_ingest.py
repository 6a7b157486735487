from datetime import datetime
from types import SimpleNamespace

import pytest

from folioline.plans.ingest import Ingest
from folioline.session import scratch_dir
from folioline.sinks.blobs import landed_paths
from folioline.sources.runlog import read_run_log
from folioline.streaming.ingest import ingest_stream, stream_links
from folioline.schema import INVALID_URL

LINK = "https://example.org/document.py?Gericht=bgh&Datum=2024&nr={}&anz=9&pos=1"
NOW = datetime(2024, 1, 1)
FILES = {1: b"one\f\ftwo\f", 2: b"\f", 3: b"\xff", 4: b"fine\fpoison", 5: b"five"}


def path(n):
    return f"judgements/bgh/2024/{n}_9_1.pdf"


def links(spark, *numbers):
    return spark.createDataFrame([(LINK.format(n),) for n in numbers] + [("https://example.org/none",)], "link string")


def landing(spark, files=FILES):
    return spark.createDataFrame([(LINK.format(n), c) for n, c in files.items()], "url string, content binary")


def embedder():
    def run(texts):
        if any("poison" in t for t in texts):
            raise ValueError("refused")
        return [[float(len(t)), 0.0] for t in texts]
    return run


def stored(ingest):
    documents, pages = ingest.store.snapshot()
    joined = documents.join(pages.withColumnRenamed("id", "page_id"), documents["id"] == pages["document_id"], "left")
    return {(r["file_path"], r["page"], r["text"]) for r in joined.collect()}


GOOD = {(path(1), 1, "one"), (path(1), 2, "two"), (path(2), None, None), (path(5), 1, "five")}


def test_ingest(spark):
    ingest = Ingest(spark, scratch_dir(spark, "i"), landing=landing(spark), embedder=embedder, width=2)
    assert ingest.run(links(spark, 1, 1, 2, 3, 4, 5, 6), 0, NOW) == 1
    # a document with one bad page has no row at all, one without pages has a row
    assert stored(ingest) == GOOD
    rejects = {(r["link"], r["stage"], r["error"], r["batch_id"]) for r in ingest.rejects().collect()}
    assert rejects == {
        ("https://example.org/none", "path", INVALID_URL, 0),
        (LINK.format(6), "fetch", "not found in landing table", 0),
        (LINK.format(3), "extract", "not UTF-8 text", 0),
        (LINK.format(4), "embed", "refused", 0)}
    # files are kept even where a later step failed; those links stay to be done
    assert landed_paths(spark, ingest.blob_root).count() == 5
    assert {r["path"] for r in ingest.pending(links(spark, 1, 2, 3, 4, 5, 6)).collect()} == {path(3), path(4), path(6)}
    log = read_run_log(spark, ingest.log_root)
    assert log.where("level = 'error'").count() == 4
    assert {r["stage"] for r in log.collect()} == {"path", "fetch", "extract", "embed"}

    # the cause is gone: the next run does only what is missing
    better = {**FILES, 3: b"three", 4: b"fine", 6: b"six"}
    second = Ingest(spark, ingest.root, landing=landing(spark, better), embedder=embedder, width=2)
    assert second.run(links(spark, 1, 2, 3, 4, 5, 6), 1, NOW) == 2
    assert stored(second) == GOOD | {(path(3), 1, "three"), (path(4), 1, "fine"), (path(6), 1, "six")}
    assert second.pending(links(spark, 1, 2, 3, 4, 5, 6)).count() == 0
    assert spark.read.parquet(f"{ingest.root}/blobs/batch=1").count() == 3


def test_wrong_width_is_rejected(spark):
    ingest = Ingest(spark, scratch_dir(spark, "i"), landing=landing(spark, {1: b"x"}), embedder=embedder, width=3)
    ingest.run(links(spark, 1), 0, NOW)
    assert stored(ingest) == set()
    assert {(r["stage"], r["error"]) for r in ingest.rejects().where("stage <> 'path'").collect()} == {
        ("embed", "broken rules: embedding_width")}


def test_a_batch_that_died_is_done_again(spark, monkeypatch):
    root = scratch_dir(spark, "i")
    ingest = Ingest(spark, root, landing=landing(spark, {1: b"x", 5: b"y"}), width=4)
    monkeypatch.setattr(type(ingest.store), "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        ingest.run(links(spark, 1, 5), 0, NOW)
    monkeypatch.undo()
    assert ingest.pending(links(spark, 1, 5)).count() == 2
    ingest.run(links(spark, 1, 5), 0, NOW)
    assert stored(ingest) == {(path(1), 1, "x"), (path(5), 1, "y")}
    assert ingest.rejects().count() == 1


def test_fetcher_and_extractor(spark):
    def fetcher(link):
        if "nr=2" in link:
            raise OSError("HTTP status 404")
        return b"a b"

    ingest = Ingest(spark, scratch_dir(spark, "i"), fetcher=fetcher, fetch_slots=2, width=4,
                    extractor=lambda content: content.decode().replace(" ", "\f"))
    ingest.run(links(spark, 1, 2), 0, NOW)
    assert stored(ingest) == {(path(1), 1, "a"), (path(1), 2, "b")}
    assert {r["error"] for r in ingest.rejects().where("stage = 'fetch'").collect()} == {"HTTP status 404"}
    with pytest.raises(ValueError):
        Ingest(spark, scratch_dir(spark, "i")).run(links(spark, 1), 0, NOW)


def test_stream_equals_batch(spark):
    arriving = scratch_dir(spark, "links")
    for numbers in ((1, 2), (2, 3, 4), (5,)):
        links(spark, *numbers).coalesce(1).write.mode("append").parquet(arriving)
    streamed = Ingest(spark, scratch_dir(spark, "i"), landing=landing(spark), embedder=embedder, width=2)
    offsets = scratch_dir(spark, "offsets")
    for _ in range(2):  # started again, it finds nothing new
        ingest_stream(stream_links(spark, arriving, files_per_trigger=1), streamed, offsets, NOW)
    assert stored(streamed) == GOOD
    assert streamed.store.version() == 3
    # one more file, later
    links(spark, 3).coalesce(1).write.mode("append").parquet(arriving)
    ingest_stream(stream_links(spark, arriving), streamed, offsets, NOW)
    assert streamed.store.version() == 4 and stored(streamed) == GOOD


def test_links_of_one_file_are_spread(spark):
    """Links that come in one partition are taken apart by several tasks, once; all of them, bad ones, nulls and repeats too."""
    root = scratch_dir(spark, "test")
    many = links(spark, *range(1, 200), 7, 7).union(spark.createDataFrame([(None,)], "link string")).coalesce(1)
    ingest = Ingest(spark, root, landing=landing(spark), embedder=embedder, width=2)
    ingest.run(many, 0, NOW)
    placed = spark.read.parquet(f"{root}/staged/links/batch=0")
    assert placed.count() == 201 and placed.rdd.getNumPartitions() > 1
    assert placed.select("path").distinct().count() == 199
    assert spark.read.parquet(f"{root}/staged/bad_links/batch=0").count() == 2
    assert stored(ingest) == GOOD
    assert ingest.rejects().where("stage = 'path'").count() == 2


def test_scratch_folders(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert base is None or first.startswith(base)


def test_no_machine_local_folder_on_a_cluster():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None),
                              sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        scratch_dir(cluster, "x")
