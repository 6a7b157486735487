"""The three steps a user can replace: embedder, extractor, fetcher."""

import hashlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioline.operators.embed import embed, hash_embed, hashed_terms
from folioline.operators.extract import command_extractor, extract_text
from folioline.sources.fetch import fetch, fetch_from_landing, url_fetcher
from folioline.schema import NO_EMBEDDINGS


def lengths():
    def run(texts):
        if any("bad" in t for t in texts):
            raise ValueError("bad text")
        return [[float(len(t)), 1.0] for t in texts]
    return run


def empty_reply():
    return lambda texts: []


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("slots", [None, 3])
def test_embed(spark, distinct, slots):
    data = [(i, t) for i, t in enumerate(["x", "xx", "bad", "xx", None, "a bad one"] + ["same"] * 50)]
    done = embed(spark.createDataFrame(data, "id int, text string"), "text", lengths, distinct=distinct, slots=slots)
    found = {r["id"]: (r["embeddings"], r["error"]) for r in done.collect()}
    assert len(found) == len(data) == done.count()
    for i, text in data:
        if text is None:
            assert found[i][0] is None
        elif "bad" in text:
            assert found[i] == (None, "bad text")
        else:
            assert found[i] == ([float(len(text)), 1.0], None)


def test_distinct_texts_are_embedded_once(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def factory():
        def run(texts):
            with open(seen, "a") as out:
                out.writelines(f"{t}\n" for t in texts)
            return [[1.0] for _ in texts]
        return run

    df = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 10).cast("string"))).alias("text"))
    assert embed(df, "text", factory, distinct=True).where("embeddings is not null").count() == 4000
    texts = Path(seen).read_text().split()
    assert sorted(texts) == sorted(set(texts)) and len(texts) == 11


def test_embedder_runs_once_under_filters(spark, tmp_path):
    seen = str(tmp_path / "seen")

    def factory():
        def run(texts):
            with open(seen, "a") as out:
                out.writelines("x\n" for _ in texts)
            return [[1.0] for _ in texts]
        return run

    df = embed(spark.range(100).select(F.col("id").cast("string").alias("t")), "t", factory)
    df.where("error is null and size(embeddings) = 1").write.format("noop").mode("overwrite").save()
    assert len(Path(seen).read_text().split()) == 100


def test_empty_reply_is_an_error(spark):
    done = embed(spark.createDataFrame([("x",)], "t string"), "t", empty_reply).first()
    assert done["embeddings"] is None and done["error"] == NO_EMBEDDINGS


def test_hashed_vectors(spark):
    texts = ["Hello, my dog is cute", "dog dog", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: np.array(r["embeddings"]) for r in hash_embed(df, "text", 1536).collect()}
    for i, text in enumerate(texts):
        expected = np.zeros(1536)
        for token in (text or "").split():
            expected[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 1536] += 1
        norm = np.linalg.norm(expected)
        assert len(found[i]) == 1536
        np.testing.assert_allclose(found[i], expected / norm if norm else expected, atol=1e-6)
    sparse = hashed_terms(df, ["id"], "text", 1536).groupBy("id").agg(F.sum("n")).collect()
    assert {tuple(r) for r in sparse} == {(0, 5), (1, 2)}


def test_extract(spark):
    blobs = spark.createDataFrame([("a", b"one\ftwo"), ("b", b"\xff\xfe"), ("c", "ü".encode())], "path string, content binary")
    native = {r["path"]: (r["text"], r["error"]) for r in extract_text(blobs).collect()}
    assert native == {"a": ("one\ftwo", None), "b": (None, "not UTF-8 text"), "c": ("ü", None)}
    custom = {r["path"]: r for r in extract_text(blobs, lambda content: content.decode("utf-8").upper()).collect()}
    assert custom["a"]["text"] == "ONE\fTWO" and custom["c"]["text"] == "Ü"
    assert custom["b"]["text"] is None and "decode" in custom["b"]["error"]
    piped = {r["path"]: r["text"] for r in extract_text(blobs.where("path <> 'b'"), command_extractor(["cat"])).collect()}
    assert piped == {"a": "one\ftwo", "c": "ü"}
    failed = extract_text(blobs, command_extractor(["false"])).collect()
    assert all(r["text"] is None and "exit status 1" in r["error"] for r in failed)


def test_fetch(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"\x00\x01")
    links = spark.createDataFrame([(f"file://{tmp_path}/a.pdf",), (f"file://{tmp_path}/b.pdf",)], "link string")
    done = fetch(links, url_fetcher(), slots=2)
    assert done.rdd.getNumPartitions() == 2
    found = {r["link"][-5:]: (r["content"], r["error"] is None) for r in done.collect()}
    assert found == {"a.pdf": (b"\x00\x01", True), "b.pdf": (None, False)}


def test_fetch_from_landing(spark):
    links = spark.createDataFrame([("a",), ("b",), ("c",)], "link string")
    landing = spark.createDataFrame([("a", b"x"), ("b", None)], "url string, content binary")
    found = {r["link"]: (r["content"], r["error"]) for r in fetch_from_landing(links, landing).collect()}
    assert found == {"a": (b"x", None), "b": (None, "no content"), "c": (None, "not found in landing table")}
