"""Quality rules, toxicity and the pipeline."""

import collections
import re
import zlib

import corpus_pipeline
from folioline.llm import quality, toxicity
from tests.llm.fixtures import DOCS, VOCABULARY, messy_rows


def _stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_word_stats_and_rules(spark):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, DOCS)
    found = quality.quality(docs).collect()
    expected = []
    for r in rows:
        s = _stats(r[1])
        expected.append((r[0], *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
    assert sorted((tuple(r)[:7] for r in found), key=repr) == sorted(expected, key=repr)
    # too few rows for any estimate: the rules alone decide
    assert all(r.kept != r.base_failed for r in found)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((r for r, e in zip(rows, expected) if not e[6]), key=repr)
    assert quality.quality(docs.limit(0)).count() == 0


def test_outliers_of_a_group(spark):
    import random
    rng = random.Random(2)
    plain = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(30, 200))), "en", "s") for i in range(400)]
    odd = [(1000 + i, " ".join(rng.choice(VOCABULARY) + "###$$" for _ in range(100)), "en", "s") for i in range(40)]
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string, lang string, source string")
    verdict = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    assert all(verdict[r[0]] for r in plain)
    assert not any(verdict[r[0]] for r in odd)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = toxicity.toxicity(docs, labels)
    joined = found.join(labels, "doc_id").where("held_out and quality = 1").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in joined)
    right = sum(r.predicted == r.toxic for r in joined)
    assert right >= 0.95 * len(joined)
    assert 0 <= min(r.score for r in joined) and max(r.score for r in joined) <= 1
    toxic, clean = ([r.score for r in joined if r.toxic == k] for k in (1, 0))
    better = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert better >= 0.95 * len(toxic) * len(clean)


def test_toxicity_messy(spark):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(101, 1, "x"), (102, 0, "x"), (None, 1, None), (103, None, None), (101, 1, "y")], "doc_id long, toxic int, text string")
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage keeps the columns, works on all rows, and its decisions take effect."""
    rows = messy_rows()
    spark.createDataFrame([(1, "zzz not there")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, DOCS)
    columns = docs.columns
    counts = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert len(rows) > counts[0] > counts[1] >= counts[2] == counts[3] == counts[4]
    assert docs.where("not round_trip").count() == 0


def test_empty_pipeline(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
