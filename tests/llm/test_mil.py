"""Quality by attention over passages: the gradient, a planted bag rule, every case of rows, held-out accuracy on the given labels."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from folioline.llm import mil
from tests.llm.fixtures import DOCS, messy_rows


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    h = rng.random((40, mil.WIDTH)).astype(np.float32)
    bag = np.sort(np.r_[np.arange(8), rng.integers(0, 8, 32)])
    y = rng.integers(0, 2, 8).astype(float)
    model = mil.start_model()
    model["c"] = rng.normal(size=mil.HIDDEN)
    _, g = mil.gradient(model, h, bag, y)
    for k in model:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in model[k].shape)
            up, down = ({a: b.copy() for a, b in model.items()} for _ in range(2))
            up[k][at] += 1e-6
            down[k][at] -= 1e-6
            numeric = (mil.gradient(up, h, bag, y)[0] - mil.gradient(down, h, bag, y)[0]) / 2e-6
            assert abs(numeric - g[k][at]) <= 1e-4 * max(1e-3, abs(numeric))


def _bags(rng, n):
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], []
    for _ in range(n):
        lines = [" ".join(rng.choice(words, rng.integers(20, 60))).capitalize() + "." for _ in range(rng.integers(1, 6))]
        bad = rng.random() < 0.4
        if bad:  # one menu line among ordinary ones makes the document bad
            lines.insert(rng.integers(0, len(lines) + 1), " | ".join(rng.choice(["Home", "About", "Login", "Cart"], 6)))
        texts.append("\n".join(lines))
        labels.append(0.0 if bad else 1.0)
    return texts, np.array(labels)


def test_learns_a_rule_on_one_passage_of_the_bag():
    rng = np.random.default_rng(3)
    texts, y = _bags(rng, 400)
    h, bag = mil.passages(texts)
    model = mil.fit(h, bag, y)
    test_texts, test_y = _bags(rng, 200)
    h2, bag2 = mil.passages(test_texts)
    p, k = mil.forward(model, h2, bag2, len(test_texts))
    assert np.mean((p >= 0.5) == (test_y == 1)) >= 0.95
    # in bad bags, the menu passage draws the most weight
    menus = [i for i, t in enumerate(test_texts) if test_y[i] == 0]
    lines = [line for t in test_texts for line in t.split("\n")]
    heaviest = [np.argmax(np.where(bag2 == d, k["a"], -1)) for d in menus]
    assert np.mean(["|" in lines[i] for i in heaviest]) >= 0.9


def test_every_row_gets_a_score(spark):
    rows = messy_rows()
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(rows) if r[0] is not None] + [(None, 1, 0), (7, None, 1)],
                                   "doc_id long, quality int, toxic int")
    got = mil.quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= mil.BAR) for r in got)
    for r in got:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 4 == 2)
    assert mil.quality_scores(docs.limit(0), labels).collect() == []
    # without labels the model stays at its start
    none = mil.quality_scores(docs, labels.limit(0)).collect()
    assert {round(r.score, 9) for r in none} == {0.5}


def test_held_out_accuracy_on_the_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = mil.quality_scores(docs, labels)
    held = scored.where("held_out").join(labels.select("doc_id", "quality"), "doc_id").select("quality", "score", "predicted").toPandas()
    assert len(held) > 500
    majority = max(held.quality.mean(), 1 - held.quality.mean())
    accuracy = ((held.score >= 0.5) == (held.quality == 1)).mean()
    assert accuracy >= max(0.9, majority + 0.03), (accuracy, majority)
    # the contract's bar of 0.7 keeps most good documents and drops most bad ones
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good.predicted.mean() >= 0.85 and bad.predicted.mean() <= 0.3
