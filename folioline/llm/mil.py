"""Document quality by attention-based multiple-instance learning: a document is a bag of passages, its label is the bag's.

Every passage is encoded from its text alone: hashed word counts and a few shape figures. A gated attention (tanh of one
projection times the sigmoid of another, then a weight vector) gives each passage of a document a weight; the weighted sum of the
passage representations is scored by a logistic layer. All weights are learned together from document labels, so passages that
make documents bad get the weight without ever being labelled themselves.

Fitting runs on a bounded sample of labelled training documents (``MAX_TRAIN_DOCS`` drawn in the order of a hash of their id, and of
these as many as fit in ``MAX_TRAIN_PASSAGES`` passages), by full-batch Adam in numpy; the few small matrices of the model then
travel to the executors, which encode and score every document in Arrow batches.

Cases, each with a defined result:

* a null or empty text, or one without words, is one empty passage and gets the score the model gives that (a number in [0, 1]);
* a text is cut at line ends and then into pieces of ``PASSAGE_WORDS`` words; nothing of it is left out, however long;
* labels: a null label or id never trains; an id with several labels trains as its highest; rows of the held-out fold never train;
  several rows of one id are scored each by their own text, and train as one bag of all their passages;
* ``held_out`` of a null id is that of the empty text; ``lang``, ``source`` and columns of any other name are never read;
* with no training row at all the model is left at its start, which scores every text 0.5;
* an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from folioline.session import ship_package

#: Fixed values of the contract: the held-out fold, the bar for ``predicted``.
FOLDS, HELD_OUT, BAR = 4, 2, 0.7
#: A passage has at most so many words.
PASSAGE_WORDS = 64
#: Hashed word buckets, and the size of the passage representation and of the attention.
BUCKETS, HIDDEN, ATTENTION = 128, 32, 16
#: Bounds of the fitting sample, documented parameters: documents by hash order, and passages of these.
MAX_TRAIN_DOCS, MAX_TRAIN_PASSAGES = 4000, 60_000
EPOCHS, RATE, DECAY, SEED = 300, 0.01, 1e-4, 20240611
SYMBOLS = "#*$%&|<>"
N_SHAPE = 8
WIDTH = BUCKETS + N_SHAPE

RESULT = "doc_id long, held_out boolean, score double, predicted int"
#: Texts are encoded in runs of rows of about so many characters, which bounds what a Python worker holds.
SLICE_CHARS = 1 << 20


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels must not be learned from. A null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % FOLDS == HELD_OUT


def passages(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """``(features, bag)``: one row of ``WIDTH`` features per passage, and the index of its text; every text has one at least."""
    words, of_word, bag, symbols, marks = [], [], [], [], []
    for d, text in enumerate(texts):
        first = len(bag)
        for line in (text or "").split("\n"):
            ws = line.split()
            for s in range(0, len(ws), PASSAGE_WORDS):
                chunk = ws[s:s + PASSAGE_WORDS]
                joined = " ".join(chunk)
                of_word.extend([len(bag)] * len(chunk))
                words.extend(chunk)
                symbols.append(sum(joined.count(c) for c in SYMBOLS) / max(1, len(joined)))
                marks.append(sum(joined.count(c) for c in ".,;:!?") / len(chunk))
                bag.append(d)
        if len(bag) == first:
            bag.append(d)
            symbols.append(0.0)
            marks.append(0.0)
    n = len(bag)
    of_word = np.asarray(of_word, np.int64)
    features = np.zeros((n, WIDTH), np.float32)
    count = np.bincount(of_word, minlength=n).astype(np.float64)
    if words:
        hashed = np.fromiter((zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % BUCKETS for w in words), np.int64, len(words))
        cells = np.bincount(of_word * BUCKETS + hashed, minlength=n * BUCKETS).reshape(n, BUCKETS)
        features[:, :BUCKETS] = np.sqrt(cells / np.maximum(count, 1)[:, None])
        length = np.fromiter(map(len, words), np.float64, len(words))
        upper = np.fromiter((w[0].isupper() for w in words), np.float64, len(words))
        alpha = np.fromiter((w.isalpha() for w in words), np.float64, len(words))
        ends = np.fromiter((w[-1] in ".!?" for w in words), np.float64, len(words))

        def mean(x):
            return np.bincount(of_word, weights=x, minlength=n) / np.maximum(count, 1)
        features[:, BUCKETS + 2] = np.minimum(mean(length) / 10, 3)
        features[:, BUCKETS + 3] = mean(upper)
        features[:, BUCKETS + 4] = mean(alpha)
        features[:, BUCKETS + 5] = mean(ends)
    features[:, BUCKETS] = np.log1p(count) / 5
    features[:, BUCKETS + 1] = count == 0
    features[:, BUCKETS + 6] = np.minimum(np.asarray(symbols) * 10, 3)
    features[:, BUCKETS + 7] = np.minimum(np.asarray(marks), 3)
    return features, np.asarray(bag, np.int64)


def start_model() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return {"W1": rng.normal(0, 1 / np.sqrt(WIDTH), (HIDDEN, WIDTH)), "b1": np.zeros(HIDDEN),
            "V": rng.normal(0, 1 / np.sqrt(HIDDEN), (ATTENTION, HIDDEN)), "U": rng.normal(0, 1 / np.sqrt(HIDDEN), (ATTENTION, HIDDEN)),
            "w": rng.normal(0, 1 / np.sqrt(ATTENTION), ATTENTION), "c": np.zeros(HIDDEN), "c0": np.zeros(1)}


def _segment_softmax(s: np.ndarray, bag: np.ndarray, n_bags: int) -> np.ndarray:
    top = np.full(n_bags, -np.inf)
    np.maximum.at(top, bag, s)
    e = np.exp(s - top[bag])
    return e / np.bincount(bag, weights=e, minlength=n_bags)[bag]


def forward(model: dict, h: np.ndarray, bag: np.ndarray, n_bags: int) -> tuple[np.ndarray, dict]:
    """Probability of label 1 of each bag, and what the gradient needs."""
    h = h.astype(np.float64)
    z = np.maximum(h @ model["W1"].T + model["b1"], 0)
    t, u = np.tanh(z @ model["V"].T), 1 / (1 + np.exp(-(z @ model["U"].T)))
    a = _segment_softmax((t * u) @ model["w"], bag, n_bags)
    r = np.zeros((n_bags, HIDDEN))
    np.add.at(r, bag, a[:, None] * z)
    logit = r @ model["c"] + model["c0"][0]
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), {"h": h, "z": z, "t": t, "u": u, "a": a, "r": r}


def gradient(model: dict, h: np.ndarray, bag: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over bags and its gradient by every weight."""
    n_bags = len(y)
    p, k = forward(model, h, bag, n_bags)
    eps = 1e-12
    loss = float(-np.mean(y * np.log(p + eps) + (1 - y) * np.log(1 - p + eps)))
    dlogit = (p - y) / n_bags
    g = {"c": k["r"].T @ dlogit, "c0": np.array([dlogit.sum()])}
    dr = dlogit[:, None] * model["c"][None, :]
    dz = k["a"][:, None] * dr[bag]
    da = np.einsum("ij,ij->i", k["z"], dr[bag])
    ds = k["a"] * (da - np.bincount(bag, weights=k["a"] * da, minlength=n_bags)[bag])
    gate = k["t"] * k["u"]
    g["w"] = gate.T @ ds
    dgate = ds[:, None] * model["w"][None, :]
    dt = dgate * k["u"] * (1 - k["t"] ** 2)
    du = dgate * k["t"] * k["u"] * (1 - k["u"])
    g["V"], g["U"] = dt.T @ k["z"], du.T @ k["z"]
    dz += dt @ model["V"] + du @ model["U"]
    dz *= k["z"] > 0
    g["W1"], g["b1"] = dz.T @ k["h"], dz.sum(0)
    return loss, g


def fit(h: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Full-batch Adam with weight decay from ``start_model``; bags are numbered 0..len(y)-1."""
    model = start_model()
    if not len(y):
        return model
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x) for k, x in model.items()}
    for step in range(1, epochs + 1):
        _, g = gradient(model, h, bag, y)
        for k in model:
            gk = g[k] + DECAY * model[k]
            m[k] = 0.9 * m[k] + 0.1 * gk
            v[k] = 0.999 * v[k] + 0.001 * gk ** 2
            model[k] = model[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows of about ``SLICE_CHARS`` characters of text; a longer text is a run of its own."""
    for batch in batches:
        sizes = batch["text"].str.len().fillna(0).to_numpy()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > SLICE_CHARS:
                yield batch.iloc[start:i]
                start, total = i, 0
            total += n
        if start < len(batch):
            yield batch.iloc[start:]


def _scored(model: dict):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            texts = batch["text"].tolist()
            h, bag = passages(texts)
            p, _ = forward(model, h, bag, len(texts))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": p,
                                "predicted": (p >= BAR).astype(np.int32)})
    return run


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _slices(batches):
        h, bag = passages(batch["text"].tolist())
        yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[bag], "h": list(h)})


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage features, bag numbers and labels of the bounded fitting sample, on the driver.

    Only labels are shuffled; documents are read through a filter on the chosen ids. Of the first ``MAX_TRAIN_DOCS`` labelled ids
    by hash order, those are taken, in that order, whose passages fit in ``MAX_TRAIN_PASSAGES`` (counted by a bound from lines
    and words, before any feature travels).
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("quality").cast("int").alias("quality"))
    first = usable.withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id").limit(MAX_TRAIN_DOCS).collect()
    quality = {r["doc_id"]: r["quality"] for r in first}
    text = F.coalesce("text", F.lit(""))
    sizes = docs.where(F.col("doc_id").isin(list(quality))).groupBy("doc_id").agg(
        F.sum(F.size(F.split(text, "\n")) + F.floor(F.size(F.split(text, r"\s+")) / PASSAGE_WORDS) + 1).alias("bound"))
    bound = {r["doc_id"]: r["bound"] for r in sizes.collect()}
    chosen, total = [], 0
    for r in first:
        if r["doc_id"] not in bound:
            continue
        if total + bound[r["doc_id"]] > MAX_TRAIN_PASSAGES:
            break
        chosen.append(r["doc_id"])
        total += bound[r["doc_id"]]
    if not chosen:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), np.zeros(0)
    rows = docs.where(F.col("doc_id").isin(chosen)).mapInPandas(_features, "doc_id long, h array<float>").toPandas()
    number = {d: i for i, d in enumerate(chosen)}
    bag = rows["doc_id"].map(number).to_numpy(np.int64)
    order = np.argsort(bag, kind="stable")
    y = np.array([quality[d] for d in chosen], np.float64)
    return np.stack(rows["h"].to_numpy())[order].astype(np.float32), bag[order], y


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``RESULT`` for every row of ``docs (doc_id, text)``, learned from ``labels (doc_id, quality)`` outside the held-out fold."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    h, bag, y = training_sample(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality"))
    model = fit(h, bag, y)
    return docs.withColumn("held_out", held_out(F.col("doc_id"))).mapInPandas(_scored(model), RESULT)
