"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors.

Voters are words and word beginnings, met once or met often: a short list known beforehand, and those that labelled training rows show to go
with the label. The label model has an accuracy for each voter, fitted by expectation maximisation over the counted vote patterns
of all training rows; correlated voters are discounted by their correlations within the toxic class. The classifier is a logistic
regression on the posteriors.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from folioline.session import settle

#: Insults that vote before any training.
LEXICON = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
#: About so many labelled rows at most are searched for voters, drawn by a hash of their id.
MAX_LABELLED = 6_000
#: About so many rows at most, drawn likewise, train the classifier.
MAX_TRAINING = 20_000
#: So many found voters at most, each in at least so many toxic rows and of at least such precision.
MAX_FOUND, MIN_SUPPORT, MIN_PRECISION = 64, 10, 0.8
PREFIXES = (4, 5, 6, 7)
#: A voter with a sign behind speaks if its word is met twice or more, and once in so many words or more.
OFTEN = 200
EM_STEPS = 8
#: A voter's accuracy before any data counts as so many votes; that of the known insults; the rate where nobody votes.
PSEUDO_VOTES, EXPECTED, SILENT = 10, 0.95, 0.02
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels must not be learned from. A null id counts as the text of length 0."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % FOLDS == 0


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def _beginnings(words: Column, size: int) -> Column:
    """The first ``size`` letters of each word that has as many, with a sign in front."""
    long = F.filter(words, lambda w: F.length(w) >= size)
    return F.transform(long, lambda w: F.concat(F.lit("^"), F.substring(w, 1, size)))


def _often(met: Column, n_words: Column) -> Column:
    """What occurs twice or more, and once in ``OFTEN`` words or more, in a sorted array; with a sign behind."""
    least = F.greatest(F.lit(2), F.ceil(n_words / OFTEN).cast("int"))
    there = F.filter(met, lambda x, i: (i + 1 >= least) & (F.get(met, F.greatest(i + 1 - least, F.lit(0))) == x))
    return F.transform(F.array_distinct(there), lambda x: F.concat(x, F.lit("+")))


def _among(words: Column, wanted: list[str]) -> Column:
    return F.filter(words, lambda w: w.isin(wanted))


def _drawn(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """About ``most`` rows at most, drawn by a hash of the columns; all rows of a table that is no larger."""
    share = min(1.0, most / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(*columns), F.lit(1_000_003)) < share * 1_000_003)
    # the first by hash, not any: a rerun fits the same model (a top-k of each task, then of these)
    return drawn.orderBy(F.xxhash64(*columns), *columns).limit(most + most // 4)


def find_voters(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Words and word beginnings that go with the label in training rows, with their precision, best first.

    ``docs (doc_id, text)``, ``labels (doc_id, toxic)``; null labels and rows of the held-out fold are left out.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = settle(_drawn(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), MAX_LABELLED, "doc_id"), "labelled")
    rows = docs.join(F.broadcast(chosen), "doc_id").select("toxic", _words(F.col("text")).alias("w")).select(
        "toxic", F.size("w").alias("n_words"),
        F.array_sort(F.concat("w", *[_beginnings(F.col("w"), k) for k in PREFIXES])).alias("s"))
    seen = rows.select("toxic", F.explode(F.concat(F.array_distinct("s"), _often(F.col("s"), F.col("n_words")))).alias("voter")).groupBy(
        "voter").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("pos"), F.count("*").alias("n"))
    good = seen.where((F.col("pos") >= MIN_SUPPORT) & (F.col("pos") >= MIN_PRECISION * F.col("n")))
    lift = F.col("pos") * F.log((F.col("pos") + 0.5) / (F.col("n") - F.col("pos") + 0.5))
    best: dict[str, float] = {}
    for row in good.orderBy(lift.desc(), "voter").limit(16 * MAX_FOUND).select("voter", "pos", "n").collect():
        root = row["voter"].strip("^+")
        # of a beginning, what it begins, and their often-met forms only the best votes: they would echo each other
        if not any(b.strip("^+").startswith(root) or root.startswith(b.strip("^+")) for b in best):
            best[row["voter"]] = (row["pos"] + 0.5) / (row["n"] + 1)
    return dict(list(best.items())[:MAX_FOUND])


def votes(docs: DataFrame, voters: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``, ``n_words``, ``n_hits`` (how many words speak for any voter) and ``votes``, the voters of a text."""
    roots = sorted({v.rstrip("+") for v in voters})
    whole = [v for v in roots if not v.startswith("^")]
    words = F.col("_w")
    found = [_among(words, whole)] if whole else []
    for k in PREFIXES:
        own = [v for v in roots if v.startswith("^") and len(v) == k + 1]
        if own:
            found.append(_among(_beginnings(words, k), own))
    hits = F.array_sort(F.concat(*found)) if found else F.array().cast("array<string>")
    keep = keep or ["doc_id"]
    met = docs.select(*keep, _words(F.col(text)).alias("_w")).select(
        *keep, F.size("_w").cast("long").alias("n_words"), hits.alias("_hits"))
    said = F.concat(F.array_distinct("_hits"), _often(F.col("_hits"), F.col("n_words")))
    return met.select(*keep, "n_words", F.size("_hits").alias("n_hits"),
                      F.array_sort(_among(said, sorted(voters))).alias("votes"))


class LabelModel:
    """Accuracies and correlations of voters that speak for the toxic class or abstain.

    Where voters speak, the odds are the product of theirs, each to the power of its discount; where all
    abstain, the class has its rate among such rows.
    """

    def __init__(self, accuracy: dict[str, float]):
        self.expected = accuracy
        self.accuracy = dict(accuracy)
        self.discount = {v: 1.0 for v in accuracy}

    def posterior(self, met: Column) -> Column:
        gain = {v: self.discount[v] * math.log(a / (1 - a)) for v, a in self.accuracy.items()}
        return F.when(F.size(met) == 0, F.lit(SILENT)).otherwise(_logistic(_summed(met, gain)))

    def fit(self, patterns: DataFrame) -> None:
        """``patterns (votes, n)``: how often each set of votes occurs. Only sums by voter come to the driver."""
        for step in range(EM_STEPS):
            weighed = patterns.where(F.size("votes") > 0).withColumn("p", self.posterior(F.col("votes")))
            sums = {r["v"]: (r["t"], r["n"]) for r in weighed.select(F.explode("votes").alias("v"), "n", "p").groupBy("v").agg(
                F.sum(F.col("n") * F.col("p")).alias("t"), F.sum("n").alias("n")).collect()}
            for v, start in self.expected.items():
                toxic, spoken = sums.get(v, (0.0, 0))
                accuracy = (toxic + PSEUDO_VOTES * start) / (spoken + PSEUDO_VOTES)
                self.accuracy[v] = min(max(accuracy, 0.51), 0.99)
            if step == EM_STEPS // 2:
                self._correlate(weighed)

    def _correlate(self, weighed: DataFrame) -> None:
        """Discount each voter by the sum of its correlations with others among toxic rows."""
        total = weighed.agg(F.sum(F.col("n") * F.col("p")).alias("t")).first()["t"]
        if not total:
            return
        pairs = weighed.select("n", "p", "votes", F.explode("votes").alias("a")).select(
            "n", "p", "a", F.explode("votes").alias("b")).where(F.col("a") <= F.col("b")).groupBy("a", "b").agg(
            F.sum(F.col("n") * F.col("p")).alias("t")).collect()  # at most one row for each two voters
        alone = {r["a"]: min(max(r["t"] / total, 1e-6), 1 - 1e-6) for r in pairs if r["a"] == r["b"]}
        excess = {v: 0.0 for v in self.expected}
        for r in pairs:
            if r["a"] != r["b"]:
                a, b = alone[r["a"]], alone[r["b"]]
                rho = (r["t"] / total - a * b) / math.sqrt(a * (1 - a) * b * (1 - b))
                for v in (r["a"], r["b"]):
                    excess[v] += max(0.0, rho - 0.1)
        self.discount = {v: 1 / (1 + x) for v, x in excess.items()}


def _logistic(x: Column) -> Column:
    x = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _summed(met: Column, weights: dict[str, float]) -> Column:
    """Sum of the weights of the voters in ``met``."""
    if not weights:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for item in sorted(weights.items()) for x in item])
    return F.aggregate(met, F.lit(0.0), lambda acc, v: acc + F.coalesce(F.element_at(table, v), F.lit(0.0)))


def _extra_features() -> list[Column]:
    """Besides the voters themselves: how many of them, and how dense they are."""
    distinct = F.size("votes")
    dense = F.log1p(100.0 * F.col("n_hits") / F.greatest(F.col("n_words"), F.lit(1)))
    return [F.least(distinct, F.lit(20)).cast("double"), dense]


def train_classifier(rows: DataFrame, voters: list[str]) -> tuple[dict[str, float], list[float]]:
    """(weight of each voter, [intercept, weights of the further features]) from ``rows`` with ``posterior``.

    A ridge-penalised logistic regression by Newton steps on at most ``MAX_TRAINING`` rows.
    """
    sample = rows.select("votes", *[c.alias(f"x{i}") for i, c in enumerate(_extra_features())], "posterior").collect()
    place = {v: i for i, v in enumerate(voters)}
    m = len(voters)
    x = np.zeros((len(sample), m + 3))
    for i, r in enumerate(sample):
        x[i, [place[v] for v in r["votes"]]] = 1
        x[i, m:] = 1, r["x0"], r["x1"]
    y = np.array([r["posterior"] for r in sample], float)
    w = np.zeros(m + 3)
    w[m] = -3
    ridge = np.full(m + 3, 1.0)
    ridge[m] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max(initial=0) < 1e-6:
            break
    return {v: float(w[i]) for v, i in place.items()}, [float(v) for v in w[m:]]


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) for each row of ``docs``.

    Labels are read from rows outside the held-out fold only, and never enter a score. Null and empty texts meet no
    voter and get the classifier's base score. Repeated rows are scored each, and alike. Without any label the
    list of known insults votes alone.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find_voters(docs, labels)
    accuracy = {**{v: EXPECTED for v in LEXICON}, **found}
    voters = sorted(accuracy)
    met = votes(docs, voters, keep=["doc_id"]).withColumn("held_out", held_out(F.col("doc_id")))
    table = settle(met, "votes")
    training = table.where(~F.col("held_out"))
    patterns = settle(training.groupBy("votes").agg(F.count("*").alias("n")), "patterns")
    model = LabelModel(accuracy)
    model.fit(patterns)
    sample = _drawn(training, MAX_TRAINING, "doc_id", "n_words").withColumn("posterior", model.posterior(F.col("votes")))
    weights, rest = train_classifier(sample, voters)
    extra = reduce(lambda a, b: a + b, [w * c for w, c in zip(rest[1:], _extra_features())])
    score = _logistic(F.lit(rest[0]) + extra + _summed(F.col("votes"), weights))
    return table.select("doc_id", "held_out", F.round(score, 9).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
