"""Quality rules: fixed rules on word statistics, then robust multivariate outliers.

The second part is the minimum-covariance-determinant estimate for each language and source: concentration
steps keep the half of a group's rows that lies nearest to the current centre and estimate centre and covariance
anew from them. A row whose Mahalanobis distance from the last estimate is beyond the cutoff goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioline.llm import arrays, rows
from folioline.session import settle, ship_package

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Features are counted in steps of 1/256, so that sums over any number of rows are exact in any order.
GRID = 256
FEATURES = ["word_length", "symbols", "dup_lines", "repeats"]
#: Least standard deviation of a feature, in its own units: rates that are 0 nearly everywhere have none.
FLOORS = [0.15, 0.15, 0.3, 0.3]
STEPS = 4
#: A group of fewer rows is pooled with the others of its language, then with all.
MIN_GROUP = 100
#: Quantiles of chi square with four degrees of freedom: 0.5 and 1 - 1e-6.
CHI_MEDIAN, CHI_CUTOFF = 3.357, 33.377
#: Distances are binned by their logarithm; so many bins to a factor of two.
BINS = 16

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _stats_of(t: arrays.Texts) -> np.ndarray:
    """One row per text, columns as in :data:`STATS`."""
    inside = ~arrays.SPACES[t.data]
    begins, ends = arrays.runs(inside, t.offsets)
    n_words = arrays.counts_by_text(begins, t.offsets)
    chars = t.per_text(inside & ((t.data & 0xC0) != 0x80))
    symbols = t.per_text(_SYMBOLS[t.data])
    sums = arrays.prefix_hashes(t.data)

    # lines with a word
    line_begins, line_ends = arrays.runs(t.data != 10, t.offsets)
    worded = np.searchsorted(begins, line_ends) > np.searchsorted(begins, line_begins)
    line_begins, line_ends = line_begins[worded], line_ends[worded]
    hashes = arrays.span_hashes(sums, line_begins, line_ends)
    edges = np.searchsorted(line_begins, t.offsets)
    dup_lines = [b - a - len(np.unique(hashes[a:b])) for a, b in zip(edges[:-1], edges[1:])]

    windows = arrays.window_hashes(arrays.span_hashes(sums, begins, ends), WINDOW)
    edges = np.concatenate([[0], np.cumsum(n_words)])
    repeated = [_covered(windows[a:max(a, b - WINDOW + 1)]) for a, b in zip(edges[:-1], edges[1:])]
    return np.stack([n_words, chars, symbols, dup_lines, repeated], 1).astype(np.int64).reshape(len(t), 5)


def _covered(windows: np.ndarray) -> int:
    """Words in windows that occur twice or more."""
    if len(windows) < 2:
        return 0
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    marks = np.zeros(len(windows) + WINDOW, np.int64)
    twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    marks[twice] += 1
    marks[twice + WINDOW] -= 1  # each start occurs once
    return int((np.cumsum(marks) > 0).sum())


def word_stats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) and the five counts of :data:`STATS` for each row.

    A null text has no words. Whole texts, one run of rows at a time.
    """
    ship_package(docs.sparkSession)
    keep = keep or ["doc_id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_stats_of(t) for t in arrays.texts_of(batch.column(0))]
            table = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays(
                batch.columns[1:] + [pa.array(table[:, k]) for k in range(5)], batch.schema.names[1:] + STATS)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{c} long" for c in STATS])
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def _features() -> list[Column]:
    """Transformed statistics on the grid; rates by square root, so that their spread depends less on their size."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = [4 * F.log2(1 + F.col("word_chars") / words), 2 * F.sqrt(F.col("n_symbols") / words),
           2 * F.sqrt(F.least(F.lit(1.0), 4 * F.col("n_dup_lines") / words)), 2 * F.sqrt(F.col("n_repeat_words") / words)]
    return [F.round(F.least(x, F.lit(64.0)) * GRID).cast("long").alias(f) for x, f in zip(raw, FEATURES)]


_P = len(FEATURES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_MOMENTS = [f"s{i}" for i in range(_P)] + [f"q{i}_{j}" for i, j in _PAIRS]


def _moments() -> list[Column]:
    x = [F.col(f) for f in FEATURES]
    sums = x + [x[i] * x[j] for i, j in _PAIRS]
    return [F.sum(c).alias(m) for c, m in zip(sums, _MOMENTS)]


def _estimates(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and inverse covariance of each row of moment sums."""
    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n = frame["n"].to_numpy(float)
            centre = frame[_MOMENTS[:_P]].to_numpy(float) / n[:, None] / GRID
            cov = np.empty((len(frame), _P, _P))
            for name, (i, j) in zip(_MOMENTS[_P:], _PAIRS):
                cov[:, i, j] = cov[:, j, i] = frame[name].to_numpy(float) / n / GRID**2 - centre[:, i] * centre[:, j]
            cov += np.diag(np.square(FLOORS))
            inverse = np.linalg.inv(cov)
            yield frame[keys].assign(centre=list(centre), inverse=list(inverse.reshape(len(frame), -1)))

    return moments.mapInPandas(solve, ", ".join([f"{k} string" for k in keys] + [
        "centre array<double>", "inverse array<double>"]))


def _distance() -> Column:
    """Squared Mahalanobis distance from the joined ``centre`` and ``inverse``."""
    delta = [F.col(f) / GRID - F.col("centre")[i] for i, f in enumerate(FEATURES)]
    terms = [F.col("inverse")[i * _P + j] * delta[i] * delta[j] * (1 if i == j else 2) for i, j in _PAIRS]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.greatest(total, F.lit(0.0))


def outliers(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``stats`` (with the five counts) plus ``distance`` (double) and ``outlier`` (boolean).

    Each concentration step is one aggregation by group and bin of distance, combined in the tasks before
    the shuffle, so a group of any size is no matter. Half of a group is taken by whole bins. Distances are scaled
    so that their median is that of chi square. Rows of a null language or source form groups of their own;
    while fewer than ``MIN_GROUP`` rows are there in all, nothing is an outlier and the distance is null.
    """
    spark = stats.sparkSession
    ship_package(spark)
    lang_key, source_key = F.coalesce(F.col(lang), F.lit("\0")), F.coalesce(F.col(source), F.lit("\0"))
    table = stats.select("*", lang_key.alias("_lang"), source_key.alias("_source"), *_features())

    sizes = settle(table.where(~base_failed()).groupBy("_lang", "_source").count(), "groups")
    pooled = sizes.withColumn("_group", F.when(F.col("count") >= MIN_GROUP, F.concat_ws("\1", "_lang", "_source")))
    small = pooled.where(F.col("_group").isNull())
    langs = small.groupBy("_lang").agg(F.sum("count").alias("_n")).withColumn(
        "_pool", F.when(F.col("_n") >= MIN_GROUP, F.col("_lang")).otherwise(F.lit("\1")))
    groups = settle(pooled.join(langs, "_lang", "left").select(
        "_lang", "_source", F.coalesce("_group", "_pool").alias("_group")), "groups")

    # rows that the fixed rules reject have no say in the estimates; rows of an unseen group take the common pool
    table = settle(table.join(groups, ["_lang", "_source"], "left").withColumn(
        "_group", F.coalesce("_group", F.lit("\1"))), "features")
    inner = table.where(~base_failed()).select("_group", *FEATURES)
    estimates = _estimates(
        inner.groupBy("_group").agg(F.count("*").alias("n"), *_moments()).where(F.col("n") >= MIN_GROUP), ["_group"])
    estimates = settle(estimates, "estimates")
    best = None
    for _ in range(STEPS):
        binned = inner.join(estimates, "_group").withColumn(
            "_bin", F.floor(F.log2(F.greatest(_distance(), F.lit(2.0**-20))) * BINS))
        bins = binned.groupBy("_group", "_bin").agg(F.count("*").alias("n"), *_moments())
        best = settle(bins, "bins")
        nearest = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        all_rows = Window.partitionBy("_group")
        # at most a few hundred bins a group
        half = best.withColumn("_before", F.coalesce(F.sum("n").over(nearest), F.lit(0))).withColumn(
            "_all", F.sum("n").over(all_rows)).where(2 * F.col("_before") < F.col("_all"))
        sums = half.groupBy("_group").agg(*[F.sum(c).alias(c) for c in ["n", *_MOMENTS]])
        estimates = settle(_estimates(sums, ["_group"]), "estimates")

    last = inner.join(estimates, "_group").withColumn(
        "_bin", F.floor(F.log2(F.greatest(_distance(), F.lit(2.0**-20))) * BINS))
    before = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    medians = last.groupBy("_group", "_bin").count().withColumn(
        "_before", F.coalesce(F.sum("count").over(before), F.lit(0))).withColumn(
        "_all", F.sum("count").over(Window.partitionBy("_group"))).where(
        2 * F.col("_before") < F.col("_all")).groupBy("_group").agg(F.max("_bin").alias("_median"))
    # a scale of at least 1: where the floors make up most of the spread, distances are not blown up
    scaled = settle(estimates.join(medians, "_group").withColumn(
        "_scale", F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("_median") + 1) / BINS) / CHI_MEDIAN)), "estimates")
    judged = table.join(scaled, "_group", "left").withColumn("distance", _distance() / F.col("_scale"))
    return judged.withColumn("outlier", F.coalesce(F.col("distance") > CHI_CUTOFF, F.lit(False))).select(
        *stats.columns, "distance", "outlier")


def quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
            lang: str = "lang", source: str = "source") -> DataFrame:
    """``keep`` (default ``doc_id``), the five counts, ``base_failed``, ``distance`` and ``kept`` for each row.

    Empty and null texts fail the fixed rules. Rows that occur repeatedly are judged each, and alike. No
    table is too small: see :func:`outliers`.
    """
    keep = keep or ["doc_id"]
    renamed = docs.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_l"),
                          F.col(source).cast("string").alias("_s"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    names = [f"_keep{i}" for i in range(len(keep))]
    stats = settle(word_stats(renamed, "_text", ["_l", "_s", *names]), "stats")
    judged = outliers(stats, "_l", "_s").withColumn("base_failed", base_failed())
    return judged.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], *STATS, "base_failed", "distance",
                         (~F.col("base_failed") & ~F.col("outlier")).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs (doc_id, text, lang, source, ...)`` that :func:`quality` keeps, all columns as they were.

    Repeated rows share their fate, as it follows from text, language and source.
    """
    keyed = rows.packed(docs, "text", "lang", "source").select(
        "doc_id", "key", F.col("row.text").alias("text"), F.col("row.lang").alias("lang"), F.col("row.source").alias("source"))
    bad = settle(quality(keyed, keep=["doc_id", "key"]).where(~F.col("kept")).select("doc_id", "key").distinct(), "rejected")
    return rows.without(docs, bad, "text", "lang", "source")
