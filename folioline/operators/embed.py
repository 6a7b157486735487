"""Embedding of texts: a built-in hashed bag of words, and a hook for any other embedder."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioline.schema import NO_EMBEDDINGS
from folioline.functions.text import tokens
from folioline.session import ship_package

# Builds, once per Python worker, a function from a list of texts to one vector each.
EmbedderFactory = Callable[[], Callable[[list[str]], "list | np.ndarray"]]


def token_bucket(token: str, width: int) -> int:
    """Bucket 0 ... width-1 from the first 32 bits of the token's MD5."""
    return int.from_bytes(hashlib.md5(token.encode("utf-8"), usedforsecurity=False).digest()[:4], "big") % width


def _count_cells(words: pa.Array, width: int) -> np.ndarray:
    """Rows of tokens to a row-by-bucket matrix of counts.

    Within an Arrow batch each distinct token is hashed once and all are counted by one ``bincount``.
    """
    rows = len(words)
    lengths = np.asarray(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    encoded = words.flatten().dictionary_encode()
    buckets = np.array([token_bucket(t, width) for t in encoded.dictionary.to_pylist()], dtype=np.int64)
    flat = buckets[encoded.indices.to_numpy(zero_copy_only=False)]
    cells = np.repeat(np.arange(rows), lengths) * width + flat
    return np.bincount(cells, minlength=rows * width).reshape(rows, width)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def bucket_counts(text: Column, width: int) -> Column:
    """``array<int>`` of ``width`` token counts per hash bucket.

    Tokens are split in the JVM and counted in Arrow batches. The row stays where it is: no
    shuffle, whatever the length of the text.
    """

    ship_package()

    @F.arrow_udf("array<int>")
    def count(words: pa.Array) -> pa.Array:
        return _as_lists(_count_cells(words, width).astype(np.int32))

    # nondeterministic: else filters on the result would be pushed down as a second evaluation
    return count.asNondeterministic()(tokens(text))


def hashed_vector(text: Column, width: int) -> Column:
    """The counts scaled to length 1, as floats; all zero where the text has no token."""

    ship_package()

    @F.arrow_udf("array<float>")
    def scale(words: pa.Array) -> pa.Array:
        counts = _count_cells(words, width).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return _as_lists((counts / np.where(norms > 0, norms, 1.0)).astype(np.float32))

    return scale.asNondeterministic()(tokens(text))


def hash_embed(df: DataFrame, text_col: str, width: int, out: str = "embeddings") -> DataFrame:
    """Add the hashed bag of words."""
    return df.withColumn(out, hashed_vector(F.col(text_col), width))


def hashed_terms(df: DataFrame, keep: list[str], text_col: str, width: int) -> DataFrame:
    """The same in sparse form: ``(…, bucket, n)`` for each bucket in use."""
    counted = df.select(*keep, bucket_counts(F.col(text_col), width).alias("_counts"))
    return counted.select(*keep, F.posexplode("_counts").alias("bucket", "n")).where(F.col("n") > 0)


def embedder_udf(factory: EmbedderFactory):
    """Column function to ``struct<embeddings, error, seconds>``.

    The embedder gets whole Arrow batches. If a batch fails its texts are tried one by one, so
    that one bad text becomes one row with an error. Marked nondeterministic: Spark will not
    evaluate it twice or move filters below it.
    """

    ship_package()

    @F.pandas_udf("embeddings array<float>, error string, seconds double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        embedder = factory()
        for texts in batches:
            yield _embed_batch(embedder, texts)

    return run.asNondeterministic()


def _embed_batch(embedder, texts: pd.Series) -> pd.DataFrame:
    vectors: list = [None] * len(texts)
    errors: list = [None] * len(texts)
    start = time.monotonic()
    present = [i for i, text in enumerate(texts) if text is not None]
    try:
        answer = list(embedder([texts.iloc[i] for i in present])) if present else []
        if len(answer) != len(present):
            raise ValueError(NO_EMBEDDINGS)
        for i, vector in zip(present, answer):
            vectors[i] = np.asarray(vector, dtype=np.float32)
    except Exception:
        for i in present:
            try:
                answer = list(embedder([texts.iloc[i]]))
                if len(answer) != 1:
                    raise ValueError(NO_EMBEDDINGS)
                vectors[i], errors[i] = np.asarray(answer[0], dtype=np.float32), None
            except Exception as error:
                vectors[i], errors[i] = None, str(error) or type(error).__name__
    seconds = (time.monotonic() - start) / max(1, len(present))
    return pd.DataFrame({"embeddings": vectors, "error": errors, "seconds": seconds})


def embed(
    df: DataFrame, text_col: str, factory: EmbedderFactory, distinct: bool = False, slots: int | None = None
) -> DataFrame:
    """Add ``embeddings``, ``error`` and ``seconds``.

    ``slots`` spreads the texts over that many tasks, which is also how many calls run at a
    time. With ``distinct``, for an embedder dearer than a shuffle, equal texts are embedded
    once: texts collapse by hash before the shuffle, and only hash and vector are joined back,
    where Spark splits the partition of a text with very many copies.
    """
    run = embedder_udf(factory)
    if not distinct:
        spread = df.repartition(slots) if slots else df
        return spread.withColumn("_e", run(F.col(text_col))).select(
            *df.columns, "_e.embeddings", "_e.error", "_e.seconds")
    keyed = df.withColumn("_key", F.sha2(text_col, 256))
    texts = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min(text_col).alias("_text"))
    if slots:
        texts = texts.repartition(slots)
    vectors = texts.select("_key", run(F.col("_text")).alias("_e")).select("_key", "_e.*")
    return keyed.join(vectors, "_key", "left").select(*df.columns, "embeddings", "error", "seconds")
