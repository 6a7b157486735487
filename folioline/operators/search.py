"""Full-text and nearest-neighbour search over pages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioline.fixed import BM25_B, BM25_K1
from folioline.functions.text import tokens
from folioline.operators.ranking import PAGE_BLOCK, QUERY_BLOCK, bm25_by_blocks, bm25_by_broadcast, top_k
from folioline.session import small_frame

# Sizes of a query set, in (query, term) pairs, up to which it is part of the plan or broadcast.
INLINE_TERMS = 64
BROADCAST_PAIRS = 32768


def analyze_tokens(
    df: DataFrame, keep: list[str], text_col: str = "text", stem_map: DataFrame | None = None, out: str = "token"
) -> DataFrame:
    """One row per token occurrence. With ``stem_map(token, stem)`` a token is replaced by its stem
    where it has one.

    The map is joined as it is: Spark broadcasts it only while it is under the broadcast
    threshold and splits hot tokens otherwise.
    """
    occurrences = df.select(*keep, F.explode(tokens(F.col(text_col))).alias(out))
    if stem_map is None:
        return occurrences
    stems = stem_map.select(F.col("token").alias(out), "stem").dropDuplicates([out])
    return occurrences.join(stems, out, "left").select(*keep, F.coalesce("stem", out).alias(out))


def build_stem_map(df: DataFrame, stemmer: Column, text_col: str = "text") -> DataFrame:
    """``(token, stem)`` over the distinct vocabulary; ``stemmer`` is an expression on ``token``,
    so that it is worked out once per distinct token, not once per occurrence."""
    vocabulary = df.select(F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("token")).distinct()
    return vocabulary.withColumn("stem", stemmer)


def term_stats(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, df)``: number of pages with the term. A page counts a term once before any shuffle."""
    return (
        pages.select(F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df"))
    )


def length_stats(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: number of pages, of tokens, and their ratio."""
    return pages.select(F.size(tokens(F.col(text_col))).alias("len")).agg(
        F.count("*").alias("n_pages"),
        F.coalesce(F.sum("len"), F.lit(0)).alias("n_tokens"),
        F.avg("len").alias("avg_len"),
    )


def _idf(n: Column, df: Column) -> Column:
    return F.log(1.0 + (n - df + 0.5) / (df + 0.5))


def _saturated(tf: Column, length: Column, avg_len: Column, k1: float, b: float) -> Column:
    # no page has a word where the mean length is 0
    return tf * (k1 + 1.0) / (tf + k1 * ((1.0 - b) + b * F.try_divide(length.cast("double"), avg_len)))


def bm25_topk(
    pages: DataFrame,
    queries: Mapping[str, Iterable[str]] | DataFrame,
    k: int,
    id_col: str = "id",
    text_col: str = "text",
    k1: float = BM25_K1,
    b: float = BM25_B,
    inline_terms: int = INLINE_TERMS,
    broadcast_pairs: int = BROADCAST_PAIRS,
    query_rows: int = QUERY_BLOCK,
    page_rows: int = PAGE_BLOCK,
    stemmer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``(query_id, id, score, rank)``: the ``k`` best pages of each query.

    With ``stemmer`` (a column expression on one token, such as :func:`folioline.functions.text.s_stem`) every word of a page and
    every query term is replaced by its stem before term counts, document frequencies and lengths are taken, in all three routes:
    the forms of one stem share one tf, one df and one saturation.

    ``queries`` maps a query id to its terms, or is a frame ``(query_id, term)``. Up to
    ``inline_terms`` (query, term) pairs are written into the plan and scored in the JVM; up to
    ``broadcast_pairs`` are broadcast and scored as a matrix product per Arrow batch; beyond, blocks
    of pages meet blocks of queries by shuffle. All three are exact, and in none does a page that is not
    among the best of its task leave it. In all, a page without id is not part of the collection, a NULL text
    has no words, and a query or term that is NULL asks for nothing.
    """
    if not isinstance(queries, DataFrame):
        pairs = [(query, term) for query, terms in queries.items() if query is not None
                 for term in sorted({t for t in terms if t is not None})]
        if not pairs:
            raise ValueError("no query terms")
        if stemmer is not None:
            asked = small_frame(pages.sparkSession, pairs, ["query_id", "term"])
            pairs = sorted({tuple(r) for r in asked.select("query_id", stemmer(F.col("term")).alias("term")).collect()})
    else:
        queries = queries.select("query_id", "term").where("query_id is not null and term is not null")
        if stemmer is not None:
            queries = queries.select("query_id", stemmer(F.col("term")).alias("term"))
        queries = queries.distinct()
        pairs = [tuple(row) for row in queries.limit(broadcast_pairs + 1).collect()]
    words = tokens(F.coalesce(F.col(text_col), F.lit("")))
    if stemmer is not None:
        words = F.transform(words, stemmer)
    words = pages.where(F.col(id_col).isNotNull()).select(id_col, words.alias("_words"))
    if not isinstance(queries, DataFrame) and len(pairs) > inline_terms:
        queries = small_frame(pages.sparkSession, pairs, ["query_id", "term"])
    if len(pairs) > broadcast_pairs:
        return top_k(bm25_by_blocks(words, queries, k, id_col, k1, b, query_rows, page_rows), "query_id", "score", id_col, k)
    if len(pairs) > inline_terms:
        return top_k(bm25_by_broadcast(words, queries, k, id_col, k1, b), "query_id", "score", id_col, k)
    wanted: dict = {}
    for query, term in sorted(pairs):
        wanted.setdefault(query, []).append(term)
    return _bm25_inline(words, wanted, k, id_col, k1, b)


def _equals(term: str):
    return lambda word: word == term


def _bm25_inline(words, wanted, k, id_col, k1, b) -> DataFrame:
    vocabulary = sorted({term for terms in wanted.values() for term in terms})
    hits = words.select(id_col, F.size("_words").alias("_len"),
                        F.filter("_words", lambda w: w.isin(vocabulary)).alias("_hits"))
    tf_names = [f"_tf{i}" for i in range(len(vocabulary))]
    counted = hits.select(id_col, "_len", *[
        F.size(F.filter("_hits", _equals(term))).cast("double").alias(name)
        for name, term in zip(tf_names, vocabulary)
    ])
    # one row, one pass: page count, mean length and every document frequency
    stats = counted.agg(F.struct(
        F.count("*").cast("double").alias("n"),
        F.avg("_len").alias("avg_len"),
        F.array(*[F.count_if(F.col(name) > 0).cast("double") for name in tf_names]).alias("df"),
    ).alias("s"))
    # no filter before the scores: pushed down it would split each text again for every term
    scored = counted.withColumn("_s", stats.scalar())
    parts = {
        term: _idf(F.col("_s.n"), F.get("_s.df", F.lit(i)))
        * _saturated(F.col(tf_names[i]), F.col("_len"), F.col("_s.avg_len"), k1, b)
        for i, term in enumerate(vocabulary)
    }
    per_query = F.explode(F.array(*[
        F.struct(F.lit(query).alias("query_id"),
                 reduce(lambda x, y: x + y, [parts[t] for t in terms]).alias("score"))
        for query, terms in wanted.items()
    ]))
    scores = scored.select(id_col, per_query.alias("q")).select("q.query_id", id_col, "q.score")
    return top_k(scores.where(F.col("score") > 0), "query_id", "score", id_col, k)


def expand_terms(terms: Iterable[str], stem_map: DataFrame) -> DataFrame:
    """``(term)``: every token with the stem of one of ``terms``, and the terms themselves."""
    asked = small_frame(stem_map.sparkSession, [(t,) for t in sorted(set(terms))], ["token"])
    stems = asked.join(stem_map, "token", "left").select(F.coalesce("stem", "token").alias("stem")).distinct()
    related = stem_map.join(stems, "stem", "left_semi").select("token")
    return related.unionByName(asked).distinct().withColumnRenamed("token", "term")
