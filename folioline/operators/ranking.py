"""Best ``k`` per query, and BM25 for query sets too large to be part of a plan."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from folioline.session import ship_package

# Ranking compares scores at this many decimals, so that equal pages tie whatever the summing order.
SCORE_DECIMALS = 9
# Rows scored at a time, queries per block, and pages per block when both sides are shuffled.
SLICE_ROWS = 2048
QUERY_BLOCK = 256
PAGE_BLOCK = 16384
# Largest dense page-by-term block, in cells.
DENSE_CELLS = 4_000_000


def top_k(df: DataFrame, group_col: str, score_col: str, id_col: str, k: int, rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per group, by score and then id.

    Spark keeps ``k`` rows per group in each map task already, so only those meet.
    """
    order = Window.partitionBy(group_col).orderBy(F.round(score_col, SCORE_DECIMALS).desc(), F.col(id_col))
    return df.withColumn(rank_col, F.row_number().over(order)).where(F.col(rank_col) <= k)


def blocks(n: int) -> Column:
    """One row per block number."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def column_values(array: pa.Array) -> np.ndarray:
    return np.asarray(array.to_numpy(zero_copy_only=False))


class Best:
    """Running best ``k`` per query inside a task, ties to the smaller id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        # rounded score a page has to reach, per query
        self.floor = np.full(n_queries, -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.ids = None

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per page and a column per query; NaN means no match."""
        ranked = np.round(scores, SCORE_DECIMALS)
        ranked[np.isnan(ranked)] = -np.inf
        if len(ranked) >= self.k:
            cut = np.partition(ranked, len(ranked) - self.k, axis=0)[len(ranked) - self.k]
            np.maximum(self.floor, cut, out=self.floor)
        row, query = np.nonzero((ranked >= self.floor) & np.isfinite(ranked))
        if len(row) == 0:
            return
        self.query = np.concatenate([self.query, query])
        self.score = np.concatenate([self.score, scores[row, query]])
        self.ids = ids[row] if self.ids is None else np.concatenate([self.ids, ids[row]])
        self._shrink()

    def _shrink(self) -> None:
        ranked = np.round(self.score, SCORE_DECIMALS)
        place = np.unique(self.ids, return_inverse=True)[1].ravel()
        order = np.lexsort((place, -ranked, self.query))
        query = self.query[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        last = order[nth == self.k - 1]
        self.floor[self.query[last]] = np.maximum(self.floor[self.query[last]], ranked[last])
        keep = order[nth < self.k]
        self.query, self.score, self.ids = self.query[keep], self.score[keep], self.ids[keep]

    def rows(self, query_ids: pa.Array, id_type: pa.DataType) -> list[pa.Array]:
        """Columns query id, page id, score."""
        ids = [] if self.ids is None else self.ids
        return [query_ids.take(pa.array(self.query, type=pa.int64())), pa.array(ids, type=id_type),
                pa.array(self.score, type=pa.float64())]


class QueryBlock:
    """Queries of one block: their ids, the terms they use and a term-by-query matrix of weights."""

    def __init__(self, query_ids: pa.Array, terms: pa.Array, weights: pa.Array):
        """``terms`` and ``weights`` are list arrays with a row per query."""
        self.query_ids = query_ids
        flat = terms.flatten()
        self.vocabulary = pc.unique(flat)
        place = pc.index_in(flat, value_set=self.vocabulary).to_numpy(zero_copy_only=False)
        query = np.repeat(np.arange(len(query_ids)), terms.value_lengths().to_numpy(zero_copy_only=False))
        self.weights = np.zeros((len(self.vocabulary), len(query_ids)))
        self.weights[place, query] = weights.flatten().to_numpy(zero_copy_only=False)

    def score_into(self, best: Best, ids: pa.Array, words: pa.Array, avg_len: float, k1: float, b: float) -> None:
        step = max(1, min(SLICE_ROWS, DENSE_CELLS // max(1, len(self.vocabulary))))
        for start in range(0, len(ids), step):
            self._score_slice(best, ids.slice(start, step), words.slice(start, step), avg_len, k1, b)

    def _score_slice(self, best, ids, words, avg_len, k1, b) -> None:
        n, width = len(ids), len(self.vocabulary)
        lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        place = pc.index_in(words.flatten(), value_set=self.vocabulary)
        known = place.is_valid().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(n), lengths)[known]
        cell = row * width + place.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = np.bincount(cell, minlength=n * width).reshape(n, width).astype(np.float64)
        # a page without words has no term either: 0 / 0 is no match
        with np.errstate(invalid="ignore", divide="ignore"):
            scale = k1 * ((1.0 - b) + b * lengths[:, None] / np.float64(avg_len))
            saturated = np.where(tf > 0, tf * (k1 + 1.0) / (tf + scale), 0.0)
        scores = saturated @ self.weights
        scores[scores <= 0] = np.nan
        best.add(column_values(ids), scores)


def _weighted_queries(words: DataFrame, queries: DataFrame) -> tuple[DataFrame, float]:
    """(``(query_id, terms, weights)``, mean page length). A row holds the terms of one query.

    Document frequencies are summed per task before the query terms are picked, each page counting a term once: what is
    shuffled is one row per task and term.
    """
    totals = words.agg(F.count("*").cast("double").alias("n"), F.avg(F.size("_words")).alias("avg_len")).first()
    frequency = (
        words.select(F.explode(F.array_distinct("_words")).alias("term"))
        .groupBy("term").agg(F.count("*").cast("double").alias("df"))
    )
    weight = F.log(1.0 + (F.lit(totals["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = (
        queries.join(frequency, "term").groupBy("query_id")
        .agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("t"))
        .select("query_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    )
    return weighted, totals["avg_len"] or 0.0


def _schema(words: DataFrame, queries: DataFrame, id_col: str) -> str:
    query_type = queries.schema["query_id"].dataType.simpleString()
    return f"query_id {query_type}, `{id_col}` {words.schema[id_col].dataType.simpleString()}, score double"


def bm25_by_broadcast(words: DataFrame, queries: DataFrame, k: int, id_col: str, k1: float, b: float) -> DataFrame:
    """Best ``k`` pages per query and task; the caller has checked the size of ``queries``."""
    ship_package(words.sparkSession)
    weighted, avg_len = _weighted_queries(words, queries)
    table = weighted.toArrow().combine_chunks()
    columns = [table.column(i).combine_chunks() for i in range(3)]
    parts = [
        QueryBlock(*[column.slice(start, QUERY_BLOCK) for column in columns])
        for start in range(0, table.num_rows, QUERY_BLOCK)
    ]
    shared = words.sparkSession.sparkContext.broadcast(parts)
    names = ["query_id", id_col, "score"]

    def best(batches):
        parts = shared.value
        states = [Best(len(part.query_ids), k) for part in parts]
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for part, state in zip(parts, states):
                part.score_into(state, batch.column(0), batch.column(1), avg_len, k1, b)
        for part, state in zip(parts, states):
            if state.ids is not None:
                yield pa.RecordBatch.from_arrays(state.rows(part.query_ids, id_type), names=names)

    return words.mapInArrow(best, _schema(words, queries, id_col))


def bm25_by_blocks(
    words: DataFrame, queries: DataFrame, k: int, id_col: str, k1: float, b: float,
    query_rows: int = QUERY_BLOCK, page_rows: int = PAGE_BLOCK,
) -> DataFrame:
    """The same where the queries are too many to be sent to every task: each page travels once, the queries to each block of pages.

    Pages are hashed into blocks of about ``page_rows``. A block's pages and a copy of all queries are sorted into one stream,
    pages first; a task holds the pages of one block and ``query_rows`` queries at a time. Words travel as one text, which
    takes less room than a list of them.
    """
    ship_package(words.sparkSession)
    weighted, avg_len = _weighted_queries(words, queries)
    n_page_blocks = max(1, math.ceil(words.count() / page_rows))
    left = words.select(
        F.pmod(F.xxhash64(id_col), F.lit(n_page_blocks)).cast("int").alias("_block"), F.lit(False).alias("_is_query"),
        F.col(id_col).alias("_id"), F.when(F.size("_words") > 0, F.array_join("_words", " ")).alias("_text"),
        *[F.lit(None).cast(weighted.schema[c].dataType).alias(c) for c in weighted.columns])
    right = weighted.select(
        blocks(n_page_blocks).alias("_block"), F.lit(True).alias("_is_query"),
        F.lit(None).cast(words.schema[id_col].dataType).alias("_id"), F.lit(None).cast("string").alias("_text"), "*")
    names = ["query_id", id_col, "score"]

    def scored(pages: list[pa.RecordBatch], asked: list[pa.RecordBatch]) -> pa.RecordBatch:
        pages, asked = (pa.Table.from_batches(part).combine_chunks() for part in (pages, asked))
        ids, texts, query_ids, terms, weights = (
            table.column(name).combine_chunks() for table, name in
            ((pages, "_id"), (pages, "_text"), (asked, "query_id"), (asked, "terms"), (asked, "weights")))
        state = Best(len(query_ids), k)
        QueryBlock(query_ids, terms, weights).score_into(state, ids, pc.split_pattern(texts, " "), avg_len, k1, b)
        return pa.RecordBatch.from_arrays(state.rows(query_ids, ids.type), names=names)

    def best(batches):
        block, pages, asked, n_asked = None, [], [], 0
        for batch in batches:
            numbers, is_query = (column_values(batch.column(i)).astype(np.int64) for i in (0, 1))
            cuts = np.flatnonzero(np.diff(2 * numbers + is_query)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                if start == end:
                    continue
                if numbers[start] != block:
                    if pages and asked:
                        yield scored(pages, asked)
                    block, pages, asked, n_asked = numbers[start], [], [], 0
                if not is_query[start]:
                    pages.append(batch.slice(start, end - start))
                    continue
                while pages and start < end:
                    part = batch.slice(start, min(end - start, query_rows - n_asked))
                    asked.append(part)
                    start, n_asked = start + len(part), n_asked + len(part)
                    if n_asked == query_rows:
                        yield scored(pages, asked)
                        asked, n_asked = [], 0
        if pages and asked:
            yield scored(pages, asked)

    stream = left.unionByName(right).repartition("_block").sortWithinPartitions("_block", "_is_query")
    return stream.mapInArrow(best, _schema(words, queries, id_col))
