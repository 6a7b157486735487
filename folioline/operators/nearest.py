"""Nearest pages by cosine similarity, exact.

The comparison is a matrix product over Arrow batches inside the tasks. No pair of page and
query ever becomes a row unless it is among the best ``k`` of its task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioline.operators.checks import check_dim
from folioline.operators.ranking import SLICE_ROWS, Best, blocks, column_values, top_k
from folioline.session import ship_package

# Up to this many query vectors are broadcast (4,096 x 1,536 doubles are 50 MB); more are shuffled.
BROADCAST_QUERIES = 4096
# Pages per block when both sides are shuffled.
BLOCK_ROWS = 16384


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list array as unit vectors in double precision; all-zero rows become NaN."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = len(vectors)
    if rows == 0:
        return np.empty((0, 0))
    width, rest = divmod(len(flat), rows)
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False))
    if rest or not (lengths == width).all():
        raise ValueError("vectors differ in width")
    matrix = flat.reshape(rows, width)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    norms[norms == 0] = np.nan
    return matrix / norms


def _compare(best: Best, ids: pa.Array, vectors: pa.Array, queries: np.ndarray) -> None:
    for start in range(0, len(ids) if len(queries) else 0, SLICE_ROWS):
        units = _matrix(vectors.slice(start, SLICE_ROWS))
        best.add(column_values(ids.slice(start, SLICE_ROWS)), units @ queries.T)


def _searched_width(pages: DataFrame, queries: DataFrame, vec_col: str, query_vec_col: str) -> int:
    """The width of the queries; if they have several, the one of most pages, of equals the one of most queries."""
    sizes = queries.where(F.size(query_vec_col) > 0).groupBy(F.size(query_vec_col).alias("width"))
    asked = {r["width"]: r["n"] for r in sizes.agg(F.count("*").alias("n")).collect()}
    if len(asked) < 2:
        return next(iter(asked), 0)
    found = pages.groupBy(F.size(vec_col).alias("width")).agg(F.count("*").alias("n"))
    stored = {r["width"]: r["n"] for r in found.collect()}
    return max(asked, key=lambda w: (stored.get(w, 0), asked[w], w))


def knn_rejects(
    pages: DataFrame,
    queries: DataFrame,
    width: int | None = None,
    id_col: str = "id",
    vec_col: str = "embeddings",
    query_id_col: str = "query_id",
    query_vec_col: str = "vector",
) -> DataFrame:
    """``(side, id, width)`` of the pages and queries that :func:`knn_cosine` leaves out for their width; NULL vectors have none."""
    width = width or _searched_width(pages, queries, vec_col, query_vec_col)
    odd = [check_dim(df, vec, width)[1].select(
        F.lit(side).alias("side"), F.col(key).cast("string").alias("id"), F.when(F.col(vec).isNotNull(), F.size(vec)).alias("width"))
        for side, df, key, vec in (("page", pages, id_col, vec_col), ("query", queries, query_id_col, query_vec_col))]
    return odd[0].unionByName(odd[1])


def knn_cosine(
    pages: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "embeddings",
    query_id_col: str = "query_id",
    query_vec_col: str = "vector",
    exclude_self: bool = False,
    method: str = "auto",
    broadcast_queries: int = BROADCAST_QUERIES,
    block_rows: int = BLOCK_ROWS,
    width: int | None = None,
) -> DataFrame:
    """``(query_id, id, similarity, rank)``: the ``k`` nearest pages of each query.

    ``auto`` broadcasts the queries after counting that there are at most ``broadcast_queries``
    of them; beyond, blocks of pages meet blocks of queries by shuffle. Both are exact. A vector
    that is NULL or all zero has no direction and is nobody's neighbour; nor is one without id, or of another width
    than ``width``: by default the queries' own or, if theirs differ, the one of most pages. :func:`knn_rejects` gives
    such vectors back.
    """
    ship_package(pages.sparkSession)
    queries = queries.where(F.col(query_id_col).isNotNull() & F.col(query_vec_col).isNotNull()).select(query_id_col, query_vec_col)
    width = width or _searched_width(pages, queries, vec_col, query_vec_col)
    queries = queries.where(F.size(query_vec_col) == width)
    pages = pages.where(F.col(id_col).isNotNull() & (F.size(vec_col) == width)).select(id_col, vec_col)
    # one more is kept where the query itself may be among the best
    want = k + 1 if exclude_self else k
    types = (pages.schema[id_col].dataType.simpleString(), queries.schema[query_id_col].dataType.simpleString())
    result_schema = f"`{query_id_col}` {types[1]}, `{id_col}` {types[0]}, similarity double"
    if method not in ("auto", "broadcast", "blocks"):
        raise ValueError(f"unknown method {method!r}")
    found = None
    if method != "blocks":
        head = queries.limit(broadcast_queries + 1).toArrow()
        if head.num_rows <= broadcast_queries:
            found = _by_broadcast(pages, head, want, query_id_col, result_schema)
        elif method == "broadcast":
            raise ValueError(f"more than {broadcast_queries} query vectors")
    if found is None:
        found = _by_blocks(pages, queries, want, result_schema, broadcast_queries, block_rows)
    if exclude_self:
        found = found.where(F.col(id_col) != F.col(query_id_col))
    return top_k(found, query_id_col, "similarity", id_col, k)


def _by_broadcast(pages: DataFrame, head: pa.Table, k: int, query_id_col: str, schema: str) -> DataFrame:
    query_ids = head.column(0).combine_chunks()
    shared = pages.sparkSession.sparkContext.broadcast((query_ids, _matrix(head.column(1))))
    names = [query_id_col, pages.columns[0], "similarity"]

    def best(batches):
        query_ids, matrix = shared.value
        state = Best(len(query_ids), k)
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            _compare(state, batch.column(0), batch.column(1), matrix)
        if state.ids is not None:
            yield pa.RecordBatch.from_arrays(state.rows(query_ids, id_type), names=names)

    return pages.mapInArrow(best, schema)


def _by_blocks(
    pages: DataFrame, queries: DataFrame, k: int, schema: str, query_rows: int, page_rows: int
) -> DataFrame:
    """Pages and queries are hashed into blocks of bounded size, and each task compares one pair of blocks."""
    n_query_blocks = max(1, math.ceil(queries.count() / query_rows))
    n_page_blocks = max(1, math.ceil(pages.count() / page_rows))
    id_col, vec_col = pages.columns
    query_id_col, query_vec_col = queries.columns
    names = [query_id_col, id_col, "similarity"]

    left = pages.select(
        id_col, vec_col,
        F.pmod(F.xxhash64(id_col), F.lit(n_page_blocks)).cast("int").alias("_p"), blocks(n_query_blocks).alias("_q"))
    right = queries.select(
        query_id_col, query_vec_col,
        F.pmod(F.xxhash64(query_id_col), F.lit(n_query_blocks)).cast("int").alias("_q"),
        blocks(n_page_blocks).alias("_p"))

    def best(page_block: pa.Table, query_block: pa.Table) -> pa.Table:
        query_ids = query_block.column(query_id_col).combine_chunks()
        page_ids = page_block.column(id_col).combine_chunks()
        state = Best(len(query_ids), k)
        if len(query_ids) and len(page_ids):
            matrix = _matrix(query_block.column(query_vec_col))
            _compare(state, page_ids, page_block.column(vec_col).combine_chunks(), matrix)
        return pa.table(state.rows(query_ids, page_ids.type), names=names)

    return left.groupBy("_p", "_q").cogroup(right.groupBy("_p", "_q")).applyInArrow(best, schema)
