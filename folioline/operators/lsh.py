"""Approximate nearest pages by cosine similarity: a random-hyperplane index with several tables and multi-probe.

Each table has ``bits`` hyperplanes through the pages' mean; a vector's bucket in a table is the side of each plane it lies on.
Every page is indexed in every table. A query looks in its own bucket of each table and in the buckets that differ from it in
the bits where it lies closest to the plane (``probes`` of them, nearest first). Pages and the queries that look into a
bucket meet in one cogroup group, where similarities are a matrix product and only the best ``k`` of each query leave the
task; no pair of page and query becomes a row. A bucket that holds more than ``sub_block_rows`` pages is cut into sub-blocks by a
hash of the page id, and its queries visit each sub-block, so that a very common vector does not land all in one task.

The mean and the planes are the only state on the driver: ``width`` numbers and ``tables x bits x width`` numbers. Recall against
:func:`folioline.operators.nearest.knn_cosine` is measured in tests/test_lsh.py.

Cases: a NULL or all-zero vector has no direction and is nobody's neighbour; vectors without id, or of another width than
``width`` (by default the queries', see ``knn_cosine``), take no part; pages of one id count once per query (the best
similarity); ties go to the smaller id; no pages or no queries give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioline.operators.nearest import _matrix, _searched_width
from folioline.operators.ranking import Best, column_values, top_k
from folioline.session import ship_package

TABLES, PROBES, SEED = 8, 16, 20240607
#: Bits of a table: log2 of pages per BUCKET_ROWS, within these bounds. More pages, more buckets, same pages a bucket.
BUCKET_ROWS, MIN_BITS, MAX_BITS = 512, 4, 16
#: Pages of one bucket that one group compares at most.
SUB_BLOCK_ROWS = 4096


def _bits(n_pages: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, round(math.log2(max(1, n_pages) / BUCKET_ROWS))))


def _planes(tables: int, bits: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables * bits, width))


def _mean(pages: DataFrame, vec_col: str, width: int) -> np.ndarray:
    """Mean of the page vectors: one sum a task, added on the driver."""
    def sums(batches):
        total, n = np.zeros(width), 0
        for batch in batches:
            vectors = batch.column(0)
            if len(vectors):
                flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), width)
                total += np.nan_to_num(flat).sum(0)
                n += len(vectors)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([n])], names=["s", "n"])

    parts = pages.select(vec_col).mapInArrow(sums, "s array<double>, n long").collect()
    n = sum(r["n"] for r in parts)
    return np.sum([r["s"] for r in parts], axis=0) / n if n else np.zeros(width)


def _codes(projections: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket of each row in each table, ``(rows, tables)``."""
    signs = (projections > 0).reshape(len(projections), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(2)


def _probe_codes(projections: np.ndarray, tables: int, bits: int, probes: int) -> np.ndarray:
    """Buckets each query looks into, ``(rows, tables, 1 + probes)``: its own, then single and double flips of its least sure bits."""
    codes = _codes(projections, tables, bits)
    margin = np.abs(projections).reshape(len(projections), tables, bits)
    unsure = np.argsort(margin, axis=2)
    flips = [(i,) for i in range(bits)] + [(i, j) for i in range(bits) for j in range(i + 1, bits)]
    # flip sets in the order of their summed margins would be best; the order by rank of the bits is close and fixed
    flips = sorted(flips, key=lambda f: (sum(x * x for x in f), f))[:probes]
    out = np.empty((len(projections), tables, 1 + len(flips)), np.int64)
    out[:, :, 0] = codes
    for p, flip in enumerate(flips, 1):
        mask = np.zeros((len(projections), tables), np.int64)
        for rank in flip:
            mask |= 1 << unsure[:, :, rank]
        out[:, :, p] = codes ^ mask
    return out


def knn_lsh(
    pages: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "embeddings",
    query_id_col: str = "query_id",
    query_vec_col: str = "vector",
    exclude_self: bool = False,
    tables: int = TABLES,
    probes: int = PROBES,
    bits: int | None = None,
    seed: int = SEED,
    sub_block_rows: int = SUB_BLOCK_ROWS,
    width: int | None = None,
) -> DataFrame:
    """``(query_id, id, similarity, rank)``: the ``k`` nearest pages of each query that the index finds."""
    spark = pages.sparkSession
    ship_package(spark)
    queries = queries.where(F.col(query_id_col).isNotNull() & F.col(query_vec_col).isNotNull()).select(query_id_col, query_vec_col)
    width = width or _searched_width(pages, queries, vec_col, query_vec_col)
    queries = queries.where(F.size(query_vec_col) == width)
    pages = pages.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) == width)).select(id_col, vec_col)
    bits = bits or _bits(pages.count())
    centre = _mean(pages, vec_col, width) if width else np.zeros(0)
    planes = _planes(tables, bits, width, seed)
    shared = spark.sparkContext.broadcast((centre, planes))
    want = k + 1 if exclude_self else k
    id_type, query_type = pages.schema[id_col].dataType.simpleString(), queries.schema[query_id_col].dataType.simpleString()

    def projected(vectors: pa.Array) -> np.ndarray:
        centre, planes = shared.value
        flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), -1)
        return (np.nan_to_num(flat) - centre) @ planes.T

    def page_buckets(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _codes(projected(batch.column(1)), tables, bits)
            rows = np.repeat(np.arange(batch.num_rows), tables)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(tables, dtype=np.int32), batch.num_rows)), pa.array(codes.reshape(-1)),
                batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))], names=["_t", "_b", "_id", "_v"])

    def query_buckets(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _probe_codes(projected(batch.column(1)), tables, bits, probes)
            n, per = batch.num_rows, codes.shape[1] * codes.shape[2]
            rows = np.repeat(np.arange(n), per)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), codes.shape[2]), n)), pa.array(codes.reshape(-1)),
                batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))], names=["_t", "_b", "_q", "_w"])

    indexed = pages.mapInArrow(page_buckets, f"_t int, _b long, _id {id_type}, _v array<{pages.schema[vec_col].dataType.elementType.simpleString()}>")
    probing = queries.mapInArrow(query_buckets, f"_t int, _b long, _q {query_type}, _w array<{queries.schema[query_vec_col].dataType.elementType.simpleString()}>")
    # the probes of a query in one table are distinct buckets: their flips are distinct masks
    # buckets too full for one group: at most tables x 2^bits rows, joined by broadcast
    hot = indexed.groupBy("_t", "_b").count().where(F.col("count") > sub_block_rows).select(
        "_t", "_b", F.ceil(F.col("count") / sub_block_rows).cast("int").alias("_n"))
    hot = F.broadcast(hot)
    indexed = indexed.join(hot, ["_t", "_b"], "left").withColumn(
        "_s", F.pmod(F.xxhash64("_id"), F.coalesce("_n", F.lit(1))).cast("int")).drop("_n")
    probing = probing.join(hot, ["_t", "_b"], "left").withColumn(
        "_s", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_n")

    names = [query_id_col, id_col, "similarity"]

    def best(page_block: pa.Table, query_block: pa.Table) -> pa.Table:
        query_ids = query_block.column("_q").combine_chunks()
        page_ids = page_block.column("_id").combine_chunks()
        state = Best(len(query_ids), want)
        if len(query_ids) and len(page_ids):
            state.add(column_values(page_ids), _matrix(page_block.column("_v")) @ _matrix(query_block.column("_w")).T)
        return pa.table(state.rows(query_ids, page_ids.type), names=names)

    schema = f"`{query_id_col}` {query_type}, `{id_col}` {id_type}, similarity double"
    found = indexed.groupBy("_t", "_b", "_s").cogroup(probing.groupBy("_t", "_b", "_s")).applyInArrow(best, schema)
    found = found.groupBy(query_id_col, id_col).agg(F.max("similarity").alias("similarity"))
    if exclude_self:
        found = found.where(F.col(id_col) != F.col(query_id_col))
    return top_k(found, query_id_col, "similarity", id_col, k)
