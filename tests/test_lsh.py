"""The hyperplane index against the exact search: recall at 10 over the given vectors, hot buckets, edge cases."""

import random

from pyspark.sql import functions as F, types as T

from folioline.operators import lsh
from folioline.operators.nearest import knn_cosine

DATA = "/root/testdata/sf0.1"


def _recall(found, exact):
    want = {}
    for r in exact:
        want.setdefault(r[0], set()).add(r[1])
    got = {}
    for r in found:
        got.setdefault(r[0], set()).add(r[1])
    return sum(len(got.get(q, set()) & ids) for q, ids in want.items()) / sum(len(ids) for ids in want.values())


import pytest


@pytest.mark.parametrize("data", [DATA, "/root/testdata/check_l"])
def test_recall_at_10_on_the_given_vectors(spark, data):
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    queries = vectors.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = lsh.knn_lsh(vectors, queries, 10, "vec_id", "embedding", exclude_self=True).collect()
    exact = knn_cosine(vectors, queries, 10, "vec_id", "embedding", exclude_self=True).collect()
    assert len(exact) == 10 * queries.count()
    recall = _recall([(r.query_id, r.vec_id) for r in found], [(r.query_id, r.vec_id) for r in exact])
    assert recall >= 0.9, recall
    # what is found is ranked by its true similarity
    assert all(r.similarity <= 1.0000001 for r in found) and {r["rank"] for r in found} <= set(range(1, 11))


def test_hot_bucket_is_split_and_misses_nothing(spark):
    rng = random.Random(4)
    same = [0.3, -0.2, 0.5, 0.1]
    rows = [(i, same if i % 2 else [rng.uniform(-1, 1) for _ in range(4)]) for i in range(3000)]
    rows += [(5000, None), (5001, [0.0] * 4), (None, [1.0, 0.0, 0.0, 0.0]), (5002, [1.0, 2.0])]
    pages = spark.createDataFrame(rows, "id long, embeddings array<double>")
    queries = spark.createDataFrame([(1, same), (2, [0.9, 0.1, 0.0, 0.2]), (3, [0.0] * 4)], "query_id long, vector array<double>")
    found = lsh.knn_lsh(pages, queries, 5, sub_block_rows=50).collect()
    exact = knn_cosine(pages, queries, 5).collect()
    # the common vector's 1,500 copies tie: the five smallest ids win in both
    assert sorted((r.query_id, r.id) for r in found if r.query_id == 1) == sorted((r.query_id, r.id) for r in exact if r.query_id == 1)
    assert not [r for r in found if r.query_id == 3]   # a zero vector has no neighbours
    assert _recall([(r.query_id, r.id) for r in found], [(r.query_id, r.id) for r in exact]) >= 0.9


def test_no_pages_or_no_queries(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("embeddings", T.ArrayType(T.DoubleType()))])
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    assert lsh.knn_lsh(spark.createDataFrame([], schema), q, 3).collect() == []
    p = spark.createDataFrame([(1, [1.0, 0.0])], schema)
    assert lsh.knn_lsh(p, spark.createDataFrame([], "query_id long, vector array<double>"), 3).collect() == []


def test_probes_are_distinct_buckets():
    import numpy as np
    projections = np.random.default_rng(1).normal(size=(20, 3 * 6))
    codes = lsh._probe_codes(projections, 3, 6, 8)
    assert all(len(set(codes[i, t])) == 9 for i in range(20) for t in range(3))
