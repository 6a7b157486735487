"""What the plans look like: pushdown, pruning, number of shuffles, no repeated evaluation."""

import re

from pyspark.sql import functions as F

from folioline.operators import links as L, lookup as K, pages as P, search as S, upsert as U
from folioline.operators.embed import hashed_terms
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan_of(df)))


def test_lookup_reaches_the_scan(spark):
    plan = plan_of(K.by_file_path(table(spark, "documents"), "src7", "source").select("doc_id"))
    assert "EqualTo(source,src7)" in plan
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_map_only_operators(spark):
    docs, pages = table(spark, "documents"), table(spark, "pages")
    for df in (P.number_pages(docs, ["doc_id"]), L.extract_links(pages, ["page_id"]), L.extract_row_links(pages, ["url"]),
               hashed_terms(docs, ["doc_id"], "text", 64), S.analyze_tokens(docs, ["doc_id"])):
        assert exchanges(df) == 0


def test_one_shuffle(spark):
    docs, pages = table(spark, "documents"), table(spark, "pages")
    assert exchanges(L.distinct_links(L.extract_links(pages, [], out="link"))) == 1
    assert exchanges(S.term_stats(docs)) == 1
    assert exchanges(P.collect_pages(docs.withColumn("page", F.lit(1)), "doc_id", ["text"])) == 1


def test_joins_shuffle_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = table(spark, "documents").select(F.col("doc_id").alias("path"))
        labels = table(spark, "labels").select(F.col("doc_id").alias("path"))
        assert exchanges(K.pending_links(docs, labels, labels.distinct())) == 3
        old = U.with_defaults(table(spark, "labels").select(F.col("doc_id").cast("string").alias("file_path")),
                              F.col("file_path"), F.current_timestamp())
        new = table(spark, "documents").select(F.col("doc_id").cast("string").alias("file_path"))
        assert exchanges(U.upsert_documents(old, new, F.current_timestamp())) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_keys_are_read_for_pending(spark):
    docs = table(spark, "documents").withColumnRenamed("doc_id", "path")
    plan = plan_of(K.pending_links(docs.select("path"), docs, docs))
    assert set(re.findall(r"ReadSchema: (\S+)", plan)) == {"struct<doc_id:bigint>"}


def test_python_runs_once(spark):
    plan = plan_of(hashed_terms(table(spark, "documents"), ["doc_id"], "text", 64))
    assert plan.count("ArrowEvalPython") == 1


def test_no_cross_joins(spark):
    docs = table(spark, "documents")
    for df in (S.bm25_topk(docs, {"q": ["der", "die"]}, 5, "doc_id"), L.crawl_counts(
            L.extract_links(table(spark, "pages"), ["page_id"], out="link"), "page_id")):
        assert "CartesianProduct" not in plan_of(df) and "NestedLoop" not in plan_of(df)
