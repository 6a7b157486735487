"""Cleaning a corpus from end to end: each stage works on all rows that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioline.llm import decontaminate, near_join, pieces, quality, substrings
from folioline.llm.queries import PIECES
from folioline.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the outlier test reject go."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_join.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What an earlier document has too is cut out of the texts; every document stays."""
    return substrings.remove_repeats(docs)


def benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, round_trip): the texts as token ids, and whether these decode to the text."""
    return pieces.encode_and_check(docs, pieces.load_vocabulary(PIECES), keep=["doc_id", "lang", "source"],
                                   marks_as_spaces=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_strings", repeated_strings),
    ("benchmark_texts", benchmark_texts),
    ("tokens", tokens),
]

#: The outlier estimate, among others, has no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
