"""Run log as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioline.schema import RUN_LOG


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with level, msg, time and domain; stage columns are NULL where a line lacks them."""
    return spark.read.schema(RUN_LOG).option("recursiveFileLookup", True).json(path)
