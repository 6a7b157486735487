"""Listing pages as rows ``(url, html)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table of pages, or with ``fmt="html"`` a folder of saved pages, one file each."""
    if fmt != "html":
        return spark.read.format(fmt).load(path)
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def stream_listings(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """The same table as a stream of the files that are added to it."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)
