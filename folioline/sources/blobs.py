"""Stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_blobs(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, modificationTime, length, content)`` of the files below ``root``.

    A file is read only if ``content`` is selected.
    """
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True).load(root)
    )


def landed_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, length)`` from one listing of ``root``, without reading any file."""
    return read_blobs(spark, root, glob).select("path", "length")
