"""Stored files as a partitioned table.

Each batch writes a folder of its own and never touches another, so that a repeated batch
replaces just itself. Failed fetches sit in a partition of their own beside the files, which lets
one write keep both.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioline.session import empty_frame, settle, ship_package

SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("error", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("batch", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("court", T.StringType()),
    T.StructField("date", T.StringType()),
])


class BlobExistsError(ValueError):
    """A file exists and the policy is to fail."""


def save_blobs(
    df: DataFrame, root: str, batch: int, on_exists: str = "overwrite", rebalance: bool = True
) -> None:
    """Write ``(path, content)``, one row per path, optionally with ``link, error, seconds``.

    ``overwrite``: readers see the new content. ``skip``: stored paths are left out.
    ``fail``: a stored path fails the job. ``rebalance`` may be off for rows that are clustered by path.
    """
    spark = df.sparkSession
    if on_exists not in ("overwrite", "skip", "fail"):
        raise ValueError(f"unknown policy {on_exists!r}")
    if on_exists != "overwrite":
        stored = landed_paths(spark, root, other_than=batch)
        if on_exists == "fail":
            clash = df.select("path").join(stored, "path", "left_semi").take(1)
            if clash:
                raise BlobExistsError(f"already stored: {clash[0]['path']}")
        else:
            df = df.join(stored, "path", "left_anti")
    for name in ("link", "error"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    if "seconds" not in df.columns:
        df = df.withColumn("seconds", F.lit(None).cast("double"))
    parts = F.split("path", "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    placed = df.select(
        "path", "link", "content", "error", "seconds",
        F.when(F.col("content").isNull(), F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.coalesce(F.get(folders, F.lit(1)), F.lit("")).alias("court"),
        F.coalesce(F.get(folders, F.lit(2)), F.lit("")).alias("date"),
    )
    if rebalance:
        # small partitions share a task, a court and year with very many files gets several
        placed = placed.hint("rebalance", "status", "court", "date")
    placed.write.mode("overwrite").partitionBy("status", "court", "date").parquet(f"{root}/batch={batch}")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, SCHEMA)


def landed_paths(spark: SparkSession, root: str, other_than: int | None = None) -> DataFrame:
    """Distinct stored paths, on request without those of one batch. Only the path column is read."""
    stored = _stored(spark, root).where(F.col("status") == "ok")
    if other_than is not None:
        stored = stored.where(F.col("batch") != other_than)
    return stored.select("path").distinct()


def read_batch(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """All rows of one batch, failed ones included."""
    return _stored(spark, root).where(F.col("batch") == batch).select(
        "path", "link", "content", "error", "seconds", "status")


def read_saved(spark: SparkSession, root: str) -> DataFrame:
    """``(path, content)``: each path with its newest content.

    Which rows are outdated is found from paths and batch numbers alone; the contents are not
    shuffled while that list is small enough for Spark to broadcast.
    """
    stored = _stored(spark, root).where(F.col("status") == "ok").select("path", "batch", "content")
    newest = stored.groupBy("path").agg(F.max("batch").alias("batch"), F.count("*").alias("n"))
    outdated = (
        stored.select("path", "batch")
        .join(newest.where(F.col("n") > 1).select("path", F.col("batch").alias("last")), "path")
        .where(F.col("batch") < F.col("last")).select("path", "batch")
    )
    return stored.join(settle(outdated, "outdated"), ["path", "batch"], "left_anti").select("path", "content")


def _mounted(spark: SparkSession, root: str) -> str | None:
    """``root`` as a path of the machines' own file system, or None if it is of another."""
    url = urlparse(root)
    scheme = url.scheme or urlparse(spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///").scheme
    if scheme != "file":
        return None
    return unquote(url.path) if url.scheme else root


def write_text_files(df: DataFrame, root: str, id_col: str, text_col: str) -> None:
    """A text file for each id, ``<id_col>=<id>.txt`` in a folder of its task; rows of one id share a file, a line end after each.

    In a shared folder the tasks write the files themselves: Spark's writer makes a folder for each id, which the driver moves one
    by one, and starts processes for the permissions of each. Other file systems get Spark's writer, a folder ``<id_col>=<id>`` for each.
    """
    spark = df.sparkSession
    rows = df.select(id_col, text_col).repartition(4 * spark.sparkContext.defaultParallelism, id_col)
    folder = _mounted(spark, root)
    if folder is None:
        rows.write.partitionBy(id_col).text(root)
        return
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = f"{folder}/{TaskContext.get().partitionId():05d}"
        os.makedirs(place, exist_ok=True)
        out, name, n = None, None, 0
        # whole files only: a repeated or speculative task puts the same ones in their place
        part = f"{place}/.{uuid.uuid4().hex}"
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mine = f"{place}/{id_col}={'__HIVE_DEFAULT_PARTITION__' if key is None else key}.txt"
                if mine != name:
                    if out is not None:
                        out.close()
                        os.replace(part, name)
                    out, name, n = open(part, "wb"), mine, n + 1
                out.write((text or "").encode() + b"\n")
        if out is not None:
            out.close()
            os.replace(part, name)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    rows.sortWithinPartitions(id_col).mapInArrow(run, "n long").agg(F.sum("n")).collect()
