"""Which documents exist, and what is still to do. Per-row lookups become joins on narrow columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioline.schema import INVALID_URL
from folioline.functions.urls import is_malformed, path_from_url


def with_path(links: DataFrame, link_col: str = "link", **path_args) -> tuple[DataFrame, DataFrame]:
    """(links with a ``path``, rejects). A link lacking a needed parameter has none."""
    pathed = links.withColumn("path", path_from_url(F.col(link_col), **path_args))
    error = F.when(is_malformed(F.col(link_col)), F.lit("malformed URL")).otherwise(
        F.lit(INVALID_URL))
    bad = pathed.where(F.col("path").isNull()).select(
        F.col(link_col).alias("link"), F.lit("path").alias("stage"), error.alias("error"))
    return pathed.where(F.col("path").isNotNull()), bad


def should_process(landed: Column, known: Column) -> Column:
    """A link is left out only if its file has landed and its document row exists."""
    return ~(F.coalesce(landed, F.lit(False)) & F.coalesce(known, F.lit(False)))


def _broadcastable(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of ``df`` is under the broadcast threshold: the test it makes for joins."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    unit = next((u for u in sorted(units, key=len, reverse=True) if text.endswith(u)), "b")
    number = text[:len(text) - len(unit)] if text.endswith(unit) else text
    limit = int(number) * units[unit]
    if limit <= 0:
        return False
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size.toString() if hasattr(size, "toString") else size) <= limit


def pending_links(links: DataFrame, landed: DataFrame, known: DataFrame, path_col: str = "path") -> DataFrame:
    """Links still to process: ``links`` less the paths that have landed and are known.

    A batch that Spark may broadcast (say a stored table under the threshold) filters both large sides as they are scanned,
    and what is joined afterwards is no larger than the batch. A larger batch is shuffled once; landed and known paths are
    each shuffled once and meet where they lie.
    """
    if _broadcastable(links):
        asked = links.select(path_col)
        # landed paths of this batch: no larger than the batch; known is probed with these alone
        here = landed.select(path_col).join(F.broadcast(asked), path_col, "left_semi")
        done = known.select(path_col).join(F.broadcast(here), path_col, "left_semi")
        return links.join(F.broadcast(done), path_col, "left_anti")
    done = landed.select(path_col).join(known.select(path_col), path_col, "left_semi")
    return links.join(done, path_col, "left_anti")


def one_link_per_path(links: DataFrame, link_col: str = "link", path_col: str = "path") -> DataFrame:
    return links.groupBy(path_col).agg(F.min(link_col).alias(link_col))


def by_file_path(documents: DataFrame, path: str, path_col: str = "file_path") -> DataFrame:
    """Equality lookup of one path; the comparison reaches the parquet scan."""
    return documents.where(F.col(path_col) == path)


def lookup_ids(
    paths: DataFrame, documents: DataFrame, mode: str = "unique",
    path_col: str = "file_path", id_col: str = "id",
) -> DataFrame:
    """``paths`` with the id of their document, NULL where there is none.

    ``unique`` trusts the table's key. ``exactly_one`` finds an id only where just one row has the path.
    """
    if mode == "unique":
        ids = documents.select(path_col, id_col)
    elif mode == "exactly_one":
        ids = (
            documents.groupBy(path_col).agg(F.count("*").alias("_n"), F.min(id_col).alias(id_col))
            .where(F.col("_n") == 1).drop("_n")
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return paths.join(ids, path_col, "left")
