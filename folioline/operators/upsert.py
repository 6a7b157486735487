"""Set-based upserts of the two tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from folioline.functions.ids import document_id, page_id


class ConflictError(ValueError):
    """A strict insert met keys that exist already."""


def instant(now: Column | datetime) -> Column:
    """The time of a batch: an instant, or an expression for one."""
    return now if isinstance(now, Column) else F.lit(now)


def with_defaults(df: DataFrame, id_col: Column, now: Column | datetime) -> DataFrame:
    """Add ``id``, ``created_at`` and ``updated_at``; one instant for the whole batch."""
    return df.withColumns({"id": id_col, "created_at": instant(now), "updated_at": instant(now)})


def upsert_documents(old: DataFrame, new: DataFrame, now: Column | datetime) -> DataFrame:
    """``old`` merged with the paths of ``new``.

    A known path keeps id and ``created_at`` and gets ``updated_at = now``. Copies of a path
    within ``new`` collapse before the shuffle, whose partitioning the join then uses.
    """
    now = instant(now)
    batch = new.select("file_path").distinct().withColumn("_new", F.lit(True))
    both = old.select("file_path", "id", "created_at", "updated_at").join(batch, "file_path", "full_outer")
    known = F.col("id").isNotNull()
    return both.select(
        F.coalesce("id", document_id(F.col("file_path"))).alias("id"),
        "file_path",
        F.when(known, F.col("created_at")).otherwise(now).alias("created_at"),
        F.when(F.col("_new"), now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def upsert_pages(old: DataFrame, new: DataFrame, now: Column | datetime, mode: str = "keep_first") -> DataFrame:
    """``old`` merged with ``new`` on ``(document_id, page)``; every other column of ``new`` is content.

    ``keep_first``: a known page keeps its content, only ``updated_at`` moves.
    ``replace``: a known page takes the new content.
    Pages which ``new`` lacks stay. Copies of a key within ``new`` are reduced to the least
    one, partly before the shuffle.
    """
    if mode not in ("keep_first", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    now = instant(now)
    keys = ["document_id", "page"]
    content = [c for c in new.columns if c not in keys + ["id", "created_at", "updated_at"]]
    batch = new.groupBy(*keys).agg(F.min(F.struct(*content)).alias("_new"))
    kept = old.select(*keys, "id", "created_at", "updated_at", F.struct(*content).alias("_old"))
    both = kept.join(batch, keys, "full_outer")
    order = ["_old", "_new"] if mode == "keep_first" else ["_new", "_old"]
    known = F.col("id").isNotNull()
    chosen = F.coalesce(*order)
    return both.select(
        F.coalesce("id", page_id(F.col("document_id"), F.col("page"))).alias("id"),
        *keys,
        *[chosen[c].alias(c) for c in content],
        F.when(known, F.col("created_at")).otherwise(now).alias("created_at"),
        F.when(F.col("_new").isNotNull(), now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def strict_conflicts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``new`` that ``old`` has, or that ``new`` has more than once."""
    counted = new.groupBy(*keys).agg(F.count("*").alias("_n"))
    repeated = counted.where(F.col("_n") > 1).select(*keys)
    stored = counted.select(*keys).join(old.select(*keys), keys, "left_semi")
    return repeated.union(stored).distinct()


def insert_strict(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new``, all to be added; any conflict fails the job."""
    first = strict_conflicts(old, new, keys).take(1)
    if first:
        raise ConflictError(f"already present: {first[0].asDict()}")
    return new
