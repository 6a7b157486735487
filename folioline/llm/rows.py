"""Whole rows beside their id and a hash, so that no column of theirs clashes with one of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def text_key(*columns: str) -> Column:
    """A hash that tells rows of one id apart; the first column is the text, null as empty."""
    return F.xxhash64(F.coalesce(F.col(columns[0]), F.lit("")), *columns[1:])


def packed(docs: DataFrame, *key_columns: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, key, row): ``row`` is a struct of all columns."""
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(*(key_columns or ("text",))).alias("key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def same(rows: DataFrame, other: DataFrame) -> Column:
    """Rows of equal id (null with null) and key; ``other (_d, _k)``."""
    return rows["doc_id"].eqNullSafe(other["_d"]) & (rows["key"] == other["_k"])


def without(docs: DataFrame, bad: DataFrame, *key_columns: str) -> DataFrame:
    """``docs`` but for the rows whose id and key are in ``bad (doc_id, key)``."""
    rows = packed(docs, *key_columns)
    bad = bad.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"))
    return unpacked(rows.join(bad, same(rows, bad), "left_anti"))
