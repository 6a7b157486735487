"""Identifiers that come out the same on every run and retry."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def format_uuid(hex32: Column) -> Column:
    """32 hex digits as 8-4-4-4-12."""
    return F.regexp_replace(hex32, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def document_id(file_path: Column) -> Column:
    return format_uuid(F.md5(file_path.cast("string")))


def page_id(document: Column, page: Column) -> Column:
    return format_uuid(F.md5(F.concat_ws("/", document.cast("string"), page.cast("string"))))


def record_id(document: Column, page: Column) -> Column:
    """Composite key column."""
    return F.struct(document.alias("document_id"), page.alias("page"))
