"""Constraints of the stored tables, checked as set operations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from folioline.fixed import EMBEDDING_WIDTH
from folioline.functions.vectors import has_width
from folioline.session import settle


@dataclass
class Constraints:
    """``rows``: rule name to a condition each row must meet (NULL counts as broken).
    ``unique``: rule name to key columns. ``references``: rule name to (column, table, its column).
    ``absent``: rule name to (column, table, its column) whose values must not be there yet (a stored primary key)."""

    rows: dict[str, Column] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    references: dict[str, tuple[str, DataFrame, str]] = field(default_factory=dict)
    absent: dict[str, tuple[str, DataFrame, str]] = field(default_factory=dict)


def document_constraints() -> Constraints:
    return Constraints(
        rows={"file_path_not_empty": F.length("file_path") > 0},
        unique={"file_path_unique": ["file_path"]},
    )


def page_constraints(documents: DataFrame | None = None, width: int = EMBEDDING_WIDTH) -> Constraints:
    spec = Constraints(
        rows={
            "document_id_not_null": F.col("document_id").isNotNull(),
            "page_positive": F.col("page") > 0,
            "text_not_empty": F.length("text") > 0,
            "embedding_width": has_width(F.col("embeddings"), width),
        },
        unique={"document_page_unique": ["document_id", "page"]},
    )
    if documents is not None:
        spec.references["document_exists"] = ("document_id", documents, "id")
    return spec


def broken_row_rules(rules: dict[str, Column]) -> Column:
    """Array of the names of the row rules a row breaks."""
    flags = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")


def _repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, none of them NULL, that occur more than once; counts are added up before the shuffle."""
    present = df.select(*keys).dropna()
    return present.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def orphan_ids(pages: DataFrame, documents: DataFrame, col: str = "document_id", id_col: str = "id") -> DataFrame:
    """Distinct document ids of pages that no document has. Only ids travel, each once per task."""
    used = pages.select(col).where(F.col(col).isNotNull()).distinct()
    return used.join(documents.select(F.col(id_col).alias(col)), col, "left_anti")


def orphan_pages(pages: DataFrame, documents: DataFrame, col: str = "document_id", id_col: str = "id") -> DataFrame:
    """Pages whose document does not exist."""
    return pages.join(settle(orphan_ids(pages, documents, col, id_col), "orphans"), col, "left_semi")


def count_violations(df: DataFrame, spec: Constraints) -> DataFrame:
    """``(rule, n_rows)`` for each rule, with 0 for a rule all rows meet.

    All row rules are counted in one pass. Every row of a repeated key counts.
    """
    counters = []
    if spec.rows:
        broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in spec.rows.items()]
        names = list(spec.rows)
        counters.append(df.agg(*broken).unpivot([], names, "rule", "n_rows"))
    for name, keys in spec.unique.items():
        counters.append(_repeated(df, keys).agg(
            F.lit(name).alias("rule"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")))
    for name, (col, table, id_col) in spec.references.items():
        per_id = df.select(col).where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_rows"))
        lost = per_id.join(table.select(F.col(id_col).alias(col)), col, "left_anti")
        counters.append(lost.agg(
            F.lit(name).alias("rule"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")))
    out = counters[0]
    for more in counters[1:]:
        out = out.unionByName(more)
    return out


def check_constraints(df: DataFrame, spec: Constraints) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule, broken rows with a column ``rules``).

    Only keys travel to find repeated keys and missing references. The keys found are stored and joined
    back; while they are few the rows themselves are not shuffled. No window gathers the rows of one key.
    """
    flagged = df.withColumn("rules", broken_row_rules(spec.rows))
    for name, keys in spec.unique.items():
        bad = _repeated(df, keys).select(*keys, F.lit(name).alias("_bad"))
        flagged = _add_rule(flagged, bad, keys)
    for name, (col, table, id_col) in spec.references.items():
        bad = orphan_ids(df, table, col, id_col).withColumn("_bad", F.lit(name))
        flagged = _add_rule(flagged, bad, [col])
    for name, (col, table, id_col) in spec.absent.items():
        used = df.select(col).where(F.col(col).isNotNull()).distinct()
        bad = used.join(table.select(F.col(id_col).alias(col)), col, "left_semi").withColumn("_bad", F.lit(name))
        flagged = _add_rule(flagged, bad, [col])
    valid = flagged.where(F.size("rules") == 0).drop("rules")
    return valid, flagged.where(F.size("rules") > 0)


def _add_rule(flagged: DataFrame, bad: DataFrame, keys: list[str]) -> DataFrame:
    columns = flagged.columns
    rules = F.when(F.col("_bad").isNull(), F.col("rules")).otherwise(F.array_append("rules", F.col("_bad")))
    return flagged.join(settle(bad, "broken"), keys, "left").withColumn("rules", rules).select(*columns)


def check_dim(df: DataFrame, col: str, width: int = EMBEDDING_WIDTH) -> tuple[DataFrame, DataFrame]:
    """(rows whose vector has ``width`` elements, the others)."""
    ok = has_width(F.col(col), width)
    return df.where(ok), df.where(~ok)
