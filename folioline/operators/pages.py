"""Documents to numbered pages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioline.functions.text import drop_empty_pages, split_pages

PAGES_PER_PART = 1024


def number_pages(df: DataFrame, keep: list[str], text_col: str = "text", outer: bool = False) -> DataFrame:
    """``(…, page, text)``: pages numbered 1, 2, … after empty ones are dropped. Map-only.

    With ``outer`` a document without pages keeps one row with a NULL page.
    """
    generate = F.posexplode_outer if outer else F.posexplode
    parts = drop_empty_pages(split_pages(F.col(text_col)))
    return df.select(*keep, generate(parts).alias("pos", "text")).select(
        *keep, (F.col("pos") + 1).cast("int").alias("page"), "text"
    )


def number_page_rows(
    df: DataFrame, doc_col: str, order_col: str, text_col: str = "text", width: int = PAGES_PER_PART
) -> DataFrame:
    """The same numbering where pages come as rows, with ``order_col`` (a whole number, unique in its
    document) giving the order.

    Rows are ranked within ranges of ``width`` positions and each range gets the number of rows
    before it, so that one very long document spreads over many tasks: only one counter per
    range meets in a document-wide window.
    """
    kept = df.where(F.length(text_col) > 0).withColumn("_range", F.floor(F.col(order_col) / width))
    counts = kept.groupBy(doc_col, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(doc_col).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        doc_col, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    in_range = Window.partitionBy(doc_col, "_range").orderBy(order_col)
    ranked = kept.withColumn("_rank", F.row_number().over(in_range))
    return (
        ranked.join(offsets, [doc_col, "_range"])
        .withColumn("page", (F.col("_before") + F.col("_rank")).cast("int"))
        .drop("_range", "_before", "_rank")
    )


def part_of(page: Column, pages_per_part: int = PAGES_PER_PART) -> Column:
    """Number of the record, from 0, that holds a page."""
    return F.floor((page - 1) / pages_per_part).cast("int")


def collect_pages(
    pages: DataFrame, doc_col: str, value_cols: list[str], page_col: str = "page",
    pages_per_part: int = PAGES_PER_PART,
) -> DataFrame:
    """``(doc, part, pages)``: pages in order as one nested record.

    A record holds ``pages_per_part`` pages at most; a longer document continues in part 1, 2, …
    Thus no task gathers an unbounded document, and no page is left out.
    """
    item = F.struct(F.col(page_col), *[F.col(c) for c in value_cols])
    return (
        pages.groupBy(doc_col, part_of(F.col(page_col), pages_per_part).alias("part"))
        .agg(F.array_sort(F.collect_list(item)).alias("pages"))
    )


def document_with_pages(
    documents: DataFrame, pages: DataFrame, value_cols: list[str], pages_per_part: int = PAGES_PER_PART
) -> DataFrame:
    """Documents with their ``pages`` as :func:`collect_pages` nests them.

    A document without pages has one row with an empty array.
    """
    nested = collect_pages(pages, "document_id", value_cols, pages_per_part=pages_per_part)
    # an inner join, of which Spark can split a skewed document, and the rest by ids only
    full = documents.join(nested, documents["id"] == nested["document_id"])
    bare = documents.join(pages.select(F.col("document_id").alias("id")).distinct(), "id", "left_anti")
    return full.select(*[documents[c] for c in documents.columns], "part", "pages").unionByName(
        bare.select(*documents.columns, F.lit(0).alias("part"),
                    F.array().cast(nested.schema["pages"].dataType).alias("pages")))


def pages_in_order(pages: DataFrame, document_id=None, doc_col: str = "document_id", page_col: str = "page") -> DataFrame:
    """Pages by document and number: of one document, or all (range-partitioned sort)."""
    if document_id is not None:
        return pages.where(F.col(doc_col) == document_id).orderBy(page_col)
    return pages.orderBy(doc_col, page_col)
