"""Links to stored, numbered, embedded pages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioline.fixed import EMBEDDING_WIDTH, FETCH_SLOTS
from folioline.operators.audit import as_log, as_rejects
from folioline.operators.checks import broken_row_rules
from folioline.operators.embed import EmbedderFactory, embed, hash_embed
from folioline.operators.extract import extract_text
from folioline.operators.lookup import one_link_per_path, pending_links, with_path
from folioline.operators.pages import number_pages
from folioline.operators.upsert import instant
from folioline.functions.vectors import has_width
from folioline.session import settle, spread
from folioline.sinks.blobs import landed_paths, read_batch, save_blobs
from folioline.sinks.runlog import write_run_log
from folioline.sinks.store import PageStore
from folioline.sources.fetch import fetch, fetch_from_landing


@dataclass
class Ingest:
    """Where a run reads and writes, and the three steps a user can replace.

    Batches of one ``root`` are numbered in one sequence. Give a ``fetcher`` or a ``landing`` table ``(url, content)``. Without ``extractor`` files are
    UTF-8 text, without ``embedder`` pages get hashed bags of words of ``width``. ``fetch_slots`` and
    ``embed_slots`` are the numbers of tasks for fetching and embedding; the latter also spreads the pages
    of a document that is much longer than the others.
    """

    spark: SparkSession
    root: str
    fetcher: Callable[[str], bytes] | None = None
    landing: DataFrame | None = None
    extractor: Callable[[bytes], str] | None = None
    embedder: EmbedderFactory | None = None
    width: int = EMBEDDING_WIDTH
    fetch_slots: int = FETCH_SLOTS
    embed_slots: int | None = None
    mode: str = "keep_first"
    path_args: dict | None = None

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.store = PageStore(self.spark, f"{self.root}/tables")
        self.blob_root = f"{self.root}/blobs"
        self.log_root = f"{self.root}/log"
        self.reject_root = f"{self.root}/rejects"

    def pending(self, links: DataFrame, batch_id: int | None = None) -> DataFrame:
        """``(path, link)`` still to do: the file has not landed or the document row is missing.

        What an earlier try of batch ``batch_id`` has landed does not count; it is written anew.
        """
        return self._pending(with_path(links, **(self.path_args or {}))[0], batch_id)

    def _pending(self, pathed: DataFrame, batch_id: int | None) -> DataFrame:
        landed = landed_paths(self.spark, self.blob_root, other_than=batch_id)
        known = self.store.documents().select(F.col("file_path").alias("path"))
        return pending_links(settle(one_link_per_path(pathed), "asked"), landed, known)

    def run(self, links: DataFrame, batch_id: int, now: Column | datetime) -> int:
        """Process one batch of ``(link)``; the version of the tables afterwards.

        Every costly step ends in a stored table of this batch, which later steps read: nothing
        is fetched, extracted or embedded twice within a run, and a lost executor repeats its own
        tasks only. Files are stored before they are parsed; a document that fails later has no
        row, so the next run takes it up again. A batch that was committed before is skipped.
        """
        if self.store.committed(batch_id):
            return self.store.version()
        # a batch of few files would be taken apart by as few tasks, and again by each step that reads its links
        placed, bad_links = with_path(spread(links.select("link")), **(self.path_args or {}))
        placed = self._stage("links", batch_id, placed)
        bad_links = self._stage("bad_links", batch_id, bad_links)
        todo = self._stage("todo", batch_id, self._pending(placed, batch_id))
        if self.landing is not None:
            fetched = fetch_from_landing(todo, self.landing)
        elif self.fetcher is not None:
            fetched = fetch(todo, self.fetcher, self.fetch_slots, cluster_by="path")
        else:
            raise ValueError("give a fetcher or a landing table")
        save_blobs(fetched, self.blob_root, batch_id, "overwrite", rebalance=self.landing is not None)
        blobs = read_batch(self.spark, self.blob_root, batch_id)

        staged = self._stage("pages", batch_id, self._embedded_pages(blobs.where(F.col("status") == "ok")))
        # a document with any failed page is left out as a whole
        failed = self._stage("failed", batch_id, staged.where(F.col("error").isNotNull()).groupBy("path", "link").agg(
            F.min(F.struct("stage", "error")).alias("e")).select("path", "link", "e.stage", "e.error"))
        good = staged.join(failed.select("path"), "path", "left_anti")

        unfetched = blobs.where(F.col("status") != "ok").select("link", F.lit("fetch").alias("stage"), "error")
        rejects = as_rejects([bad_links, unfetched, failed], batch_id)
        rejects.write.mode("overwrite").parquet(f"{self.reject_root}/batch={batch_id}")
        events = (
            blobs.select("link", F.lit("fetch").alias("stage"), "error", "seconds")
            .unionByName(staged.select("link", "stage", "error", "seconds"))
            .unionByName(bad_links.withColumn("seconds", F.lit(None).cast("double")))
        )
        write_run_log(as_log(events, instant(now), batch_id), f"{self.log_root}/batch={batch_id}", "overwrite")

        # last, since a committed batch is not looked at again
        return self.store.commit(
            good.select(F.col("path").alias("file_path")).distinct(),
            good.where(F.col("page").isNotNull()).select(
                F.col("path").alias("file_path"), "page", "text", "embeddings"),
            batch_id, now, self.mode, unique=True)

    def _stage(self, name: str, batch_id: int, df: DataFrame) -> DataFrame:
        path = f"{self.root}/staged/{name}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _embedded_pages(self, blobs: DataFrame) -> DataFrame:
        """``(path, link, page, text, embeddings, stage, error, seconds)``.

        A file that gave no text, or no page, has one row with a NULL page.
        """
        texts = extract_text(blobs.select("path", "link", "content"), self.extractor)
        pages = number_pages(
            texts.withColumnsRenamed({"error": "text_error", "seconds": "text_seconds"}),
            ["path", "link", "text_error", "text_seconds"], outer=True)
        if self.embedder is None:
            spread = pages.repartition(self.embed_slots) if self.embed_slots else pages
            embedded = hash_embed(spread, "text", self.width).withColumns(
                {"error": F.lit(None).cast("string"), "seconds": F.lit(0.0)})
        else:
            embedded = embed(pages, "text", self.embedder, slots=self.embed_slots)
        is_page = F.col("page").isNotNull()
        broken = broken_row_rules({
            "page_positive": F.col("page") > 0,
            "text_not_empty": F.length("text") > 0,
            "embedding_width": has_width(F.col("embeddings"), self.width),
        })
        page_error = F.coalesce(
            F.col("error"),
            F.when(F.size(broken) > 0, F.concat(F.lit("broken rules: "), F.array_join(broken, ", "))))
        return embedded.select(
            "path", "link", "page", "text", "embeddings",
            F.when(is_page, F.lit("embed")).otherwise(F.lit("extract")).alias("stage"),
            F.when(is_page, page_error).otherwise(F.col("text_error")).alias("error"),
            F.when(is_page, F.col("seconds")).otherwise(F.col("text_seconds")).alias("seconds"),
        )

    def rejects(self) -> DataFrame:
        """All rejects so far."""
        return self.spark.read.option("recursiveFileLookup", True).parquet(self.reject_root)
