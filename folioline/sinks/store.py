"""Documents and their pages as two parquet tables that change together.

Each commit adds folders of its own, ``<table>/v=<version>``, and then publishes its number in a
one-row manifest. Readers look at the versions up to the newest published one, so they see all of a
commit or nothing of it. What a commit that died left behind carries the next number, is invisible, and is
written over by the next commit. A commit costs as much as its batch: stored texts and vectors
are neither read nor written again. Changes to stored rows are kept as narrow tables:

* ``touched``: keys whose ``updated_at`` has moved,
* ``replaced``: keys of pages whose rows in earlier versions are void.

:meth:`PageStore.compact` folds them in. Manifests carry the batch number, which makes a repeated
batch a no-op. One writer at a time.
"""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from folioline.fixed import EMBEDDING_WIDTH
from folioline.functions.ids import document_id, page_id
from folioline.functions.vectors import has_width
from folioline.operators.checks import Constraints, check_constraints
from folioline.operators.upsert import ConflictError, instant, strict_conflicts, with_defaults
from folioline.schema import DOCUMENT_PAGES, DOCUMENTS
from folioline.session import empty_frame

_MANIFEST = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("base", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])
_KEY = [T.StructField("document_id", T.StringType()), T.StructField("page", T.IntegerType())]
# a touched document has no page number
_TOUCHED = T.StructType(_KEY + [T.StructField("updated_at", T.TimestampType())])
_REPLACED = T.StructType(_KEY)
PAGE_KEY = ["document_id", "page"]


class PageStore:
    """The two tables below ``root``, on any file system Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # reading

    def _newest(self, batch_id: int | None = None) -> tuple[int, int, bool]:
        """(newest version, first version that counts, whether ``batch_id`` has been committed)."""
        try:
            manifests = self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).json(
                f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, 0, False
        row = manifests.agg(
            F.max("version").alias("version"), F.max("base").alias("base"),
            F.bool_or(F.col("batch_id") == F.lit(batch_id).cast("long")).alias("done")).first()
        return row["version"] or 0, row["base"] or 0, bool(row["done"])

    def _table(self, name: str, schema: T.StructType, newest: int, base: int) -> DataFrame:
        """Rows of the versions that count, with their version as ``v``; other folders are not opened."""
        if newest == 0:
            return empty_frame(self.spark, schema).withColumn("v", F.lit(0).cast("long"))
        with_version = T.StructType(schema.fields + [T.StructField("v", T.LongType())])
        stored = self.spark.read.schema(with_version).parquet(f"{self.root}/{name}")
        return stored.where(F.col("v").between(max(base, 1), newest))

    def _documents(self, newest: int, base: int) -> DataFrame:
        touched = self._table("touched", _TOUCHED, newest, base).where(F.col("page").isNull())
        latest = touched.groupBy(F.col("document_id").alias("id")).agg(F.max("updated_at").alias("_touched"))
        stored = self._table("documents", DOCUMENTS, newest, base).join(latest, "id", "left")
        return _with_touch(stored, DOCUMENTS)

    def _pages(self, newest: int, base: int) -> DataFrame:
        replaced = self._table("replaced", _REPLACED, newest, base)
        void = replaced.groupBy(*PAGE_KEY).agg(F.max("v").alias("_void"))
        touched = self._table("touched", _TOUCHED, newest, base).where(F.col("page").isNotNull())
        latest = touched.groupBy(*PAGE_KEY).agg(F.max("updated_at").alias("_touched"))
        stored = self._table("pages", DOCUMENT_PAGES, newest, base)
        # both overlays are narrow and their file sizes known, so Spark broadcasts them while they are small
        same = [stored[c] == void[c] for c in PAGE_KEY] + [stored["v"] < void["_void"]]
        live = stored.join(void, same, "left_anti")
        return _with_touch(live.join(latest, PAGE_KEY, "left"), DOCUMENT_PAGES)

    def version(self) -> int:
        return self._newest()[0]

    def committed(self, batch_id: int) -> bool:
        return self._newest(batch_id)[2]

    def documents(self) -> DataFrame:
        return self._documents(*self._newest()[:2])

    def pages(self) -> DataFrame:
        return self._pages(*self._newest()[:2])

    def snapshot(self) -> tuple[DataFrame, DataFrame]:
        """(documents, pages) of one and the same version."""
        newest, base, _ = self._newest()
        return self._documents(newest, base), self._pages(newest, base)

    # writing

    def commit(
        self, documents: DataFrame, pages: DataFrame, batch_id: int, now: Column | datetime,
        mode: str = "keep_first", unique: bool = False,
    ) -> int:
        """Merge ``documents (file_path)`` and ``pages (file_path, page, text, embeddings)``; the new version.

        The result is that of ``upsert_documents`` and ``upsert_pages`` in the same ``mode``; with ``strict``
        a path that exists fails the commit. Of the stored tables only keys are read, and page keys
        only of documents that exist already. Copies of a page within the batch are reduced to the
        least one, unless the caller vouches by ``unique`` that there are none, which saves the shuffle.
        Both frames are read more than once, so they should be stored tables rather than long plans.
        """
        if mode not in ("keep_first", "replace", "strict"):
            raise ValueError(f"unknown mode {mode!r}")
        newest, base, done = self._newest(batch_id)
        if done:
            return newest
        version, now = newest + 1, instant(now)

        batch = documents.select("file_path").where(F.col("file_path").isNotNull()).distinct()
        stored = self._documents(newest, base).select("file_path", "id")
        known = self._note("known", version, batch.join(stored, "file_path"))
        if mode == "strict":
            offered = documents.select("file_path").where(F.col("file_path").isNotNull())
            clash = strict_conflicts(stored, offered, ["file_path"]).take(1)
            if clash:
                raise ConflictError(f"already present or repeated: {clash[0]['file_path']}")
            twice = pages.groupBy("file_path", "page").count().where("count > 1").take(1)
            if twice:
                raise ConflictError(f"repeated: page {twice[0]['page']} of {twice[0]['file_path']}")
        added = with_defaults(
            batch.join(known.select("file_path"), "file_path", "left_anti"), document_id(F.col("file_path")), now)

        rows = pages.select(
            document_id(F.col("file_path")).alias("document_id"), F.col("page").cast("int").alias("page"),
            "text", F.col("embeddings").cast("array<float>").alias("embeddings"))
        if not unique:
            content = F.min(F.struct("text", "embeddings")).alias("c")
            rows = rows.groupBy(*PAGE_KEY).agg(content).select(*PAGE_KEY, "c.text", "c.embeddings")
        old_keys = self._pages(newest, base).select(*PAGE_KEY, F.col("id").alias("_id"), F.col("created_at").alias("_at")).join(
            known.select(F.col("id").alias("document_id")), "document_id", "left_semi")
        met = self._note("met", version, old_keys.join(rows.select(*PAGE_KEY).distinct(), PAGE_KEY, "left_semi"))

        fresh_id = page_id(F.col("document_id"), F.col("page"))
        if mode == "replace":
            written = with_defaults(rows, fresh_id, now).join(met, PAGE_KEY, "left").withColumns(
                {"id": F.coalesce("_id", "id"), "created_at": F.coalesce("_at", "created_at")})
            void, moved = met.select(*PAGE_KEY), met.limit(0)
        else:
            written = with_defaults(rows.join(met, PAGE_KEY, "left_anti"), fresh_id, now)
            void, moved = met.select(*PAGE_KEY).limit(0), met
        touched = known.select(F.col("id").alias("document_id"), F.lit(None).cast("int").alias("page")).unionByName(
            moved.select(*PAGE_KEY)).withColumn("updated_at", now)
        self._write("documents", version, added.select(*DOCUMENTS.names), ["file_path"])
        self._write("pages", version, written.select(*DOCUMENT_PAGES.names), PAGE_KEY)
        self._write("touched", version, touched, PAGE_KEY)
        self._write("replaced", version, void, PAGE_KEY)
        self._publish(version, base, batch_id)
        return version

    def commit_checked(
        self, documents: DataFrame, pages: DataFrame, batch_id: int, now: Column | datetime,
        mode: str = "keep_first", width: int = EMBEDDING_WIDTH,
    ) -> tuple[int, DataFrame]:
        """Commit the rows of ``pages`` that keep every constraint; ``(version, rejects)``.

        Each page row is checked before anything is published: its path is not empty, its page is positive, its text is
        not empty, its vector has ``width`` elements and none NULL or NaN; its (path, page) is offered once in the batch (the
        primary key; all rows of a repeated key are rejected); its path is that of an offered or stored document; and in
        ``strict`` mode its path is not stored yet. ``rejects`` has the rejected rows with ``rules``, the sorted names of
        the rules they break; it is written beside the store's notes and counted before the rest is committed. Only keys
        travel to find repeated keys, missing and present documents; the rows themselves stay where they are.
        """
        newest, base, done = self._newest(batch_id)
        version = newest if done else newest + 1
        path = f"{self.root}/rejects/v={version}"
        if done:
            return newest, self.spark.read.parquet(path)
        stored = self._documents(newest, base).select("file_path")
        offered = documents.select("file_path").where(F.col("file_path").isNotNull())
        spec = Constraints(
            rows={"file_path_not_empty": F.length("file_path") > 0, "page_positive": F.col("page") > 0,
                  "text_not_empty": F.length("text") > 0, "embedding_width": has_width(F.col("embeddings"), width)},
            unique={"document_page_unique": ["file_path", "page"]},
            references={"document_exists": ("file_path", offered.unionByName(stored), "file_path")})
        if mode == "strict":
            spec.absent["file_path_unique"] = ("file_path", stored, "file_path")
        valid, broken = check_constraints(pages, spec)
        broken.withColumn("rules", F.array_sort("rules")).write.mode("overwrite").parquet(path)
        rejects = self.spark.read.parquet(path)
        rejects.count()
        # documents with a path that is not empty (and in strict mode not stored) are kept, with or without pages
        kept = offered.where(F.length("file_path") > 0).distinct()
        if mode == "strict":
            kept = kept.join(stored, "file_path", "left_anti")
        self.commit(kept, valid, batch_id, now, mode, unique=True)
        return version, rejects

    def compact(self) -> int:
        """Write both tables anew, as one version with nothing touched or replaced; the new version."""
        newest, base, _ = self._newest()
        version = newest + 1
        self._write("documents", version, self._documents(newest, base).hint("rebalance"), ["file_path"])
        self._write("pages", version, self._pages(newest, base).hint("rebalance"), PAGE_KEY)
        self._write("touched", version, empty_frame(self.spark, _TOUCHED), PAGE_KEY)
        self._write("replaced", version, empty_frame(self.spark, _REPLACED), PAGE_KEY)
        self._publish(version, version, None)
        return version

    def _note(self, name: str, version: int, df: DataFrame) -> DataFrame:
        """Store a narrow intermediate result: it is worked out once, and Spark knows its size when it
        plans the joins that use it."""
        path = f"{self.root}/notes/{name}/v={version}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _write(self, name: str, version: int, df: DataFrame, order: list[str]) -> None:
        # the order within files lets lookups by path or document skip row groups
        df.sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{self.root}/{name}/v={version}")

    def _publish(self, version: int, base: int, batch_id: int | None) -> None:
        row = pa.table({"version": pa.array([version], pa.int64()), "base": pa.array([base], pa.int64()),
                        "batch_id": pa.array([batch_id], pa.int64())})
        # no row of this version is published, but a writer that died may have left the folder
        self.spark.createDataFrame(row).coalesce(1).write.mode("overwrite").json(
            f"{self.root}/manifest/v={version:012d}")


def _with_touch(stored: DataFrame, schema: T.StructType) -> DataFrame:
    moved = F.greatest("updated_at", "_touched").alias("updated_at")
    return stored.select(*[moved if c == "updated_at" else c for c in schema.names])
