"""Contents of links."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from folioline.fixed import FETCH_SLOTS
from folioline.session import ship_package

# Contents go on as soon as so many bytes are there.
PART_BYTES = 32 << 20


def url_fetcher(timeout: float = 60.0) -> Callable[[str], bytes]:
    """Fetcher that opens the link; any status but 200 is an error."""

    def run(link: str) -> bytes:
        with urllib.request.urlopen(link, timeout=timeout) as answer:
            status = getattr(answer, "status", None)
            if status not in (None, 200):
                raise OSError(f"HTTP status {status}")
            return answer.read()

    return run


def fetch(
    links: DataFrame, fetcher: Callable[[str], bytes], slots: int = FETCH_SLOTS, link_col: str = "link",
    cluster_by: str | None = None, most_bytes: int = PART_BYTES,
) -> DataFrame:
    """Add ``content``, ``error`` and ``seconds``; a link that fails is a row with an error.

    ``slots`` is the number of tasks, hence of requests at a time: the politeness cap. With ``cluster_by`` a
    task gets a range of that column, so that what it fetches can be written where it belongs
    without a shuffle of the contents. A task holds ``most_bytes`` of contents and one file more at a time.
    """

    def run(batches):
        for batch in batches:
            begin, contents, errors, seconds = 0, [], [], []
            for link in batch[link_col]:
                start = time.monotonic()
                try:
                    contents.append(fetcher(link))
                    errors.append(None)
                except Exception as error:
                    contents.append(None)
                    errors.append(str(error) or type(error).__name__)
                seconds.append(time.monotonic() - start)
                if sum(len(c) for c in contents if c) >= most_bytes:
                    yield fetched(batch.iloc[begin:begin + len(contents)], contents, errors, seconds)
                    begin, contents, errors, seconds = begin + len(contents), [], [], []
            if contents:
                yield fetched(batch.iloc[begin:], contents, errors, seconds)

    def fetched(links, contents, errors, seconds):
        return links.assign(content=pd.Series(contents, dtype=object, index=links.index),
                            error=pd.Series(errors, dtype=object, index=links.index), seconds=seconds)

    ship_package(links.sparkSession)
    schema = T.StructType(links.schema.fields + [
        T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType()),
        T.StructField("seconds", T.DoubleType())])
    shared = links.repartitionByRange(slots, cluster_by) if cluster_by else links.repartition(slots)
    return shared.mapInPandas(run, schema)


def fetch_from_landing(
    links: DataFrame, landing: DataFrame, link_col: str = "link", landing_col: str = "url",
    content_col: str = "content",
) -> DataFrame:
    """The same from a table of fetched files, by join. ``landing`` has one row per address.

    Found and missing links are told apart by two joins instead of an outer one: the missing ones need
    addresses only, and in the inner join a small set of links can be broadcast, so that no
    content is shuffled. ``links`` is read twice and should be a stored table.
    """
    table = landing.select(F.col(landing_col).alias(link_col), F.col(content_col).cast("binary").alias("content"))
    found = links.join(table, link_col).withColumn(
        "error", F.when(F.col("content").isNull(), F.lit("no content")))
    missing = links.join(table.select(link_col), link_col, "left_anti").withColumns(
        {"content": F.lit(None).cast("binary"), "error": F.lit("not found in landing table")})
    columns = [*links.columns, "content", "error"]
    return found.select(*columns).unionByName(missing.select(*columns)).withColumn("seconds", F.lit(0.0))
