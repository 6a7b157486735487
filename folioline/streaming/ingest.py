"""Ingest as a stream of link files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from folioline.plans.ingest import Ingest


def stream_links(
    spark: SparkSession, path: str, schema="link string", fmt: str = "parquet", files_per_trigger: int = 100
) -> DataFrame:
    """Links as a stream of the files added to a folder."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def ingest_stream(
    links: DataFrame, ingest: Ingest, checkpoint: str, now: Column | datetime, wait: bool = True
):
    """Run each micro-batch of ``links`` through ``ingest`` until all that has arrived is done.

    The checkpoint takes the place of the queue's state; a batch that is replayed after a failure
    has the same number, and the tables have it or not.
    """
    query = (
        links.writeStream.foreachBatch(lambda batch, batch_id: ingest.run(batch.select("link"), batch_id, now))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if wait:
        query.awaitTermination()
    return query
