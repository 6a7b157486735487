"""Rejects and the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from folioline.schema import REJECTS


def as_rejects(frames: list[DataFrame], batch_id: int) -> DataFrame:
    """One reject table from ``(link, stage, error)`` frames."""
    merged = reduce(DataFrame.unionByName, [f.select("link", "stage", "error") for f in frames])
    return merged.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*REJECTS.names)


def as_log(df: DataFrame, now: Column, batch_id: int, domain: str = "processor") -> DataFrame:
    """Log rows from ``(link, stage, error, seconds)``: an error where there is one, else a debug line."""
    failed = F.col("error").isNotNull()
    return df.select(
        F.when(failed, F.lit("error")).otherwise(F.lit("debug")).alias("level"),
        F.when(failed, F.concat(F.lit("failed "), F.col("stage"), F.lit(": "), F.col("error")))
        .otherwise(F.concat(F.lit("finished "), F.col("stage"))).alias("msg"),
        now.alias("time"),
        F.lit(domain).alias("domain"),
        "link",
        "stage",
        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"),
        F.col("seconds").cast("double").alias("seconds"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )


def stage_summary(log: DataFrame, percentile: bool = True) -> DataFrame:
    """Rows and time per stage and outcome."""
    aggs = [F.count("*").alias("n"), F.avg("seconds").alias("avg_seconds")]
    if percentile:
        aggs.append(F.percentile_approx("seconds", [0.5, 0.95]).alias("p50_p95_seconds"))
    return log.groupBy("stage", "status").agg(*aggs)
