"""Run log as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_run_log(log: DataFrame, path: str, mode: str = "append") -> None:
    log.write.mode(mode).json(path)
