"""Text out of stored files."""

from __future__ import annotations

import subprocess
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from folioline.session import ship_package


def command_extractor(command: list[str]) -> Callable[[bytes], str]:
    """Extractor that pipes a file through an external program, such as
    ``["pdftotext", "-", "-"]``; a failing program is an error of that file."""

    def run(content: bytes) -> str:
        done = subprocess.run(command, input=content, capture_output=True, check=True)
        return done.stdout.decode("utf-8", errors="replace")

    return run


def extract_text(
    blobs: DataFrame, extractor: Callable[[bytes], str] | None = None, content_col: str = "content"
) -> DataFrame:
    """``content`` replaced by ``text``, ``error`` and ``seconds``; one of text and error is NULL.

    Without an extractor files are taken as UTF-8 text, decoded in the JVM.
    """
    keep = [c for c in blobs.columns if c != content_col]
    if extractor is None:
        valid = F.is_valid_utf8(F.col(content_col).cast("string"))
        return blobs.select(
            *keep,
            F.when(valid, F.col(content_col).cast("string")).alias("text"),
            F.when(F.col(content_col).isNull(), F.lit("no content"))
            .when(~valid, F.lit("not UTF-8 text")).alias("error"),
            F.lit(0.0).alias("seconds"),
        )

    def run(batches):
        for batch in batches:
            texts, errors, seconds = [], [], []
            for content in batch[content_col]:
                start = time.monotonic()
                try:
                    texts.append(extractor(bytes(content)))
                    errors.append(None)
                except Exception as error:
                    texts.append(None)
                    errors.append(str(error) or type(error).__name__)
                seconds.append(time.monotonic() - start)
            out = batch[keep].copy()
            out["text"], out["error"], out["seconds"] = pd.Series(texts, dtype=object, index=out.index), \
                pd.Series(errors, dtype=object, index=out.index), seconds
            yield out

    ship_package(blobs.sparkSession)
    schema = T.StructType(
        [blobs.schema[c] for c in keep]
        + [T.StructField("text", T.StringType()), T.StructField("error", T.StringType()),
           T.StructField("seconds", T.DoubleType())])
    return blobs.mapInPandas(run, schema)
