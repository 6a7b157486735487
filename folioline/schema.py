"""Schemas of the stored tables."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("file_path", T.StringType(), False),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DOCUMENT_PAGES = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("document_id", T.StringType(), False),
    T.StructField("page", T.IntegerType(), False),
    T.StructField("text", T.StringType(), False),
    T.StructField("embeddings", T.ArrayType(T.FloatType(), False), False),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

REJECTS = T.StructType([
    T.StructField("link", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

RUN_LOG = T.StructType([
    T.StructField("level", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("domain", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("batch_id", T.LongType()),
])

# Texts of rejects.
INVALID_URL = "no storage path: a parameter of the URL is missing or broken"
NO_HREF = "row without a document anchor"
NO_EMBEDDINGS = "embedder gave fewer vectors than texts"
