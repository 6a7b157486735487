"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


_shipped: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make this package importable in the Python workers, once per application.

    Wherever the driver found it, executors get it as a file of the application.
    """
    context = (spark or SparkSession.active()).sparkContext
    package = Path(__file__).parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="folioline-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def build_session(app: str = "folioline", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings the operators count on. ``conf`` overrides any of them.

    AQE splits skewed join partitions, joins by broadcast only where the measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and merges small shuffle
    partitions, so the shuffle partition count may be set high on a cluster.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # vectors are wide: 2,000 rows of 1,536 floats are 12 MB a batch
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="folioline-")
    return f"{base.rstrip('/')}/folioline-{purpose}-{uuid.uuid4().hex}"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, without starting any Python worker."""
    columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*columns)


def small_frame(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A handful of driver-side rows as a local relation, whose size Spark knows when it plans joins."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table({name: pa.array(column) for name, column in zip(names, columns)}))


# A scan of fewer splits than this is small: at most 1 GB at the default split size.
FEW_SPLITS = 8


def spread(table: DataFrame) -> DataFrame:
    """Spread a small scan over the cores before work that is heavy on CPU.

    A table in one small file would keep one core busy. A scan of ``FEW_SPLITS`` or more is left as it
    is, so that nothing big is shuffled for this. For plain scans only.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < min(cores, FEW_SPLITS) else table


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Store a narrow intermediate result in the shared folder and read it back.

    It is worked out once, and Spark knows its size when it plans the joins that use it: a small one
    is broadcast, so that the wide table on the other side is not shuffled; a large one is not.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
