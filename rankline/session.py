"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins from measured sizes (a broadcast is only taken below the
# threshold, with a shuffle join beyond it) and splits hot shuffle partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "rankline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _base_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def shared_folder(spark: SparkSession) -> str:
    """A new folder name in the folder of the cluster that all executors share; a local one only where none is named (tests)."""
    return f"{_base_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder; the files go when the frame is no longer referenced."""
    _base_folder(df.sparkSession)
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written, not when the driver happens to collect its garbage."""
    if not spark.conf.isModifiable(_CLEANUP):  # a Spark without the setting
        yield
        return
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and the planner knows the table's size. The files go when the session ends."""
    path = shared_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    context = df.sparkSession.sparkContext
    raw = context._jvm.org.apache.hadoop.fs.Path(path)
    raw.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(raw)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; one without belongs to the default file system of the cluster."""
    raw = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(raw).toString()
