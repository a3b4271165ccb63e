"""Shared folders, written intermediates and row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the one all executors share; a local one only for a local master with none set."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(base)
    path = context._jvm.org.apache.hadoop.fs.Path(base)  # a folder without scheme belongs to the default file system of the cluster
    base = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    base = base.replace("file:/", "file:///", 1) if base.startswith("file:/") and not base.startswith("file://") else base
    return f"{base.rstrip('/')}/{context.applicationId}-llm/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as a written table in the shared folder: lineage ends there, and its size is known to later joins."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    place, raw = _place(df.sparkSession, path)
    place.deleteOnExit(raw)  # what nothing discards goes when the session ends
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    raw = context._jvm.org.apache.hadoop.fs.Path(path)
    return raw.getFileSystem(context._jsc.hadoopConfiguration()), raw


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored tables; only for tables whose last reader has been written."""
    for df in frames:
        place, raw = _place(df.sparkSession, df.stored_at)
        place.delete(raw, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def row_key(*columns: Column | str) -> list[Column]:
    """128 bits that stand for the values of the columns (nulls allowed), as k1 and k2."""
    return [F.xxhash64(F.lit(1), *columns).alias("k1"), F.xxhash64(F.lit(2), *columns).alias("k2")]
