"""Recognised items kept by the content of the file they came from.

A file is known by the SHA-256 of its bytes, so a copy under another name is recognised once. Results stay in a logged table, one row per (content, engine): a
second run over the same files, or a run that goes on after one that died, reads them and recognises only what is new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import content_key
from ..session import written
from .items import cache_split
from .tablelog import TableLog

_SCHEMA = T.StructType([T.StructField("engine", T.StringType()), T.StructField("content_key", T.StringType()), T.StructField("items", T.StringType())])


def files_of(spark: SparkSession, folder: str, suffix: str = "*") -> DataFrame:
    """Files below a folder with their bytes and content key: path, content, content_key."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).load(folder)
    return found.select("path", "content", content_key(F.col("content")).alias("content_key"))


class ItemCache:
    """The cache in ``path``, a folder all executors share. ``recognise`` makes content_key and items of a table of content_key and content."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = TableLog(spark, path, _SCHEMA, by=("engine",))

    def rows(self) -> DataFrame:
        return self.log.read()

    def run(self, files: DataFrame, engine: str, recognise: Callable[[DataFrame], DataFrame], batch: str) -> DataFrame:
        """Recognise what the cache does not hold and add it to the cache; returns path, content_key and cache_hit of every file.

        The bytes of a content are read from one of its files. ``batch`` names the run: if it died after its commit, nothing is done again.
        """
        keys = files.select("path", "content_key", F.lit(engine).alias("engine"))
        known = written(cache_split(keys, self.rows()))
        first = known.where("NOT cache_hit").groupBy("content_key").agg(F.min("path").alias("path"))
        # Only the bytes of files without a result are read beyond their hash.
        missing = files.join(first, ["path", "content_key"], "left_semi").select("content_key", "content")
        fresh = recognise(missing).select(F.lit(engine).alias("engine"), "content_key", "items")
        self.log.append(fresh, batch)
        return known.drop("engine")
