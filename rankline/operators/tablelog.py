"""Parquet tables whose files count once a commit names them: retry-safe appends and changes in place.

Spark jobs write files, and files of a job that died, or of a batch that ran twice, look like any others. Here each attempt
writes to a folder of its own, and one small log entry, put in place by a rename that never overwrites, names the files it adds and those it
replaces. Readers take the files the entries add and do not remove. A batch whose id is in the log is not written again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_freed

_ENTRY = "batch string, action string, file string, rows long"


class TableLog:
    """A table in ``path``, with a folder per value of the ``by`` columns inside each attempt. ``path`` lies in a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: tuple[str, ...] = ("year", "province")):
        self.spark, self.schema, self.by = spark, schema, by
        jvm = spark.sparkContext._jvm
        self._conf, self._path = spark.sparkContext._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path
        raw = self._path(path)
        self._fs = raw.getFileSystem(self._conf)
        self.root = self._fs.makeQualified(raw).toString().rstrip("/")
        kept = [f for f in schema.fields if f.name not in by]
        self._stored = T.StructType([*kept, T.StructField("_attempt", T.StringType()), *[schema[c] for c in by]])

    # ---- the log

    def _versions(self) -> list[str]:
        folder = self._path(f"{self.root}/log")
        found = [s.getPath().toString() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(f for f in found if f.rsplit("/", 1)[1].startswith("v"))

    def entries(self) -> DataFrame:
        """Files added and removed by all commits: batch, action, file (below the root), rows."""
        found = self._versions()
        return self.spark.read.schema(_ENTRY).parquet(*found) if found else self.spark.createDataFrame([], _ENTRY)

    def has(self, batch: str) -> bool:
        return not self.entries().where(F.col("batch") == batch).isEmpty()

    def live(self) -> DataFrame:
        """Files (file, rows) of the table as it is now."""
        entries = self.entries()
        return entries.where("action = 'add'").join(entries.where("action = 'remove'").select("file"), "file", "left_anti").select("file", "rows")

    def _commit(self, entry: DataFrame, gone: list[str] = ()) -> None:
        """Put the entry in place as the next version; if another writer was first, the one after, unless that writer took files this one replaces."""
        draft = f"{self.root}/log/.draft-{uuid.uuid4().hex}"
        entry.coalesce(1).write.parquet(draft)
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(self.root), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        while True:
            if gone and self.live().where(F.col("file").isin(list(gone))).count() < len(gone):
                raise RuntimeError("another writer has replaced files of this change")
            number = len(self._versions()) + 1
            try:
                context.rename(self._path(draft), self._path(f"{self.root}/log/v{number:09d}"), plain)
                return
            except Py4JJavaError as error:
                if "AlreadyExists" not in error.java_exception.getClass().getName():
                    raise

    # ---- the files

    def write_attempt(self, rows: DataFrame, files: int) -> str:
        """Write an attempt; nothing of it is in the table until a commit names its files."""
        attempt = uuid.uuid4().hex
        salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in self.by]), F.lit(files))
        with shuffles_freed(self.spark):
            rows.select(*self.schema.names).repartition(*self.by, salt).write.partitionBy(*self.by).parquet(f"{self.root}/data/_attempt={attempt}")
        return attempt

    def _named(self) -> Column:
        """File of a row, below the root; the name Spark gives is percent-encoded."""
        whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        return F.regexp_extract(whole, r"(data/_attempt=.*)$", 1)

    def _scan(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        return self.spark.read.schema(self._stored).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/{p}" for p in paths])

    def _added(self, batch: str, attempt: str) -> DataFrame:
        """Entry rows for the files of an attempt; row counts come from the footers."""
        folder = self._path(f"{self.root}/data/_attempt={attempt}")
        written = any(s.isDirectory() for s in self._fs.listStatus(folder))  # an attempt without rows has no folders
        rows = self._scan([f"data/_attempt={attempt}"]).groupBy(self._named().alias("file")).agg(F.count("*").alias("rows")) if written else self.spark.createDataFrame([], "file string, rows long")
        return rows.select(F.lit(batch).alias("batch"), F.lit("add").alias("action"), "file", "rows")

    def _mark(self, batch: str) -> DataFrame:
        """An entry row that names the batch even if it changes no file."""
        return self.spark.createDataFrame([(batch, "batch", None, None)], _ENTRY)

    def read(self) -> DataFrame:
        """Rows of the committed files."""
        return self._scan([r["file"] for r in self.live().select("file").collect()]).select(*self.schema.names)

    # ---- changes

    def append(self, rows: DataFrame, batch: str, files: int = 8) -> bool:
        """Add the rows of a batch, once: False and nothing written if the log has the batch. A (``by``) folder gets ``files`` files or fewer."""
        if self.has(batch):
            return False
        self._commit(self._added(batch, self.write_attempt(rows, files)).unionByName(self._mark(batch)))
        return True

    def rewrite(self, batch: str, touched: Column, change: Callable[[DataFrame], DataFrame], files: int = 8) -> DataFrame:
        """Replace the files that hold a row for which ``touched`` is true by files with what ``change`` makes of their rows; the others are not read in full
        nor written. Returns files_touched, files_untouched, rows_before and rows_after of the touched files. A batch in the log changes nothing again.
        """
        if not self.has(batch):
            live = self.live()
            paths = [r["file"] for r in live.select("file").collect()]
            hit = self._scan(paths).where(touched).select(self._named().alias("file")).distinct()
            gone = live.join(hit, "file").select(F.lit(batch).alias("batch"), F.lit("remove").alias("action"), "file", "rows").collect()
            names = [r["file"] for r in gone]
            removed = self.spark.createDataFrame(gone, _ENTRY)
            entry = removed.unionByName(self._mark(batch))
            if names:
                entry = entry.unionByName(self._added(batch, self.write_attempt(change(self._scan(names).select(*self.schema.names)), files)))
            self._commit(entry, names)
        own = self.entries().where(F.col("batch") == batch)
        count = lambda action: F.count_if(F.col("action") == action)
        rows = lambda action: F.coalesce(F.sum(F.when(F.col("action") == action, F.col("rows"))), F.lit(0))
        done = own.agg(count("remove").alias("files_touched"), rows("remove").alias("rows_before"), rows("add").alias("rows_after"), count("add").alias("_added"))
        live = self.live().agg(F.count("*")).scalar()
        return done.select("files_touched", (live - F.col("_added")).alias("files_untouched"), "rows_before", "rows_after")
