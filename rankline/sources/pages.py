"""Page files as a Spark source: cells and links of HTML pages, each page parsed once.

``spark.read.format("html_pages")`` plans one partition per row group of the Parquet files below ``path`` and reads only the columns it needs. Every page goes
through one parser that feeds both collectors; the option ``rows`` says which rows come out: ``cells``, ``links`` or ``both``. ``key``, ``url`` and ``html`` name
the columns, ``key_type`` is bigint or string.
Files are read with pyarrow, so the folder's scheme must be one that pyarrow knows.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import qualified
from .html import LinkCollector, TableCollector, cells_of_tables, links_found

FLUSH_ROWS = 20_000
_CELL = (("table_idx", pa.int32()), ("row_idx", pa.int32()), ("col_idx", pa.int32()), ("value", pa.string()))
_LINK = (("base_url", pa.string()), ("tag_no", pa.int32()), ("tag", pa.string()), ("href", pa.string()), ("text", pa.string()))
_KEYS = {"bigint": pa.int64(), "string": pa.string()}
_NAMES = {pa.int32(): "int", pa.string(): "string", pa.int64(): "bigint"}


class _Once(HTMLParser):
    """One parse for several collectors."""

    def __init__(self, collectors):
        super().__init__(convert_charrefs=True)
        self.collectors = collectors

    def handle_starttag(self, tag, attrs):
        for c in self.collectors:
            c.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for c in self.collectors:
            c.handle_endtag(tag)

    def handle_data(self, data):
        for c in self.collectors:
            c.handle_data(data)


def parse(html: str | None, cells: bool, links: bool) -> tuple[list[tuple], list[tuple]]:
    """Cells (table, row, column, text) and links (number, tag, target, text) of a page."""
    tables, found = TableCollector(), LinkCollector()
    parser = _Once([c for c, wanted in ((tables, cells), (found, links)) if wanted])
    parser.feed(html or "")
    parser.close()
    return cells_of_tables(tables), links_found(found)


def file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
    return fs.FileSystem.from_uri(path)


@dataclass
class RowGroup(InputPartition):
    path: str
    number: int


class PageReader(DataSourceReader):
    def __init__(self, options: dict, kinds: tuple[bool, bool]):
        self.options, self.kinds = options, kinds
        self.key, self.url, self.html = options.get("key", "page_id"), options.get("url", "url"), options.get("html", "html")
        self.key_type = _KEYS[options.get("key_type", "bigint")]

    def partitions(self) -> list[RowGroup]:
        from pyarrow import fs

        place, path = file_system(self.options["path"])
        info = place.get_file_info(path)
        files = [path] if info.type == fs.FileType.File else sorted(f.path for f in place.get_file_info(fs.FileSelector(path, recursive=True)) if f.path.endswith(".parquet"))
        out = []
        for name in files:
            with place.open_input_file(name) as source:
                out += [RowGroup(name, i) for i in range(pq.ParquetFile(source).num_row_groups)]
        return out

    def read(self, partition: RowGroup):
        cells, links = self.kinds
        columns = [self.key, self.html, *([self.url] if links else [])]
        fields = [("page", self.key_type), *(_CELL if cells else ()), *(_LINK if links else ())]
        shape = pa.schema(fields)
        place, _ = file_system(self.options["path"])
        rows: list[tuple] = []

        def flush():
            done = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], schema=shape)
            rows.clear()
            return done

        no_cell, no_link = (None,) * len(_CELL) * cells, (None,) * len(_LINK) * links
        with place.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=512, row_groups=[partition.number], columns=columns):
                urls = batch.column(self.url).to_pylist() if links else [None] * batch.num_rows
                for page, html, url in zip(batch.column(self.key).to_pylist(), batch.column(self.html).to_pylist(), urls, strict=True):
                    found_cells, found_links = parse(html, cells, links)
                    rows += [(page, *c, *no_link) for c in found_cells]
                    rows += [(page, *no_cell, url, *x) for x in found_links]
                    if len(rows) >= FLUSH_ROWS:
                        yield flush()
        if rows:
            yield flush()


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "html_pages"

    def _kinds(self) -> tuple[bool, bool]:
        rows = self.options.get("rows", "both")
        if rows not in ("cells", "links", "both"):
            raise ValueError(f"rows must be cells, links or both, not {rows}")
        return rows != "links", rows != "cells"

    def schema(self) -> str:
        cells, links = self._kinds()
        return ", ".join(f"{n} {_NAMES[t]}" for n, t in (("page", _KEYS[self.options.get("key_type", "bigint")]), *(_CELL if cells else ()), *(_LINK if links else ())))

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options), self._kinds())


def read_pages(spark: SparkSession, path: str, rows: str = "both", **columns: str) -> DataFrame:
    """Rows of the pages in a Parquet file or folder. With ``both``, link columns of cell rows are null and the other way round."""
    spark.dataSource.register(PageSource)
    return spark.read.format("html_pages").options(path=qualified(spark, path), rows=rows, **columns).load()


def cells_in(rows: DataFrame) -> DataFrame:
    return rows.where("table_idx IS NOT NULL").select("page", "table_idx", "row_idx", "col_idx", "value")


def links_in(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("tag_no").isNotNull()).select("page", "base_url", "tag_no", "tag", "href", "text")
