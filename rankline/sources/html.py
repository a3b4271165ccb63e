"""Tables and links of HTML pages as rows. The one place that runs Python in tasks: per page, cells in Arrow batches, links row by row."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLUSH_ROWS = 20000
CELL_FIELDS = "table_idx int, row_idx int, col_idx int, value string"


class TableCollector(HTMLParser):
    """Collects (text, rowspan, colspan) per cell of every table, nested tables on their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list]]] = []
        self.open: list[list[list[list]]] = []
        self.cells: list[list | None] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append(self.tables[-1])
            self.cells.append(None)
        elif self.open and tag == "tr":
            self.open[-1].append([])
            self.cells[-1] = None
        elif self.open and tag in ("td", "th"):
            if not self.open[-1]:
                self.open[-1].append([])
            spans = dict(attrs)
            cell = ["", _span(spans.get("rowspan"), MOST_ROWS), _span(spans.get("colspan"), MOST_COLUMNS)]
            self.open[-1][-1].append(cell)
            self.cells[-1] = cell

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
            self.cells.pop()
        elif tag in ("td", "th", "tr") and self.cells:
            self.cells[-1] = None

    def handle_data(self, data):
        if self.cells and self.cells[-1] is not None:
            self.cells[-1][0] += data


# Bounds that the HTML standard sets on the two attributes.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def _span(value, most: int) -> int:
    return min(int(value), most) if value and value.isascii() and value.isdigit() and int(value) > 0 else 1


def _grid(rows) -> list[dict[int, str]]:
    """Rows as {column: text}; a spanning cell repeats its text in every place it covers.

    Cells that span beyond the last row add the rows they reach.
    """
    grid: list[dict[int, str]] = []
    pending: dict[int, tuple[str, int]] = {}
    waiting = iter(rows)
    while True:
        row = next(waiting, None)
        if row is None and not pending:
            return grid
        line, carried = {}, {}
        for col, (text, left) in pending.items():
            line[col] = text
            if left > 1:
                carried[col] = (text, left - 1)
        col = 0
        for text, down, across in row or ():
            while col in line:
                col += 1
            for _ in range(across):
                line[col] = " ".join(text.split())
                if down > 1:
                    carried[col] = (line[col], down - 1)
                col += 1
        pending = carried
        grid.append(line)


def page_cells(html: str) -> list[tuple[int, int, int, str | None]]:
    """(table, row, column, text) of all tables of a page, empty rows and columns left out, empty cells None."""
    parser = TableCollector()
    parser.feed(html or "")
    parser.close()
    return cells_of_tables(parser)


def cells_of_tables(parser: TableCollector) -> list[tuple[int, int, int, str | None]]:
    out = []
    for number, rows in enumerate(parser.tables):
        grid = [line for line in _grid(rows) if any(line.values())]
        columns = sorted({c for line in grid for c, text in line.items() if text})
        for r, line in enumerate(grid):
            out.extend((number, r, c, line.get(col) or None) for c, col in enumerate(columns))
    return out


def cells_of_pages(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per table cell of every page."""
    key_type = pages.schema[key].dataType.simpleString()

    columns = [key, "table_idx", "row_idx", "col_idx", "value"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for k, text in zip(batch[key], batch[html]):
                rows.extend((k, *cell) for cell in page_cells(text))
                if len(rows) >= FLUSH_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)

    return pages.select(key, html).mapInPandas(run, f"{key} {key_type}, {CELL_FIELDS}")


class LinkCollector(HTMLParser):
    """Collects (tag, target, text) of links and images in order; text pieces are stripped and joined without blanks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list | None = None
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag in ("a", "img"):
            target = next((v for k, v in attrs if k == ("href" if tag == "a" else "src")), None)
            entry = [tag, target, ""]
            if target is not None:
                self.found.append(entry)
            if tag == "a":  # a link ends where the next begins
                self.open = entry

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "a":
            self.open = None

    def handle_data(self, data):
        if self.open is not None and not self.hidden:
            self.open[2] += data.strip()


def page_links(html: str) -> list[tuple[int, str, str, str]]:
    """(number, tag, target, text) of the links and images of a page that have a target."""
    parser = LinkCollector()
    parser.feed(html or "")
    parser.close()
    return links_found(parser)


def links_found(parser: LinkCollector) -> list[tuple[int, str, str, str]]:
    return [(i, tag, target.strip(), text) for i, (tag, target, text) in enumerate(parser.found)]


_LINK_ROWS = "array<struct<tag_no int, tag string, href string, text string>>"


def links_of_pages(pages: DataFrame, key: str, url: str = "url", html: str = "html") -> DataFrame:
    """One row per link or image of every page, as a parser sees them: what stands in comments and scripts is none.

    Pages go to Python a hundred at a time and their links come back page by page, so a task holds neither more pages nor more links as its share of the input grows.
    """
    found = F.udf(page_links, _LINK_ROWS, useArrow=False)
    return pages.select(key, F.col(url).alias("base_url"), F.inline(found(F.col(html))))
