"""The page source against the parsers it is made of."""

import random

import pytest
from rankline.sources import html, pages


def test_cells_and_links_of_page_files(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        table = "<table>" + "".join("<tr>" + "".join(f"<td colspan={rng.randint(1, 2)}>{rng.choice(['a', '', ' b  c ', '&amp;'])}</td>" for _ in range(3)) + "</tr>" for _ in range(rng.randint(0, 4))) + "</table>"
        rows.append((i, f"https://x.example/{i}", table + f'<a href="/p{i}">t <b>x</b></a><img src=" i.png "><script>"<a href=no>"</script><!-- <a href="/no"> -->', 7))
    rows += [(900, None, None, 1), (901, "u", "", 1), (902, "u", "<table><tr><td>open", 1), (None, "u", "<a href=x>y", 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, value int").repartition(3).write.parquet(f"{tmp_path}/pages")
    both = pages.read_pages(spark, f"{tmp_path}/pages")
    assert both.rdd.getNumPartitions() == 3
    key = lambda r: tuple(str(x) for x in r)
    cells = [(i, *c) for i, _, text, _ in rows for c in html.page_cells(text)]
    links = [(i, u, *x) for i, u, text, _ in rows for x in html.page_links(text)]
    assert sorted(map(tuple, pages.cells_in(both).collect()), key=key) == sorted(cells, key=key)
    assert sorted(map(tuple, pages.links_in(both).collect()), key=key) == sorted(links, key=key)
    assert sorted(map(tuple, pages.read_pages(spark, f"{tmp_path}/pages", "cells").collect()), key=key) == sorted(cells, key=key)
    assert pages.read_pages(spark, f"{tmp_path}/pages", "links").count() == len(links)


def test_other_kinds_of_rows_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="rows must be"):
        pages.read_pages(spark, f"{tmp_path}/pages", "words").collect()
