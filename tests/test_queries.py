"""Every part of the catalogue against its SQL on the smallest data."""

import os
import sys

import pytest

from compare import compare, duck
from rankline.operators.tablelog import TableLog
from rankline.plans import catalog
from rankline.plans.inputs import BASE

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "H4_score_to_rank", "H5_rank_to_score_not_monotone", "H7_schools_by_equivalent_score", "G2_schools_by_rank", "H1_search_enriched", "I9_null_rates", "I13_score_histogram",
    "J4_monotonic_violations", "M4_regression_gate", "C28_province_metadata", "E6_errors_with_row_numbers", "F2_append_schools", "F6_upsert_metadata", "K1_clustered_rows", "A6_page_attachments",
    "B1_header_rows", "L1_announcements",
    "B8_parse_school_sheets", "B20_table_scores", "K9_irregular_rows", "K18_fast_engine_gate", "F13_recognised_chain", "A4_page_links",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, name):
    ok, message, _, _ = compare(spark, duck(FOLDER), name, catalog.queries()[name], catalog.checks()[name], FOLDER)
    assert ok, message


FEW = {"orders": "o_orderkey <= 200", "lineitem": "l_orderkey <= 200", "events": "event_id <= 200", "documents": "doc_id <= 30", "pages": "page_id <= 10"}


@pytest.fixture(scope="module")
def few_rows(spark, tmp_path_factory):
    """The given tables, the large ones with their first rows only."""
    folder = tmp_path_factory.mktemp("few")
    for name in BASE:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").where(FEW.get(name, "true")).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def no_writes(spark, monkeypatch):
    """Intermediates are analysed, and stand for tables without rows."""
    def emptied(df):
        return df.sparkSession.createDataFrame([], df.schema)

    for name, module in list(sys.modules.items()):
        if name.startswith("rankline."):
            for helper in ("written", "cut_lineage"):
                if hasattr(module, helper) and not name.startswith("rankline.llm"):
                    monkeypatch.setattr(module, helper, emptied)
    monkeypatch.setattr(TableLog, "append", lambda self, rows, batch, files=8: bool(rows.schema) and False)
    monkeypatch.setattr(TableLog, "write_attempt", lambda self, rows, files: str(rows.schema))
    report = "files_touched long, files_untouched long, rows_before long, rows_after long"
    monkeypatch.setattr(TableLog, "rewrite", lambda self, batch, touched, change, files=8: emptied(change(self.read()).where(touched)) and self.spark.createDataFrame([], report))


@pytest.mark.parametrize("group", sorted({name[0] for name in catalog.queries()}))
def test_every_query_can_be_built(spark, few_rows, no_writes, group):
    """Analysis of every plan finds missing names and columns."""
    for name, build in catalog.queries().items():
        if name[0] == group:
            df = build(spark, few_rows)
            assert df.columns and len(set(df.columns)) == len(df.columns), name


def test_every_check_has_a_query():
    assert set(catalog.checks()) <= set(catalog.queries())
