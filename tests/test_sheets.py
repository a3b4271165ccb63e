"""How often sheets are shuffled and worked out: one shuffle by sheet, one pass over the cells, one resolution per distinct header."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from rankline.operators import cells, grids
from rankline.plans import q_cells
from rankline.plans.inputs import Inputs

HEAD = ["院校代号", "院校名称", "投档最低分", "位次"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Forty orders of three lines."""
    path = str(tmp_path_factory.mktemp("given"))
    day = datetime.date(1995, 1, 1)
    lines = [(o, 1, 1, n, 5, 17000.0, "R", "O", day) for o in range(40) for n in (1, 2, 3)]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate date"
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, "cold ring", "Brand#1", "PROMO")], "p_partkey bigint, p_name string, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(1, 1)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    spark.createDataFrame([(1, 1)], "n_nationkey int, n_regionkey int").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(1, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{path}/region.parquet")
    return path


def test_school_lines_are_cut_into_tasks_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(q_cells, "_LINES_A_TASK", 10)
    lines = Inputs(spark, folder).school_lines
    assert lines.rdd.getNumPartitions() == 12
    assert sorted((r.file_id, r.row_idx) for r in lines.collect()) == [(o, n) for o in range(40) for n in (2, 3, 4)]


def test_rows_of_school_sheets_need_one_shuffle(spark, folder):
    rows = cells.gathered_rows(Inputs(spark, folder).school_cells, ["file_id"])
    assert plan(rows).count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def sheets(spark):
    """Sheets 1 and 2 have equal headers; sheet 3 has no header words; the last column of sheet 2 is empty below its header."""
    out = []
    for f in (1, 2):
        out += [(f, 0, 0, "投档表")] + [(f, 1, i, h) for i, h in enumerate(HEAD)]
        out += [(f, r, i, v if f == 1 or i < 3 else None) for r in (2, 40) for i, v in enumerate(["A1", "北京大学", "600", "7"])]
    out += [(3, 0, 0, "x"), (3, 1, 0, "y"), (None, 0, 0, "院校代号"), (None, 1, 0, "z")]
    return spark.createDataFrame(out, "file_id bigint, row_idx int, col_idx int, value string")


def test_header_cells_and_columns(sheets):
    headers, _ = cells.split_header(sheets, ["file_id"])
    found = {(r.file_id, r.col_idx, r.header) for r in headers.collect()}
    assert found == {(1, i, h) for i, h in enumerate(HEAD)} | {(2, i, h) for i, h in enumerate(HEAD[:3])} | {(3, 0, "x")}
    columns = {(r.file_id, r.canonical, r.col_idx) for r in cells.used_columns(cells.resolve_columns(headers, ["file_id"], cells.aliases_for("school")), ["file_id"]).collect()}
    both = {(f, n, c) for f in (1, 2) for n, c in (("school_code", 0), ("school_name", 1), ("min_score", 2))}
    assert columns == both | {(1, "min_rank", 3)}


def test_columns_are_resolved_without_a_second_pass_over_the_cells(sheets):
    marked = sheets.where(F.col("row_idx") < 987654)
    headers, _ = cells.split_header(marked, ["file_id"])
    assert "987654" not in plan(cells.resolve_columns(headers, ["file_id"], cells.aliases_for("school")))


def test_table_scores_read_gathered_rows_once_written(sheets):
    marked = sheets.where(F.col("row_idx") < 987654)
    scores = grids.table_scores(marked, ["file_id"], "school")
    assert "987654" not in plan(scores)
    assert {r.file_id: r.score for r in scores.collect()} == {1: 302, 2: 302, 3: 1, None: 0}


def test_candidates_of_documents_are_made_in_one_pass_and_stay_by_sheet(spark, folder):
    found = q_cells._candidates(Inputs(spark, folder))
    assert plan(found).count("FileScan parquet [l_orderkey") == 1
    assert plan(cells.gathered_rows(found, ["file_id", "parser", "table_idx"])).count("Exchange hashpartitioning") == 1
    seen = {(r.file_id, r.parser) for r in found.where("row_idx = 1").select("file_id", "parser").collect()}
    assert seen == {(o, p) for o in range(40) for p in ("first", "second", "third") if p != "second" or o % 4}
    assert {r.value for r in found.where("parser = 'first' AND file_id = 3 AND row_idx = 1").collect()} == {"x"}


def test_school_sheets_read_their_lines_once(spark, folder, monkeypatch):
    calls = []
    own = cells.parse_sheets
    monkeypatch.setattr(cells, "parse_sheets", lambda *args, **kwargs: calls.append(args) or own(*args, **kwargs))
    for build in (q_cells.parse_school_sheets, q_cells.parse_major_sheets, q_cells.typed_extracted_rows):
        assert sorted({(r.file_id, r.row_idx) for r in build(Inputs(spark, folder)).collect()}) == [(o, n) for o in range(40) for n in (2, 3, 4)]
    assert all("l_orderkey" not in plan(sheet) and "l_orderkey" not in plan(files) for sheet, _, _, files in calls)
    assert all("Window" not in plan(files) for *_, files in calls)


def longest_code(df):
    """Bytes of the longest method made for a plan; the JVM compiles none of 8,000 or more."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        debug = getattr(getattr(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        text = str(debug.codegenString(df.select("*")._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max([int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)], default=0)


def test_code_of_sheets_is_short_enough_to_be_compiled(spark, folder, monkeypatch):
    sizes = []
    own = cells.written
    monkeypatch.setattr(cells, "written", lambda df: sizes.append(longest_code(df)) or own(df))
    out = q_cells.parse_major_sheets(Inputs(spark, folder))
    assert max([*sizes, longest_code(out)]) < 8000


def test_header_facts_shuffle_one_row_of_cells_a_sheet(spark, folder, monkeypatch):
    frames = []
    own = cells.written
    monkeypatch.setattr(cells, "written", lambda df: frames.append(df) or own(df))
    found = cells.sheet_facts(own(cells.gathered_rows(Inputs(spark, folder).school_cells, ["file_id"])), ["file_id"], "school")
    tops = next(df for df in frames if "sig" in df.columns)
    assert "partial_max_by(cells" in plan(tops) and "row_idx#" not in plan(tops).split("Join")[0]
    assert {(r.header_row, r.raw_rows) for r in found.collect()} == {(1, 6)}


def test_wrong_type_files_are_found_in_one_pass(spark):
    rows = [
        (1, 0, "投档表"), (1, 1, "院校名称"), (1, 2, None), (2, 0, "学校代号"), (2, 1, "x"), (3, 0, "分数"), (3, 1, "y"), (3, 40, "院校代号"),
        (4, 1, "学校代号"), (5, 0, None), (6, 35, "院校代号"), (None, 0, "院校代号"), (7, 0, "学校代号"), (7, 1, "人数"), (8, None, "院校代号"),
    ]
    df = spark.createDataFrame([(f, r, 0, v) for f, r, v in rows], "file_id int, row_idx int, col_idx int, value string").where("row_idx < 987654")
    found = cells.looks_like_school(df, ["file_id"])
    assert plan(found).count("987654") == 1
    # Without header words the header is row 0; a sheet without words and without row 0 is left out, as one that begins too late.
    assert {(r.file_id, r.is_school) for r in found.collect()} == {(1, True), (2, True), (3, False), (5, False), (7, False)}
