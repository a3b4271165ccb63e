"""What must not grow faster than the input: rows held in Python, tables of texts, repeated work, folders per file."""

from pyspark.sql import functions as F

from rankline.operators import announce, cells, grids, load, normalize, stats
from rankline.plans import q_items
from rankline.sources import html


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def spied(monkeypatch, module, name):
    """Calls of a helper, which runs as it is."""
    calls, own = [], getattr(module, name)

    def call(*args, **kwargs):
        calls.append(args)
        return own(*args, **kwargs)

    monkeypatch.setattr(module, name, call)
    return calls


def test_links_come_back_page_by_page(spark):
    rows = [(1, "https://x.example/d/", '<a href="/p.pdf">t</a><img src="i.png">'), (1, "https://x.example/d/", ""), (2, None, "<a href=x>y"), (3, "u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html.links_of_pages(df, "page_id")
    assert "BatchEvalPython" in plan(found) and "MapInPandas" not in plan(found)
    assert found.schema.simpleString() == "struct<page_id:bigint,base_url:string,tag_no:int,tag:string,href:string,text:string>"
    assert sorted(map(tuple, found.collect())) == [(1, "https://x.example/d/", 0, "a", "/p.pdf", "t"), (1, "https://x.example/d/", 1, "img", "i.png", ""), (2, None, 0, "a", "x", "y")]
    assert [(r.title, r.url) for r in announce.attachments(df).orderBy("tag_no").collect()] == [("t", "https://x.example/p.pdf"), ("i.png", "https://x.example/d/i.png")]


def test_table_summary_reads_its_tables_once(spark, monkeypatch):
    calls = spied(monkeypatch, stats, "written")
    one = spark.createDataFrame([(2023, "B"), (2024, "A"), (2024, "A")], "year int, province string")
    two = spark.createDataFrame([(2022, "A"), (2022, None)], "year int, province string")
    got = {r.table_name: (r.row_count, r.years_available, r.provinces_available) for r in stats.table_summary({"one": one, "two": two}).collect()}
    assert len(calls) == 1
    assert got == {"one": (3, "2022,2023,2024", "A,B"), "two": (2, "2022,2023,2024", "A,B")}


def test_names_and_codes_are_no_table_of_texts(spark, monkeypatch):
    calls = spied(monkeypatch, normalize, "by_distinct")
    rows = [(1, "A001北京大学", None, " 500(文化478) ", "12.9"), (2, "（a b）", "7", "-3", None), (3, None, "A002武汉大学", "x", "1"), (4, "1234", "", None, "x")]
    df = spark.createDataFrame(rows, "n int, school_name string, school_code string, min_score string, min_rank string")
    out = normalize.normalize_school(df, year=2024, province="广东", keep=("n",))
    assert not any("school_code" in g.inputs or "school_name" in g.inputs for _, groups in calls for g in groups)
    got = {r.n: (r.school_code, r.school_name, r.min_score, r.min_rank, r.year) for r in out.collect()}
    assert got == {1: ("A001", "北京大学", 500.0, 12, 2024), 2: ("7", "(ab)", 3.0, None, 2024), 3: ("A002", "武汉大学", None, 1, 2024), 4: ("1234", None, None, None, 2024)}


def test_numbers_of_sheets_are_no_table_of_texts(spark, monkeypatch):
    calls = spied(monkeypatch, cells, "by_distinct")
    lines = [["院校代号", "院校名称", "投档最低分", "计划数"], ["A1", "甲 大学", "512(文化478)", "3人"], ["A2", "乙大学", None, "x"]]
    grid = [(1, r, c, v) for r, line in enumerate(lines) for c, v in enumerate(line)]
    files = spark.createDataFrame([(1, "f.xlsx", "S", 2024, "物理")], "file_id int, file_name string, sheet_name string, default_year int, subject_hint string")
    out = cells.parse_sheets(spark.createDataFrame(grid, "file_id int, row_idx int, col_idx int, value string"), ["file_id"], "school", files)
    assert {c for _, groups in calls for g in groups for c in g.inputs} == {"province", "subject_type", "batch"}
    assert sorted((r.row_idx, r.school_code, r.school_name, r.min_score, r.plan_count, r.avg_score) for r in out.collect()) == [(1, "A1", "甲大学", 512.0, 3.0, None), (2, "A2", "乙大学", None, None, None)]


def test_control_tables_read_their_cells_once(spark):
    tables = {
        1: [["公告", None, None], ["科目类别", "录取批次", "控制分数线"], ["不分文理", None, "480分"], [None, "艺术本科", "４５０"], [None, " ", "1"], ["文史", "x", "无"]],
        2: [["科类", "本科 批次", ""], ["历史组", "500", "1.5.2"], [" 科类 ", "1", "2"], ["物理组", "490分", "9"]],
        3: [["a", "b"], ["物理类", "3"]],  # no score column
        4: [["科类", "分数线"]],  # no body
        None: [["科类", "分数线"], ["物理", "5"]],
    }
    grid = [(f, r, c, v) for f, lines in tables.items() for r, line in enumerate(lines) for c, v in enumerate(line)]
    grid += [(2, 3, 1, "490分"), (5, 40, 0, "科类"), (5, 41, 0, "物理"), (1, None, 0, "历史")]  # a repeated cell, a table that begins too late, a cell without row
    df = spark.createDataFrame(grid, "file_id int, row_idx int, col_idx int, value string").where("row_idx < 987654 OR row_idx IS NULL")
    out = grids.control_tables(df, ["file_id"])
    assert "987654" not in plan(out)
    assert sorted(map(tuple, out.collect())) == [
        (1, 2, "综合改革", "普通类本科", 480.0), (1, 3, "综合改革", "本科批", 450.0), (2, 1, "历史类", "本科批", 500.0),
        (2, 3, "物理类", "col_2", 9.0), (2, 3, "物理类", "本科批", 490.0), (2, 3, "物理类", "本科批", 490.0),
    ]


def test_rules_of_a_loaded_row_run_once(spark, monkeypatch):
    calls = spied(monkeypatch, load, "written")
    df = spark.createDataFrame([(1, 2024, "A", "s", "b", "x"), (2, 2024, "A", "s", "b", "5"), (3, 2024, "A", "s", "b", "6")], "n int, year int, province string, subject_type string, batch string, score string")
    log = load.outcomes(df, df.where("false"), "control", ["n"])
    assert len(calls) == 1
    assert {r.n: r.outcome for r in log.collect()} == {1: "failed", 2: "inserted", 3: "skipped"}


def test_page_files_lie_in_a_fixed_number_of_folders(spark, tmp_path):
    rows = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("t"), F.col("id")).alias("value"), F.lit("odd").alias("part"))
    both = rows.unionByName(spark.createDataFrame([(7, "t7", "odd"), (None, None, "odd")], "page_id long, value string, part string"))
    q_items._write_pages(both, f"file:{tmp_path}/files")
    files = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert len(files) == 301 and all(p.suffix == ".txt" for p in files)
    assert len([p for p in tmp_path.rglob("*") if p.is_dir()]) <= q_items._FOLDERS + 2
    texts = {p.stem: p.read_text() for p in files}
    assert texts["page_id=7"] == "t7\nt7\n" and texts["page_id=8"] == "t8\n" and texts["page_id=None"] == "\n"
