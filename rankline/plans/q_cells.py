"""Grid shaping: sheets, page tables and extracted tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import header_text
from ..operators import cells, grids
from ..session import cut_lineage, shared_folder, written
from ..sources import html, pages
from . import sqlbits as q
from .inputs import define
from .registry import query

_K = ["file_id"]


def _sheet(rows, keys, first_row, columns, lines):
    """Cells of typed rows plus fixed rows (row, [values]), which the first row of each file brings along: one explode, no union.

    The cells of a row are made by one function over its values, not by one expression a cell: the code for all cells would be too long to be compiled.
    """
    def line(r, values):
        return F.transform(F.array(*[v.cast("string") for v in values]), lambda v, i: F.struct(r.alias("row_idx"), i.alias("col_idx"), v.alias("value")))

    own = line(F.col("row_idx"), [F.col(c) for c in columns])
    extra = [line(F.lit(r), [F.lit(v) if isinstance(v, str) else v for v in values]) for r, values in lines]
    cells = F.when(F.col("row_idx") == first_row, F.concat(own, *extra)).otherwise(own)
    return rows.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.row_idx", "c.col_idx", "c.value")


# One rank sheet per (year, province): title, note, header, body. Its rows are the distinct scores, so a file is small at any scale.
define("rank_rows", """
SELECT year * 10 + CASE province WHEN 'AFRICA' THEN 0 WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3 ELSE 4 END AS file_id, year, province, subject_type,
  CAST(2 + row_number() OVER (PARTITION BY year, province ORDER BY subject_type, score DESC) AS INT) AS row_idx, subject_type AS c0, CAST(score AS STRING) AS c1,
  CAST(same_score_count AS STRING) || '人' AS c2, CAST(cumulative_count AS STRING) AS c3, score, same_score_count, cumulative_count FROM rank_fx""")


def _cells_fx(t):
    head = [(0, ["逐分段统计表"]), (1, ["注：样例"]), (2, ["科类", "分 数", "人数", "累计人数"])]
    return _sheet(t.rank_rows, _K, 3, ["c0", "c1", "c2", "c3"], head)


define("cells_fx", """
SELECT file_id, row_idx, k AS col_idx, CASE k WHEN 0 THEN c0 WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3 END AS value FROM rank_rows, (VALUES (0), (1), (2), (3)) v(k)
UNION ALL SELECT file_id, r, c, v FROM (SELECT DISTINCT file_id FROM rank_rows), (VALUES (0, 0, '逐分段统计表'), (1, 0, '注：样例'), (2, 0, '科类'), (2, 1, '分 数'), (2, 2, '人数'), (2, 3, '累计人数')) h(r, c, v)""", _cells_fx)

# What the lines below are made of.
_RAW = ("src_order", "src_line", "src_supp", "school_code", "school_name", "major_group", "min_score", "min_rank", "plan_count", "subject_type", "year", "province")
# Lines in one task of the window below; their number sets the number of tasks, so that a task stays as small as it is on little input.
_LINES_A_TASK = 250_000


def _school_lines(t):
    """The lines shuffled once by the file they belong to, before texts are made of them; later groups and joins by file need no other shuffle."""
    raw = t.view("school_raw").select(*_RAW).withColumnRenamed("src_order", "file_id")
    tasks = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // _LINES_A_TASK))
    order = ["src_line", "src_supp", "school_code", "min_score", "min_rank", "plan_count", "subject_type"]
    place = F.row_number().over(Window.partitionBy("file_id").orderBy(*order))
    score = F.col("min_score").cast("int").cast("string")
    even = F.col("src_line") % 2 == 0
    return raw.repartition(tasks, "file_id").withColumn("_place", place).select(
        "file_id", (F.col("_place") + 1).cast("int").alias("row_idx"), F.col("school_code").alias("c0"), F.col("school_name").alias("c1"), F.col("major_group").alias("c2"),
        F.when(even, F.concat(score, F.lit("(文化478)"))).otherwise(score).alias("c3"), F.concat(F.lit("第"), F.col("min_rank").cast("string"), F.lit("名")).alias("c4"),
        F.col("plan_count").cast("string").alias("c5"), F.when(even, "本科批次").otherwise("第二段").alias("c6"), F.col("subject_type").alias("c7"),
        "year", "province", "min_score", "min_rank", "plan_count", "src_line",
    )


# One school sheet per order: its lines, below a title and a header that differs between files, with a note at the end.
define("school_lines", """
SELECT src_order AS file_id, CAST(1 + row_number() OVER (PARTITION BY src_order ORDER BY src_line, src_supp, school_code, min_score NULLS FIRST, min_rank NULLS FIRST, plan_count, subject_type) AS INT) AS row_idx,
  school_code AS c0, school_name AS c1, major_group AS c2, CASE WHEN src_line % 2 = 0 THEN CAST(CAST(min_score AS INT) AS STRING) || '(文化478)' ELSE CAST(CAST(min_score AS INT) AS STRING) END AS c3,
  '第' || CAST(min_rank AS STRING) || '名' AS c4, CAST(plan_count AS STRING) AS c5, CASE WHEN src_line % 2 = 0 THEN '本科批次' ELSE '第二段' END AS c6, subject_type AS c7,
  year, province, min_score, min_rank, plan_count, src_line FROM school_raw""", _school_lines)


def _heads():
    even = F.col("file_id") % 2 == 0
    exact = F.col("file_id") % 7 == 0  # a column of its own for the major, so that the group column is free
    title = F.when(F.col("file_id") % 3 == 0, "普通类（历史类）投档").when(F.col("file_id") % 3 == 1, "首选物理投档").otherwise("投档表")
    return [(0, [title]), (1, [
        F.when(even, "院校代号").otherwise("院校 代码"), F.when(F.col("file_id") % 5 == 0, "考试院校全称").otherwise("院校名称"), F.when(exact, "专业组").otherwise("专业组代码"),
        F.when(even, "投档最低分").otherwise("投档线（分）"), F.lit("投档最低位次"), F.when(exact, "专业名称").otherwise("计划数"), F.when(even, "批次").otherwise("附注"), F.lit("科类"),
    ])]


def _school_cells(t):
    return _sheet(t.school_lines, _K, 2, [f"c{i}" for i in range(8)], [*_heads(), (900, ["备注：仅供参考"])])


define("school_cells", """
SELECT file_id, row_idx, k AS col_idx, [c0, c1, c2, c3, c4, c5, c6, c7][k + 1] AS value FROM school_lines, range(8) v(k)
UNION ALL SELECT file_id, 0, 0, CASE file_id % 3 WHEN 0 THEN '普通类（历史类）投档' WHEN 1 THEN '首选物理投档' ELSE '投档表' END FROM (SELECT DISTINCT file_id FROM school_lines)
UNION ALL SELECT file_id, 1, k, [CASE WHEN file_id % 2 = 0 THEN '院校代号' ELSE '院校 代码' END, CASE WHEN file_id % 5 = 0 THEN '考试院校全称' ELSE '院校名称' END, CASE WHEN file_id % 7 = 0 THEN '专业组' ELSE '专业组代码' END,
  CASE WHEN file_id % 2 = 0 THEN '投档最低分' ELSE '投档线（分）' END, '投档最低位次', CASE WHEN file_id % 7 = 0 THEN '专业名称' ELSE '计划数' END, CASE WHEN file_id % 2 = 0 THEN '批次' ELSE '附注' END, '科类'][k + 1]
  FROM (SELECT DISTINCT file_id FROM school_lines), range(8) v(k)
UNION ALL SELECT file_id, 900, 0, '备注：仅供参考' FROM (SELECT DISTINCT file_id FROM school_lines)""", _school_cells)

_WORDS = ", ".join(q.lit(w) for w in cells.HEADER_WORDS)
_HEADER = """
texts AS (SELECT file_id, row_idx, string_agg(value, ' ' ORDER BY col_idx) AS line FROM {t} WHERE row_idx < 30 GROUP BY 1, 2),
hits AS (SELECT file_id, row_idx, len(list_filter([{w}], lambda w: contains(coalesce(line, ''), w))) AS h FROM texts),
hdr AS (SELECT file_id, CAST(arg_min(row_idx, (-h, row_idx)) AS INT) AS header_row, CAST(max(h) AS INT) AS header_hits FROM hits GROUP BY 1)"""


@query("B1_header_rows", "WITH " + _HEADER.format(t="school_cells", w=_WORDS) + " SELECT * FROM hdr")
def header_rows(t):
    return cells.header_rows(t.school_cells, _K)


@query("A2_cells_of_sheets", """
SELECT file_id, count(*) AS cells, CAST(max(row_idx) + 1 AS INT) AS row_count, CAST(max(col_idx) + 1 AS INT) AS column_count FROM school_cells GROUP BY file_id""")
def cells_of_sheets(t):
    return t.school_cells.groupBy(*_K).agg(
        F.count("*").alias("cells"), (F.max("row_idx") + 1).cast("int").alias("row_count"), (F.max("col_idx") + 1).cast("int").alias("column_count")
    )


_CLEAN = "regexp_replace(replace(replace(value, '（', '('), '）', ')'), '\\s+', '', 'g')"


@query("B2_header_text", f"SELECT file_id, CAST(col_idx AS INT) AS col_idx, {_CLEAN} AS header FROM school_cells WHERE row_idx = 1")
def header_texts(t):
    return t.school_cells.where("row_idx = 1").select("file_id", "col_idx", header_text(F.col("value")).alias("header"))


def _alias_values(record_type):
    """General then own aliases as rows; repeats are removed in SQL by their first position."""
    rows, n = [], 0
    for c, (name, words) in enumerate(cells.ALIASES.items()):
        for word in (*words, *cells.TYPE_ALIASES.get(record_type, {}).get(name, ())):
            rows.append(f"({c}, {q.lit(name)}, {n}, {q.lit(word)})")
            n += 1
    values = ", ".join(rows)
    return f"""al AS (SELECT canonical_no, canonical, alias, row_number() OVER (PARTITION BY canonical ORDER BY min(n)) - 1 AS alias_no
      FROM (VALUES {values}) v(canonical_no, canonical, n, alias) GROUP BY 1, 2, 3)"""


_FITS = """
fits AS (SELECT h.file_id, h.col_idx, h.header, a.canonical, a.canonical_no, min((CASE WHEN lower(h.header) = a.alias THEN 1 ELSE 2 END, a.alias_no)) AS fit
  FROM heads h JOIN al a ON contains(lower(h.header), a.alias) GROUP BY ALL),
res AS (SELECT file_id, canonical, canonical_no, arg_min(col_idx, (fit, CASE WHEN fit[1] = 1 THEN -col_idx ELSE col_idx END)) AS col_idx,
   arg_min(header, (fit, CASE WHEN fit[1] = 1 THEN -col_idx ELSE col_idx END)) AS header FROM fits GROUP BY ALL),
used AS (SELECT file_id, header, arg_min(canonical, canonical_no) AS canonical, min(col_idx) AS col_idx FROM res GROUP BY 1, 2)"""
_HEADS = f"""heads AS (SELECT file_id, col_idx, {_CLEAN} AS header FROM school_cells WHERE row_idx = 1
  AND (file_id, col_idx) IN (SELECT (file_id, col_idx) FROM school_cells WHERE row_idx > 1 AND value IS NOT NULL))"""


@query("B3_alias_candidates", f"WITH {_HEADS}, {_alias_values('school')}, {_FITS} SELECT file_id, CAST(col_idx AS INT) AS col_idx, canonical, CAST(fit[1] AS INT) AS pass, CAST(fit[2] AS INT) AS alias_no FROM fits")
def alias_candidates(t):
    headers, _ = cells.split_header(t.school_cells, _K)
    return cells.column_candidates(headers, _K, cells.aliases_for("school")).select("file_id", "col_idx", "canonical", "pass", "alias_no")


@query("B4_resolved_columns", f"WITH {_HEADS}, {_alias_values('school')}, {_FITS} SELECT file_id, canonical, CAST(col_idx AS INT) AS col_idx, header FROM res")
def resolved_columns(t):
    headers, _ = cells.split_header(t.school_cells, _K)
    return cells.resolve_columns(headers, _K, cells.aliases_for("school")).select("file_id", "canonical", "col_idx", "header")


@query("B5_renamed_columns", f"WITH {_HEADS}, {_alias_values('school')}, {_FITS} SELECT file_id, canonical, CAST(col_idx AS INT) AS col_idx, header FROM used")
def renamed_columns(t):
    headers, _ = cells.split_header(t.school_cells, _K)
    return cells.used_columns(cells.resolve_columns(headers, _K, cells.aliases_for("school")), _K)


@query("B6_cells_with_values", "SELECT file_id, count(*) AS n, count(DISTINCT col_idx) AS columns FROM school_cells WHERE value IS NOT NULL GROUP BY 1")
def cells_with_values(t):
    return cells.drop_empty(t.school_cells).groupBy(*_K).agg(F.count("*").alias("n"), F.count_distinct("col_idx").alias("columns"))


@query("B7_note_rows", """
SELECT file_id, CAST(row_idx AS INT) AS row_idx FROM (SELECT file_id, row_idx, string_agg(value, ' ') AS line FROM cells_fx GROUP BY 1, 2)
WHERE regexp_matches(line, '说明|备注|注：|注:|合计|总计|单位：|单位:') OR trim(coalesce(line, '')) = ''
UNION ALL SELECT file_id, CAST(900 AS INT) FROM (SELECT DISTINCT file_id FROM school_lines)""")
def note_rows(t):
    both = t.cells_fx.withColumn("file_id", F.col("file_id").cast("bigint")).unionByName(t.school_cells)
    return cells.note_rows(both, _K).select("file_id", F.col("row_idx").cast("int").alias("row_idx"))


def _file_ids(t):
    """The files of ``school_lines``; their lines need not be put in order for that."""
    return t.sql("SELECT DISTINCT src_order AS file_id FROM school_raw")


def _school_files(t):
    return _file_ids(t).select(
        "file_id", F.concat(F.lit("f"), F.col("file_id").cast("string"), F.lit(".xlsx")).alias("file_name"), F.lit("Sheet1").alias("sheet_name"),
        F.lit(2024).alias("default_year"), F.lit(None).cast("string").alias("subject_hint"),
    )


@query("B8_parse_school_sheets", f"""
WITH md AS (SELECT file_id, arg_min(c7, (-n, c7)) AS mode FROM (SELECT file_id, c7, count(*) AS n FROM school_lines GROUP BY 1, 2) GROUP BY 1)
SELECT s.file_id, row_idx, '2024' AS year, '江苏' AS province, c0 AS school_code, CASE WHEN file_id % 5 = 0 THEN c0 ELSE {q.squeeze('c1')} END AS school_name,
  CASE WHEN file_id % 7 = 0 THEN c5 ELSE c2 END AS major_name, CASE WHEN file_id % 7 = 0 THEN c2 END AS major_group,
  CAST(CAST(min_score AS INT) AS DOUBLE) AS min_score, CAST(min_rank AS DOUBLE) AS min_rank, CASE WHEN file_id % 7 <> 0 THEN CAST(plan_count AS DOUBLE) END AS plan_count,
  CASE file_id % 3 WHEN 0 THEN '历史类' WHEN 1 THEN '物理类' ELSE mode END AS subject_type,
  CASE WHEN file_id % 2 = 0 THEN CASE c6 WHEN '本科批次' THEN '本科批' ELSE '专科批' END ELSE '本科批' END AS batch, 'f' || s.file_id || '.xlsx' AS source_file FROM school_lines s JOIN md USING (file_id)""")
def parse_school_sheets(t):
    t = t.kept("school_raw", *_RAW)
    rows = cells.parse_sheets(t.school_cells, _K, "school", _school_files(t))
    return rows.select(
        "file_id", "row_idx", "year", "province", "school_code", "school_name", "major_name", "major_group", "min_score", "min_rank", "plan_count", "subject_type", "batch",
        "source_file",
    )


@query("B8_parse_major_sheets", f"""
SELECT file_id, row_idx, '2024' AS year, '江苏' AS province, c0 AS school_code, {q.squeeze('c1')} AS school_name, c6 AS major_name, c0 AS major_code, c2 AS major_group,
  CAST(CAST(min_score AS INT) AS DOUBLE) AS min_score, CAST(min_rank AS DOUBLE) AS min_rank, '本科批' AS batch FROM school_lines""")
def parse_major_sheets(t):
    t = t.kept("school_raw", *_RAW)
    head = ["院校代号", "院校名称", "专业名称", "专业代号", "专业组", "最低分", "位次"]
    sheet = _sheet(t.school_lines, _K, 2, ["c0", "c1", "c6", "c0", "c2", "c3", "c4"], [(0, ["录取情况"]), (1, head)])
    rows = cells.parse_sheets(sheet, _K, "major", _school_files(t))
    return rows.select("file_id", "row_idx", "year", "province", "school_code", "school_name", "major_name", "major_code", "major_group", "min_score", "min_rank", "batch")


# One sheet of control lines per (year, province).
define("control_lines", """
SELECT year, province, year || '/' || province AS file_id, CAST(1 + row_number() OVER (PARTITION BY year, province ORDER BY subject_type, batch) AS INT) AS row_idx,
  subject_type, batch, CAST(CAST(score AS INT) AS STRING) || '分' AS c2, score FROM control_fx""")


@query("B8_parse_control_sheets", """
WITH md AS (SELECT file_id, arg_min(subject_type, (-n, subject_type)) AS mode FROM (SELECT file_id, subject_type, count(*) AS n FROM control_lines GROUP BY 1, 2) GROUP BY 1)
SELECT file_id, row_idx, CAST(year AS VARCHAR) AS year, mode AS subject_type, batch, score FROM control_lines JOIN md USING (file_id)""")
def parse_control_sheets(t):
    lines = t.control_lines
    sheet = _sheet(lines, _K, 2, ["subject_type", "batch", "c2"], [(0, ["录取线"]), (1, ["科类", "批次", "分数"])])
    files = lines.where("row_idx = 2").select(
        "file_id", F.lit("c.xlsx").alias("file_name"), F.lit("Sheet1").alias("sheet_name"), F.col("year").alias("default_year"), F.lit(None).cast("string").alias("subject_hint")
    )
    return cells.parse_sheets(sheet, _K, "control", files).select("file_id", "row_idx", "year", "subject_type", "batch", "score")


def _rank_files(t):
    return t.rank_rows.where("row_idx = 3").select(
        "file_id", F.concat(F.lit("r"), F.col("file_id").cast("string"), F.lit(".xlsx")).alias("file_name"), F.lit("Sheet1").alias("sheet_name"),
        F.col("year").alias("default_year"), F.lit(None).cast("string").alias("subject_hint"),
    )


@query("B8_parse_rank_sheets", """
WITH md AS (SELECT file_id, arg_min(subject_type, (-n, subject_type)) AS mode FROM (SELECT file_id, subject_type, count(*) AS n FROM rank_rows GROUP BY 1, 2) GROUP BY 1)
SELECT file_id, row_idx, CAST(year AS VARCHAR) AS year, mode AS subject_type,
  CAST(score AS DOUBLE) AS score, CAST(same_score_count AS DOUBLE) AS same_score_count, CAST(cumulative_count AS DOUBLE) AS cumulative_count FROM rank_rows r JOIN md USING (file_id)""")
def parse_rank_sheets(t):
    rows = cells.parse_sheets(t.cells_fx, _K, "rank", _rank_files(t))
    return rows.select("file_id", "row_idx", "year", "subject_type", "score", "same_score_count", "cumulative_count")


# Two sheets per file, named after the subject; the sheet names the subject of its rows.
define("two_sheets", "SELECT file_id, subject_type || '一分一段' AS sheet, year, row_idx, min(row_idx) OVER (PARTITION BY file_id, subject_type) AS first_row, c1, c2, c3, subject_type, score, cumulative_count FROM rank_rows")


@query("A15_parse_all_sheets", """
SELECT file_id, sheet AS source_sheet, row_idx, subject_type, CAST(score AS DOUBLE) AS score, CAST(cumulative_count AS DOUBLE) AS cumulative_count FROM two_sheets""")
def parse_all_sheets(t):
    keys = ["file_id", "sheet"]
    rows = t.two_sheets
    long = _sheet(rows, keys, F.col("first_row"), ["c1", "c2", "c3"], [(2, ["分数", "人数", "累计人数"])])
    files = rows.where("row_idx = first_row").select(
        *keys, F.lit("表.xlsx").alias("file_name"), F.col("sheet").alias("sheet_name"), F.col("year").alias("default_year"), F.lit(None).cast("string").alias("subject_hint")
    )
    out = cells.parse_sheets(long, keys, "rank", files, prefer_sheet=True)
    return out.select("file_id", "source_sheet", "row_idx", "subject_type", "score", "cumulative_count")


def _blank_header(t):
    """School cells in which some header cells are blank."""
    cell = (F.col("row_idx") == 1) & (F.col("col_idx") == 5)
    return t.school_cells.withColumn("value", F.when(cell, " ").otherwise(F.col("value")))


@query("B10_detected_header", f"""
SELECT file_id, CAST(col_idx AS INT) AS col_idx, CASE WHEN col_idx = 5 THEN 'col_5' ELSE {_CLEAN} END AS header FROM school_cells WHERE row_idx = 1""")
def detected_header(t):
    headers, _ = grids.detected_header(_blank_header(t), _K)
    return headers.select("file_id", "col_idx", "header")


@query("B9_typed_extracted_rows", f"""
SELECT file_id, row_idx, c0 AS school_code, CASE WHEN file_id % 5 = 0 THEN c0 ELSE {q.squeeze('c1')} END AS school_name, CAST(CAST(min_score AS INT) AS DOUBLE) AS min_score, CAST(NULL AS DOUBLE) AS plan_count FROM school_lines""")
def typed_extracted_rows(t):
    t = t.kept("school_raw", *_RAW)
    rows = cells.parse_sheets(_blank_header(t), _K, "school", _school_files(t))
    return rows.select("file_id", "row_idx", "school_code", "school_name", "min_score", "plan_count")


# ---- page tables ----

# Pages with a two-subject table each: one page per (year, province, band of 25 scores), so a page is small at any scale.
_SIDES = """
SELECT year, province, CAST(floor(score / 25) AS INT) AS band, score, max(CASE WHEN subject_type = '历史类' THEN same_score_count END) AS hn, max(CASE WHEN subject_type = '历史类' THEN cumulative_count END) AS hc,
  max(CASE WHEN subject_type = '物理类' THEN same_score_count END) AS pn, max(CASE WHEN subject_type = '物理类' THEN cumulative_count END) AS pc FROM rank_fx GROUP BY 1, 2, 3, 4"""
define("rank_sides", _SIDES)
_PAGE = "CAST(year AS STRING) || '/' || province || '/' || CAST(band AS STRING)"


def _td(*columns):
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(c.cast("string"), F.lit("")), F.lit("</td>")) for c in columns], F.lit("</tr>"))


def _rank_pages(t):
    """Pages with the table of a band, after the page of the given table whose number it is (those hold no table)."""
    s = t.rank_sides
    hist = F.when(F.col("hn").isNotNull(), F.col("score"))
    phys = F.when(F.col("pn").isNotNull(), F.col("score"))
    row = _td(hist, F.col("hn"), F.col("hc"), phys, F.col("pn"), F.col("pc"))
    head = "<table><tr><th colspan='3'>历史等科目类</th><th colspan=\"3\">物理等科目类</th></tr><tr><th>分数</th><th>人数</th><th>累计人数</th><th>分数</th><th>人数</th><th>累计人数</th></tr>"
    rows = F.array_join(F.transform(F.reverse(F.array_sort(F.collect_list(F.struct("score", row.alias("tr"))))), lambda x: x["tr"]), "")
    pages = s.groupBy("year", "province", "band").agg(rows.alias("rows"))
    html_text = F.concat(F.lit("<html><body><p>说明</p>"), F.lit(head), F.col("rows"), F.lit("</table></body></html>"))
    own = pages.select(F.concat_ws("/", F.col("year").cast("string"), "province", F.col("band").cast("string")).alias("page"), html_text.alias("html"))
    return own.unionByName(t.pages.select(F.concat(F.lit("given/"), F.col("page_id").cast("string")).alias("page"), "html"))


_T = ["page", "table_idx"]


@query("A3_cells_of_pages", f"""
WITH r AS (SELECT {_PAGE} AS page, *, row_number() OVER (PARTITION BY year, province, band ORDER BY score DESC) + 1 AS row_idx FROM rank_sides),
f AS (SELECT page, row_idx, k, [CASE WHEN hn IS NOT NULL THEN score END, hn, hc, CASE WHEN pn IS NOT NULL THEN score END, pn, pc][k + 1] AS v FROM r, range(6) x(k)),
h AS (SELECT page, i AS row_idx, k, CASE WHEN i = 0 THEN CASE WHEN k < 3 THEN '历史等科目类' ELSE '物理等科目类' END ELSE ['分数', '人数', '累计人数'][k % 3 + 1] END AS v FROM (SELECT DISTINCT page FROM r), range(2) a(i), range(6) b(k))
SELECT page, CAST(0 AS INT) AS table_idx, CAST(row_idx AS INT) AS row_idx, CAST(k AS INT) AS col_idx, CAST(v AS VARCHAR) AS value FROM f UNION ALL SELECT page, 0, CAST(row_idx AS INT), CAST(k AS INT), v FROM h""")
def cells_of_pages(t):
    return html.cells_of_pages(_rank_pages(t), "page")


@query("A3_cells_of_files", f"""
WITH r AS (SELECT {_PAGE} AS page, *, row_number() OVER (PARTITION BY year, province, band ORDER BY score DESC) + 1 AS row_idx FROM rank_sides),
f AS (SELECT page, row_idx, k, [CASE WHEN hn IS NOT NULL THEN score END, hn, hc, CASE WHEN pn IS NOT NULL THEN score END, pn, pc][k + 1] AS v FROM r, range(6) x(k)),
h AS (SELECT page, i AS row_idx, k, CASE WHEN i = 0 THEN CASE WHEN k < 3 THEN '历史等科目类' ELSE '物理等科目类' END ELSE ['分数', '人数', '累计人数'][k % 3 + 1] END AS v FROM (SELECT DISTINCT page FROM r), range(2) a(i), range(6) b(k))
SELECT page, CAST(0 AS INT) AS table_idx, CAST(row_idx AS INT) AS row_idx, CAST(k AS INT) AS col_idx, CAST(v AS VARCHAR) AS value FROM f UNION ALL SELECT page, 0, CAST(row_idx AS INT), CAST(k AS INT), v FROM h""")
def cells_of_files(t):
    """Page files through the source that parses each page once, cells and links together."""
    folder = shared_folder(t.spark) + "/pages"
    _rank_pages(t).withColumn("url", F.lit("https://pages.example/")).write.parquet(folder)
    return pages.cells_in(pages.read_pages(t.spark, folder, "both", key="page", key_type="string"))


@query("B11_rank_header", f"""
SELECT page, CAST(k AS INT) AS col_idx, CASE WHEN k < 3 THEN '历史等科目类_' ELSE '物理等科目类_' END || ['分数', '人数', '累计人数'][k % 3 + 1] AS header FROM (SELECT DISTINCT {_PAGE} AS page FROM rank_sides), range(6) b(k)""")
def rank_header(t):
    headers, _ = grids.rank_header(cut_lineage(html.cells_of_pages(_rank_pages(t), "page")), _T)
    return headers.select("page", "col_idx", "header")


@query("B16_rank_tables_two_subjects", f"""
SELECT CAST(year AS VARCHAR) || '/' || province || '/' || CAST(floor(score / 25) AS INT) AS page, subject_type, score, same_score_count, cumulative_count FROM rank_fx""")
def rank_tables_two_subjects(t):
    rows = grids.rank_tables(cut_lineage(html.cells_of_pages(_rank_pages(t), "page")), _T)
    return rows.select("page", "subject_type", "score", "same_score_count", "cumulative_count")


# Long rank tables: some scores are out of range, some counts missing; odd years have no subject column.
define("rank_long", """
SELECT CAST(year * 10 + length(province) AS BIGINT) AS file_id, 0 AS table_idx, year, CAST(row_number() OVER (PARTITION BY year * 10 + length(province) ORDER BY province, subject_type, score DESC) AS INT) AS row_idx,
  CASE WHEN year % 2 = 0 THEN subject_type END AS c0, CASE WHEN score % 29 = 0 THEN CAST(score * 10 AS STRING) WHEN score % 31 = 0 THEN '以下' ELSE CAST(score AS STRING) || '分' END AS c1,
  CASE WHEN score % 7 < 2 THEN NULL ELSE CAST(same_score_count AS STRING) END AS c2, CASE WHEN score % 7 < 1 THEN '-' ELSE CAST(cumulative_count AS STRING) END AS c3,
  subject_type, score, same_score_count, cumulative_count FROM rank_fx""")


def _rank_long(t):
    subject = F.when(F.col("year") % 2 == 0, "科类")
    head = [(0, [subject, "分数", "人数", "累计人数"])]
    return _sheet(t.rank_long, ["file_id", "table_idx"], 1, ["c0", "c1", "c2", "c3"], head).where("NOT (value IS NULL AND row_idx = 0)")


_LONG_ROWS = """
SELECT file_id, row_idx, CASE WHEN year % 2 = 0 THEN subject_type ELSE '物理类' END AS subject_type, CAST(s AS INT) AS score, CAST(n AS INT) AS same_score_count, CAST(c AS INT) AS cumulative_count FROM (
  SELECT *, CASE WHEN score % 29 = 0 THEN score * 10 WHEN score % 31 = 0 THEN NULL ELSE score END AS s, CASE WHEN score % 7 < 2 THEN NULL ELSE same_score_count END AS n, CASE WHEN score % 7 < 1 THEN NULL ELSE cumulative_count END AS c FROM rank_long) x
WHERE s BETWEEN 0 AND 900 AND (n IS NOT NULL OR c IS NOT NULL)"""


@query("B15_rank_rows", _LONG_ROWS)
def rank_rows(t):
    return grids.rank_tables(_rank_long(t), ["file_id", "table_idx"], hint="理科").drop("table_idx")


@query("B19_finalized_rank_rows", f"""
SELECT file_id, row_idx, CASE WHEN has_any THEN y ELSE 2024 END AS year, '江苏' AS province, subject_type, source_file FROM (
  SELECT r.*, CAST(CASE WHEN row_idx % 2 = 0 THEN file_id // 10 END AS INT) AS y, file_id % 2 = 0 AS has_any, 'page.html' AS source_file FROM ({_LONG_ROWS}) r) z""".replace(
    "CASE WHEN has_any THEN y ELSE 2024 END", "CAST(CASE WHEN has_any THEN y ELSE 2024 END AS INT)"))
def finalized_rank_rows(t):
    rows = grids.rank_tables(_rank_long(t), ["file_id", "table_idx"], hint="理科")
    year = F.when((F.col("file_id") % 2 == 0) & (F.col("row_idx") % 2 == 0), F.floor(F.col("file_id") / 10).cast("int"))
    out = grids.finalize(rows.withColumn("year", year), ["file_id"], F.lit(2024), F.lit("江苏省"), "物理", F.lit("page.html"), control=False)
    return out.select("file_id", "row_idx", "year", "province", "subject_type", "source_file")


# Control grids: a subject by batch matrix per (year, province), and long tables with gaps.
define("control_grid", """
SELECT year, province, subject_type || '组' AS c0, CAST(CAST(max(CASE WHEN batch = '本科批' THEN score END) AS INT) AS STRING) AS c1, CAST(CAST(max(CASE WHEN batch = '专科批' THEN score END) AS INT) AS STRING) || '分' AS c2,
  CAST(CAST(max(CASE WHEN batch = '提前批' THEN score END) AS INT) AS STRING) AS c3, CASE WHEN subject_type = '历史类' THEN 1 ELSE 2 END AS row_idx FROM control_fx GROUP BY year, province, subject_type""")


def _matrix_cells(t):
    head = [(0, ["科类", "本科 批次控制分数线", "高职专科", "提前批次"])]
    return _sheet(t.control_grid, ["year", "province"], 1, ["c0", "c1", "c2", "c3"], head)


_MATRIX = "SELECT year, province, subject_type, batch, score FROM control_fx"


@query("B13_control_matrix", _MATRIX)
def control_matrix(t):
    return grids.control_tables(_matrix_cells(t), ["year", "province"]).drop("row_idx")


define("control_long", """
SELECT o_orderkey AS file_id, 1 AS row_idx, CASE o_custkey % 3 WHEN 0 THEN '物理类' WHEN 1 THEN NULL ELSE '不分文理' END AS c0, CASE o_orderkey % 5 WHEN 0 THEN '本科一批' WHEN 1 THEN '艺术本科' WHEN 2 THEN ' ' WHEN 3 THEN NULL ELSE '特殊批' END AS c1,
  CASE o_orderkey % 7 WHEN 0 THEN '无' ELSE CAST(CAST(floor(o_totalprice / 1000) AS INT) AS STRING) || '分' END AS c2, o_custkey, o_totalprice FROM {orders}""")


def _control_long_cells(t):
    return _sheet(t.control_long, _K, 1, ["c0", "c1", "c2"], [(0, ["科目类别", "录取批次", "控制分数线"])])


@query("B14_control_long_tables", """
SELECT file_id, coalesce(CASE c0 WHEN '物理类' THEN '物理类' WHEN '不分文理' THEN '综合改革' END, '综合改革') AS subject_type,
  coalesce(CASE c1 WHEN '本科一批' THEN '本科批' WHEN '艺术本科' THEN '本科批' WHEN '特殊批' THEN '特殊批' END, '普通类本科') AS batch, TRY_CAST(replace(c2, '分', '') AS DOUBLE) AS score
FROM control_long WHERE c2 <> '无' AND (c0 IS NOT NULL OR trim(c1) <> '')""")
def control_long_tables(t):
    return grids.control_tables(_control_long_cells(t), _K).drop("row_idx")


@query("B12_matrix_tables", """
SELECT CAST(year * 10 + length(province) AS BIGINT) AS file_id, province, true AS is_matrix FROM control_fx GROUP BY 1, 2 UNION ALL SELECT file_id, NULL, false FROM control_long""")
def matrix_tables(t):
    keys = ["file_id", "province"]
    a = _matrix_cells(t).withColumn("file_id", (F.col("year") * 10 + F.length("province")).cast("bigint")).drop("year")
    b = _control_long_cells(t).withColumn("province", F.lit(None).cast("string"))
    out_a = grids.matrix_tables(a.where("row_idx > 0"), keys)
    return out_a.unionByName(grids.matrix_tables(b.where("row_idx > 0"), keys))


@query("B17_resolved_subjects", """
SELECT file_id, CASE file_id % 3 WHEN 0 THEN '历史类' WHEN 1 THEN '物理类' END AS from_header, CASE WHEN file_id % 7 = 0 THEN '综合改革' WHEN file_id % 5 = 0 THEN '历史类' WHEN file_id % 3 = 0 THEN '历史类'
  WHEN file_id % 3 = 1 THEN '物理类' END AS by_hint, CASE file_id % 3 WHEN 0 THEN '历史类' WHEN 1 THEN '物理类' ELSE CASE WHEN file_id % 5 = 0 THEN '历史类' WHEN file_id % 7 = 0 THEN '综合改革' END END AS by_sheet
FROM (SELECT DISTINCT file_id FROM school_lines)""")
def resolved_subjects(t):
    heads = cells.sheet_facts(written(cells.gathered_rows(t.school_cells, _K)), _K, "school")
    hint = F.when(F.col("file_id") % 7 == 0, "不分文理")
    name = F.when(F.col("file_id") % 5 == 0, "文科表").otherwise("f")
    none = F.lit(None).cast("string")
    args = (hint, name, none, F.col("history"), F.col("physics"), none)
    only_head = cells.resolved_subject(none, none, none, F.col("history"), F.col("physics"), none, prefer_sheet=False)
    return heads.select(
        "file_id", only_head.alias("from_header"), cells.resolved_subject(*args, prefer_sheet=False).alias("by_hint"),
        cells.resolved_subject(*args, prefer_sheet=True).alias("by_sheet"),
    )


@query("B18_most_frequent_subject", """
SELECT file_id, arg_min(c7, (-n, c7)) AS mode FROM (SELECT file_id, c7, count(*) AS n FROM school_lines GROUP BY 1, 2) GROUP BY 1""")
def most_frequent_subject(t):
    return cells.most_frequent(t.school_lines, _K, "c7")


# ---- candidate tables of documents ----

# Three parsers see each order's table: the second drops the header words of every third file, the third sees one row only.
def _candidates(t):
    file, row, value = F.col("file_id"), F.col("row_idx"), F.col("value")
    # Every cell is made once and handed to the parsers that see it, so that cells stay where they lie, by sheet.
    seen = [
        ("second", F.when((file % 4 != 0) & (row < 900), value)), ("first", F.when((file % 3 == 0) & (row == 1), F.lit("x")).otherwise(value)),
        ("third", F.when(row == 1, value)),
    ]
    parts = F.array(*[F.struct(v.alias("value"), F.lit(p).alias("parser")) for p, v in seen])
    return t.school_cells.select("file_id", "row_idx", "col_idx", F.inline(parts)).withColumn("table_idx", F.lit(0)).where("value IS NOT NULL")


_CAND = """
n AS (SELECT file_id, count(*) AS n FROM school_lines GROUP BY 1),
sc AS (SELECT file_id, 'first' AS parser, CASE WHEN file_id % 3 = 0 THEN n + 1 ELSE n + 300 + CASE WHEN file_id % 5 = 0 THEN 5 ELSE 0 END END AS score FROM n
  UNION ALL SELECT file_id, 'second', n + 300 + CASE WHEN file_id % 5 = 0 THEN 5 ELSE 0 END FROM n WHERE file_id % 4 <> 0)"""


# Rows up to 500, the bonuses of the type, and five for every header word that no name took ('院校' in '考试院校全称').
# A table without header words takes its title as header, so its second row counts too. The note at the end is no row.
@query("B20_table_scores", "WITH " + _CAND + """
SELECT file_id, parser, 0 AS table_idx, CAST(score AS INT) AS score FROM sc""")
def table_scores(t):
    return grids.table_scores(_candidates(t.kept("school_raw", *_RAW)), ["file_id", "parser", "table_idx"], "school")


@query("B20_control_table_scores", """
SELECT file_id, CAST(count(*) + 200 AS INT) AS score FROM control_lines GROUP BY 1""")
def control_table_scores(t):
    sheet = _sheet(t.control_lines, _K, 2, ["subject_type", "batch", "c2"], [(0, ["录取线"]), (1, ["科类", "批次", "分数"])])
    return grids.table_scores(sheet, _K, "control")


@query("B20_rank_table_scores", """
SELECT file_id, CAST(least(count(*), 500) + 200 AS INT) AS score FROM rank_rows GROUP BY 1""")
def rank_table_scores(t):
    return grids.table_scores(t.cells_fx, _K, "rank")


@query("B21_best_tables", "WITH " + _CAND + """
SELECT file_id, CASE WHEN file_id % 11 = 0 THEN 'no_extractable_text' WHEN file_id % 3 = 0 AND file_id % 4 = 0 THEN 'unsupported_pdf_table' ELSE 'parsed' END AS status,
 CASE WHEN file_id % 11 = 0 OR (file_id % 3 = 0 AND file_id % 4 = 0) THEN NULL WHEN file_id % 3 = 0 THEN 'second' ELSE 'first' END AS parser FROM n""")
def best_tables(t):
    t = t.kept("school_raw", *_RAW)
    scores = grids.table_scores(_candidates(t), ["file_id", "parser", "table_idx"], "school")
    files = _file_ids(t).withColumn("has_text", F.col("file_id") % 11 != 0)
    return grids.best_tables(files, scores, ("first", "second", "third")).select("file_id", "status", "parser")


# Every third file has blank pages first; its text starts on the sixth page, beyond those that count.
define("page_text", "SELECT doc_id % 97 AS file_id, CAST(floor(doc_id / 97.0) AS BIGINT) % 9 AS page_no, CASE WHEN (doc_id % 97) % 3 = 0 AND CAST(floor(doc_id / 97.0) AS BIGINT) % 9 < 5 THEN '  ' ELSE text END AS text FROM {documents}")


@query("B22_text_layer", "SELECT file_id, coalesce(sum(length(trim(text, E' \\n\\t\\r'))) FILTER (page_no < 5), 0) >= 30 AS has_text FROM page_text GROUP BY 1")
def text_layer(t):
    return grids.has_text_layer(t.page_text, "file_id")


@query("B23_sheet_profile", "WITH " + _HEADER.format(t="school_cells", w=_WORDS) + """,
f AS (SELECT file_id, col_idx, count(value) AS non_null FROM school_cells GROUP BY 1, 2), p AS (SELECT file_id, count(*) FILTER (row_idx < 20 AND col_idx < 15) AS preview_cells, CAST(max(row_idx) + 1 AS INT) AS row_count FROM school_cells GROUP BY 1)
SELECT f.file_id, CAST(f.col_idx AS INT) AS col_idx, f.non_null, p.row_count, p.preview_cells, hdr.header_row FROM f JOIN p USING (file_id) JOIN hdr USING (file_id)""")
def sheet_profile(t):
    shape, filled, preview = cells.sheet_profile(t.school_cells, _K)
    counts = preview.groupBy(*_K).agg(F.count("*").alias("preview_cells"))
    return filled.join(shape, "file_id").join(counts, "file_id").select("file_id", "col_idx", "non_null", "row_count", "preview_cells", "header_row")


@query("B24_wrong_type_files", """
SELECT file_id, true AS is_school FROM (SELECT DISTINCT file_id FROM school_lines) UNION ALL SELECT CAST(file_id AS BIGINT), false FROM (SELECT DISTINCT file_id FROM rank_rows)""")
def wrong_type_files(t):
    t = t.kept("school_raw", *_RAW)
    both = t.school_cells.unionByName(t.cells_fx.withColumn("file_id", (F.col("file_id") * -1).cast("bigint")))
    found = cells.looks_like_school(both, _K)
    return found.withColumn("file_id", F.when(F.col("file_id") < 0, -F.col("file_id")).otherwise(F.col("file_id")))


