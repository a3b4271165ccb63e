"""Links, attachments, discovery, routing and sinks."""

from pyspark.sql import functions as F

from ..functions import titles
from ..operators import announce, cells, load
from ..operators.tablelog import TableLog
from ..session import shared_folder
from ..sources import files, pages
from . import sqlbits as q
from .inputs import define
from .q_cells import _FITS, _HEADS, _alias_values
from .q_text import _META
from .registry import query

_HREF = "regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', {i})"
define("page_links", """
SELECT page_id, url AS base_url, html FROM {pages}""")
_LINKS = f"""
raw AS (SELECT page_id, base_url, unnest({_HREF.format(i=1)}) AS href, unnest({_HREF.format(i=2)}) AS text, generate_subscripts({_HREF.format(i=1)}, 1) - 1 AS link_no FROM page_links),
ln AS (SELECT page_id, CAST(link_no AS INT) AS link_no, regexp_extract(base_url, '^[a-z]+://[^/?#]*', 0) || href AS url, text FROM raw)"""


# The given pages with links to files added: the kind of file depends on the page.
define("page_files", """
SELECT page_id, url, '<a href="/files/' || CAST(page_id AS STRING) || '.xlsx">表</a><a href=''down/list?x=1''>投档 下载</a><a href="#top">x</a><a href="javascript:go()">录取</a>'
  || '<img src="/uploadfile/p' || CAST(page_id AS STRING) || '.PNG"><img src="/images/logo.png"><a href="../a/downfile.jsp?filename=%E8%A1%A8.xls">导出</a><a href="/files/' || CAST(page_id AS STRING) || '.xlsx">again</a>'
  || '<!-- <a href="/old.xlsx">旧</a> --><script>var s = "<a href=/js.xlsx>脚本</a>";</script><a data-href="/wrong.xlsx" href="/files/right.pdf" title="1>0">&#20013;&ldquo;x&rdquo;</a><img data-src="/lazy.png" src="/uploadfile/real.jpg">'
  || '<a href="../../../../../../../up/top.zip">上</a><a href="/a/b/c/d/e/f/../../../../../deep.xls">深</a><a href="downfile.jsp?showname=%E5%9B%BE.xlsx&amp;id=3"> 名 <b> 称 </b></a>' || html AS html FROM {pages}""")
_ROOT = "regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"
_PATH = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*(/.*)?$', 1)"
_DIR = f"regexp_replace(CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END, '[^/]*$', '')"
_UP = f"regexp_replace({_DIR}, '[^/]+/$', '')"


@query("A4_page_links", f"""WITH {_LINKS}
SELECT page_id, CAST(link_no + 13 AS INT) AS link_no, url, text FROM ln
UNION ALL SELECT page_id, 0, {_ROOT} || '/files/' || page_id || '.xlsx', '表' FROM page_files
UNION ALL SELECT page_id, 1, {_ROOT} || {_DIR} || 'down/list?x=1', '投档 下载' FROM page_files
UNION ALL SELECT page_id, 6, {_ROOT} || {_UP} || 'a/downfile.jsp?filename=%E8%A1%A8.xls', '导出' FROM page_files
UNION ALL SELECT page_id, 7, {_ROOT} || '/files/' || page_id || '.xlsx', 'again' FROM page_files
UNION ALL SELECT page_id, 8, {_ROOT} || '/files/right.pdf', '中“x”' FROM page_files
UNION ALL SELECT page_id, 10, {_ROOT} || '/up/top.zip', '上' FROM page_files
UNION ALL SELECT page_id, 11, {_ROOT} || '/a/deep.xls', '深' FROM page_files
UNION ALL SELECT page_id, 12, {_ROOT} || {_DIR} || 'downfile.jsp?showname=%E5%9B%BE.xlsx&id=3', '名称' FROM page_files""")
def page_links(t):
    return announce.links(t.page_files)


@query("A5_download_links", f"""
SELECT page_id, {_ROOT} || '/files/' || page_id || '.xlsx' AS url, '表' AS text, '.xlsx' AS ext FROM page_files
UNION ALL SELECT page_id, {_ROOT} || {_DIR} || 'down/list?x=1', '投档 下载', '.xlsx' FROM page_files
UNION ALL SELECT page_id, {_ROOT} || '/files/right.pdf', '中“x”', '.pdf' FROM page_files
UNION ALL SELECT page_id, {_ROOT} || '/up/top.zip', '上', '.zip' FROM page_files
UNION ALL SELECT page_id, {_ROOT} || '/a/deep.xls', '深', '.xls' FROM page_files""")
def download_links(t):
    return announce.download_links(announce.links(t.page_files))


_ATT = f"""
att AS (SELECT page_id, '表' AS title, {_ROOT} || '/files/' || page_id || '.xlsx' AS url, 'xlsx' AS file_type FROM page_files
UNION ALL SELECT page_id, 'p' || page_id || '.PNG', {_ROOT} || '/uploadfile/p' || page_id || '.PNG', 'png' FROM page_files
UNION ALL SELECT page_id, 'logo.png', {_ROOT} || '/images/logo.png', 'png' FROM page_files
UNION ALL SELECT page_id, '导出', {_ROOT} || {_UP} || 'a/downfile.jsp?filename=%E8%A1%A8.xls', 'xls' FROM page_files
UNION ALL SELECT page_id, '中“x”', {_ROOT} || '/files/right.pdf', 'pdf' FROM page_files
UNION ALL SELECT page_id, 'real.jpg', {_ROOT} || '/uploadfile/real.jpg', 'jpg' FROM page_files
UNION ALL SELECT page_id, '上', {_ROOT} || '/up/top.zip', 'zip' FROM page_files
UNION ALL SELECT page_id, '深', {_ROOT} || '/a/deep.xls', 'xls' FROM page_files
UNION ALL SELECT page_id, '名称', {_ROOT} || {_DIR} || 'downfile.jsp?showname=%E5%9B%BE.xlsx&id=3', 'xlsx' FROM page_files)"""


@query("A6_page_attachments", f"WITH {_ATT} SELECT * FROM att")
def page_attachments(t):
    return announce.attachments(t.page_files).drop("tag_no")


# The same from page files, through the source that parses a page once for cells and links.
def _parsed_files(t, rows="both"):
    folder = _folder(t) + "/pages"
    t.page_files.write.parquet(folder)
    return pages.read_pages(t.spark, folder, rows)


@query("A4_page_links_of_files", f"""WITH {_LINKS}
SELECT page_id, CAST(link_no + 13 AS INT) AS link_no, url, text FROM ln
UNION ALL SELECT page_id, 0, {_ROOT} || '/files/' || page_id || '.xlsx', '表' FROM page_files
UNION ALL SELECT page_id, 1, {_ROOT} || {_DIR} || 'down/list?x=1', '投档 下载' FROM page_files
UNION ALL SELECT page_id, 6, {_ROOT} || {_UP} || 'a/downfile.jsp?filename=%E8%A1%A8.xls', '导出' FROM page_files
UNION ALL SELECT page_id, 7, {_ROOT} || '/files/' || page_id || '.xlsx', 'again' FROM page_files
UNION ALL SELECT page_id, 8, {_ROOT} || '/files/right.pdf', '中“x”' FROM page_files
UNION ALL SELECT page_id, 10, {_ROOT} || '/up/top.zip', '上' FROM page_files
UNION ALL SELECT page_id, 11, {_ROOT} || '/a/deep.xls', '深' FROM page_files
UNION ALL SELECT page_id, 12, {_ROOT} || {_DIR} || 'downfile.jsp?showname=%E5%9B%BE.xlsx&id=3', '名称' FROM page_files""")
def page_links_of_files(t):
    return announce.absolute_links(pages.links_in(_parsed_files(t)), "page").withColumnRenamed("page", "page_id")


@query("A6_attachments_of_files", f"WITH {_ATT} SELECT * FROM att")
def attachments_of_files(t):
    return announce.attached_files(_parsed_files(t, "links"), "page").withColumnRenamed("page", "page_id").drop("tag_no")


@query("L2_data_attachments", f"""WITH {_ATT} SELECT page_id, 'control' AS kind, title, url FROM att WHERE title <> 'logo.png' UNION ALL SELECT page_id, 'school', title, url FROM att WHERE file_type IN ('xls', 'xlsx', 'pdf', 'zip')""")
def data_attachments(t):
    found = announce.attachments(t.page_files)
    parts = [announce.data_attachments(found, "page_id", kind).select("page_id", F.lit(kind).alias("kind"), "title", "url") for kind in ("control", "school")]
    return parts[0].unionByName(parts[1])


@query("L3_image_attachments", f"WITH {_ATT} SELECT page_id, title, url FROM att WHERE url LIKE '%/uploadfile/%'")
def image_attachments(t):
    return announce.image_attachments(announce.attachments(t.page_files)).select("page_id", "title", "url")


define("page_records", """
SELECT page_id, url, html || '<record><![CDATA[<a href="/art/' || CAST(page_id AS STRING) || '.html" title=" 公告 ">x</a>]]></record><record><![CDATA[<a href="javascript:x" title="y">]]></record>'
  || '<record><![CDATA[<a href="https://mp.weixin.qq.com/s" title="z">]]></record><record><![CDATA[<a href="https://o.example/1">]]></record><record><![CDATA[<a href="/art/' || CAST(page_id AS STRING) || '.html" title="again">]]></record>' AS html FROM {pages}""")


@query("A7_embedded_records", f"""
SELECT page_id, '公告' AS title, {_ROOT} || '/art/' || page_id || '.html' AS page_url FROM page_records UNION ALL SELECT page_id, 'https://o.example/1', 'https://o.example/1' FROM page_records""")
def embedded_records(t):
    return announce.embedded_records(t.page_records)


_YEARS = (2021, 2022, 2023, 2024)
_WORDS = titles.keyword_list(None)
_FOUND = f"""
yr AS (SELECT t.*, (SELECT CAST(min(y.year) AS INT) FROM (VALUES (2021, '二〇二一'), (2022, '二〇二二'), (2023, '二〇二三'), (2024, '二〇二四')) y(year, zh)
  WHERE contains(t.title, CAST(y.year AS VARCHAR)) OR contains(t.title, y.zh) OR regexp_matches(regexp_extract(t.page_url, '^https?://[^/]*([^?#]*)', 1), '/' || y.year || '[-/]')) AS year,
  list_filter([{', '.join(q.lit(w) for w in _WORDS)}], lambda w: contains(title, w))[1] AS matched_keyword FROM title_fx t),
fo AS (SELECT slug, title, page_url, matched_keyword, year, page_id FROM yr WHERE year IS NOT NULL AND matched_keyword IS NOT NULL AND title <> '' AND CASE slug WHEN 'jiangsu' THEN page_url LIKE '%/index_zkxx/%'
  WHEN 'zhejiang' THEN page_url LIKE '%/art/%' WHEN 'fujian' THEN false WHEN 'guangdong' THEN false WHEN 'hebei' THEN false WHEN 'henan' THEN false WHEN 'hubei' THEN false WHEN 'shandong' THEN false
  ELSE page_url NOT LIKE '%/show?%' END)"""


def _announcements(t):
    found = t.title_fx.select("slug", F.col("page_id").alias("link_no"), F.col("page_url").alias("url"), F.col("title").alias("text"))
    return announce.announcements(found, _YEARS, titles.keyword_list(None))


@query("L1_announcements", f"WITH {_FOUND} SELECT slug, title, page_url, matched_keyword, year FROM fo")
def announcements(t):
    return _announcements(t)


define("title_files", """
SELECT page_url, 1 AS tag_no, '表' AS title, page_url || '/a.xlsx' AS url, 'xlsx' AS file_type FROM title_fx UNION ALL SELECT page_url, 2, '图', 'https://x.example/f/b.png', 'png' FROM title_fx
UNION ALL SELECT page_url, 3, 'Logo', 'https://x.example/f/c.pdf', 'pdf' FROM title_fx""")


def _discovered(t):
    return announce.discovery_table(_announcements(t), t.title_files)


_TYPE = f"""CASE WHEN {q.has('title', titles.RANK_WORDS)} THEN 'rank' WHEN {q.has('title', titles.NOT_CONTROL_WORDS)} THEN CASE WHEN title LIKE '%投档线%' OR title LIKE '%投档情况%' THEN 'school' ELSE 'unknown' END
  WHEN title LIKE '%录取控制分数线%' THEN 'control' WHEN {q.has('title', titles.SCHOOL_WORDS)} THEN 'school' WHEN title LIKE '%专业录取%' THEN 'major' ELSE 'unknown' END"""


@query("L4_discovery_table", f"""WITH {_FOUND}
SELECT slug, title, page_url, year, {_TYPE} AS suggested_type, CAST(CASE WHEN page_url LIKE '%?y=2021' THEN 0 ELSE 1 END + CASE WHEN {_TYPE} = 'control' THEN 1 ELSE 0 END AS INT) AS n FROM fo""")
def discovery_table(t):
    out = _discovered(t)
    n = F.coalesce(F.size("attachments"), F.lit(0))
    return out.select("slug", "title", "page_url", "year", "suggested_type", F.when(n < 0, 0).otherwise(n).cast("int").alias("n"))


@query("L5_filtered_sources", f"WITH {_FOUND} SELECT slug, title, page_url FROM fo WHERE {_TYPE} = 'school' AND contains(title, '本科')")
def filtered_sources(t):
    return announce.filter_sources(_discovered(t), "school", " 本科 ").select("slug", "title", "page_url")


define("download_items", """
SELECT page_id, slug, title, source_title, CASE page_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'unsupported_verification_required' WHEN 2 THEN 'skipped' WHEN 3 THEN 'queued' ELSE 'downloaded' END AS status,
  'd/' || CAST(page_id AS STRING) || CASE page_id % 7 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.pdf' WHEN 2 THEN '.png' WHEN 3 THEN '.doc' WHEN 4 THEN '.HTML' WHEN 5 THEN '.rar' ELSE '.xls' END AS path,
  page_id % 29 <> 3 AS on_disk, CASE WHEN page_id % 31 = 4 THEN false END AS importable, page_id % 2 = 0 AS ocr, CASE page_id % 3 WHEN 0 THEN 'attachment' WHEN 1 THEN 'page_html' ELSE 'seed' END AS kind,
  page_id % 5 = 0 AS looks_like_school, page_id % 37 = 6 AS corrupted, page_id % 4 <> 3 AS gate_passed, CAST(page_id % 6 AS INT) AS inserted, CAST(page_id % 12 AS INT) AS failed_rows FROM title_fx""")


@query("A16_file_routes", """
SELECT page_id, CASE WHEN path LIKE '%.xls%' THEN 'excel' WHEN path LIKE '%.HTML' AND page_id % 2 = 0 THEN 'html' WHEN path LIKE '%.pdf' THEN 'pdf' WHEN path LIKE '%.png' THEN 'download_only' ELSE 'unsupported' END AS route,
  CASE WHEN path LIKE '%.xls%' OR path LIKE '%.pdf' OR (path LIKE '%.HTML' AND page_id % 2 = 0) THEN NULL WHEN path LIKE '%.HTML' THEN 'html holds control and rank only' WHEN path LIKE '%.doc' THEN 'unsupported document'
  WHEN path LIKE '%.rar' THEN 'unpack the archive first' ELSE 'image needs text recognition' END AS reason FROM download_items""")
def file_routes(t):
    kind = F.when(F.col("page_id") % 2 == 0, "rank").otherwise("school")
    route, reason = announce.route(F.col("path"), kind)
    return t.download_items.select("page_id", route.alias("route"), reason.alias("reason"))


@query("L6_import_outcomes", f"""
WITH {_META.replace('FROM title_fx t', 'FROM (SELECT page_id, slug, title, NULL AS source_title FROM title_fx) t')}
SELECT d.page_id, CASE WHEN status = 'unsupported_verification_required' THEN NULL WHEN status = 'failed' THEN 'failed' WHEN status = 'queued' THEN NULL WHEN NOT on_disk THEN 'failed'
  WHEN importable = false OR (path LIKE '%.png' AND NOT ocr) THEN 'downloaded_not_imported' WHEN path LIKE '%.doc' OR path LIKE '%.rar' THEN 'skipped'
  WHEN NOT (slug IN ('jiangsu','henan','zhejiang','shandong') OR m.category = '普通类') THEN 'skipped_unsupported_category'
  WHEN path LIKE '%.png' AND NOT gate_passed THEN 'downloaded_not_imported' WHEN path LIKE '%.png' AND corrupted THEN 'skipped_corrupted_image' WHEN inserted > 0 THEN 'imported'
  WHEN failed_rows > 0 THEN CASE WHEN path LIKE '%.png' THEN 'ocr_failed' ELSE 'failed' END ELSE CASE WHEN path LIKE '%.png' THEN 'ocr_skipped' ELSE 'skipped' END END AS outcome
FROM (SELECT page_id, status, path, on_disk, importable, ocr, gate_passed, corrupted, inserted, failed_rows FROM download_items) d JOIN m ON m.page_id = d.page_id""")
def import_outcomes(t):
    items = t.download_items.withColumnRenamed("on_disk", "exists")
    return announce.import_outcomes(items, "school", enable_ocr=True).select("page_id", "outcome")


@query("L7_direct_attachments", """
SELECT page_id, title, path AS url, CASE WHEN path LIKE '%.xls%' THEN 'excel' WHEN path LIKE '%.pdf' THEN 'pdf' ELSE 'unknown' END AS file_type FROM download_items""")
def direct_attachments(t):
    return t.download_items.select("page_id", announce.direct_attachment(F.col("title"), F.col("path")).alias("a")).select("page_id", "a.*")


# ---- sources and sinks ----

def _folder(t) -> str:
    return shared_folder(t.spark)


define("meta_text", """
SELECT school_name, CASE length(standard_name) % 7 WHEN 0 THEN ' ' ELSE standard_name END AS standard_name, CASE length(standard_name) % 5 WHEN 0 THEN 'js' WHEN 1 THEN '' ELSE '福建省' END AS province, city,
  CASE WHEN is_985 THEN '是' ELSE '0' END AS is_985, CASE WHEN is_211 THEN 'TRUE' ELSE '' END AS is_211, school_type FROM meta_fx""")
_META_ROWS = """SELECT school_name, standard_name, CASE province WHEN 'js' THEN '江苏' ELSE '福建' END AS province, city, is_985 = '是' AS is_985, is_211 = 'TRUE' AS is_211, school_type FROM meta_text
WHERE trim(standard_name) <> '' AND province <> ''"""
_META_COLS = ("school_name", "standard_name", "province", "city", "is_985", "is_211", "school_type")


def _metadata_csv(t):
    path = _folder(t) + "/metadata"
    files.save_csv(t.meta_text, path)
    return files.read_metadata_csv(t.spark, path)


@query("A1_metadata_csv", _META_ROWS)
def metadata_csv(t):
    return _metadata_csv(t).select(*_META_COLS)


@query("A13_cleaned_csv", "SELECT school_name, standard_name, province, city, is_985, is_211, school_type FROM meta_text")
def cleaned_csv(t):
    path = _folder(t) + "/cleaned"
    files.save_csv(t.meta_text, path)
    back = t.spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    columns = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("province", "is_211") else F.col(c) for c in back.columns]
    return back.select(*columns).withColumn("school_type", F.nullif("school_type", F.lit("")))


@query("F8_metadata_csv_upsert", f"""WITH r AS ({_META_ROWS}), s AS (SELECT * FROM r WHERE city <> 'CITY_X' AND province = '江苏')
SELECT r.standard_name, CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.standard_name = r.standard_name OR s.school_name = r.school_name OR s.school_name = r.standard_name OR s.standard_name = r.school_name) THEN
  CASE WHEN EXISTS (SELECT 1 FROM s WHERE s.standard_name = r.standard_name) AND NOT EXISTS (SELECT 1 FROM r e WHERE e.standard_name < r.standard_name AND e.school_name = r.school_name
    AND NOT EXISTS (SELECT 1 FROM s WHERE s.standard_name = e.standard_name)) THEN 'skipped' ELSE 'updated' END ELSE 'inserted' END AS outcome FROM r""")
def metadata_csv_upsert(t):
    rows = _metadata_csv(t)
    stored = rows.where("city <> 'CITY_X' AND province = '江苏'")
    return load.upsert_metadata(stored, rows, ["standard_name"]).log.select("standard_name", "outcome")


@query("A9_parameterised_sql", "SELECT province, count(*) AS n FROM school_fx WHERE year = 1997 AND min_score >= 300 GROUP BY province")
def parameterised_sql(t):
    sql = "SELECT province, count(*) AS n FROM {rankline_schools} WHERE year = :year AND min_score >= :low GROUP BY province"
    return files.query_tables(t.spark, sql, {"rankline_schools": t.school_fx}, year=1997, low=300.0)


define("school_export", "SELECT *, CAST(NULL AS STRING) AS tie_breaker_text, 'f.xlsx' AS source_url FROM school_fx")


@query("A10_exported_csv", """
SELECT province, year, CAST(year AS VARCHAR) AS "年份", school_name AS "院校名称", major_group AS "专业组", min_score AS "投档最低分", plan_count AS "计划数" FROM school_fx""")
def exported_csv(t):
    path = _folder(t) + "/export"
    files.export_csv(t.school_export, "school", path)
    back = t.spark.read.option("header", True).csv(path)
    return back.select(
        "province", F.col("year").cast("int").alias("year"), F.col("年份").cast("string").alias("年份"), "院校名称", "专业组", F.col("投档最低分").cast("double").alias("投档最低分"),
        F.col("计划数").cast("int").alias("计划数"),
    )


@query("A11_export_manifest", """
WITH c AS (SELECT 'school' AS record_type, province, year, count(*) AS n FROM school_fx GROUP BY 2, 3 UNION ALL SELECT 'control', province, year, count(*) FROM control_fx GROUP BY 2, 3)
SELECT record_type, province, year, CAST(sum(n) AS BIGINT) AS rows, count(*) AS files, CASE grouping(record_type, province, year) WHEN 0 THEN 'file' WHEN 1 THEN 'province' WHEN 3 THEN 'record_type' ELSE 'total' END AS level
FROM c GROUP BY ROLLUP (record_type, province, year)""")
def export_manifest(t):
    return files.export_manifest({"school": t.school_fx, "control": t.control_fx})


@query("A11_manifest_of_written_files", """
WITH c AS (SELECT 'school' AS record_type, province, year, count(*) AS n FROM school_fx GROUP BY 2, 3 UNION ALL SELECT 'control', province, year, count(*) FROM control_fx GROUP BY 2, 3)
SELECT record_type, province, year, CAST(sum(n) AS BIGINT) AS rows, count(*) AS files, CASE grouping(record_type, province, year) WHEN 0 THEN 'file' WHEN 1 THEN 'province' WHEN 3 THEN 'record_type' ELSE 'total' END AS level
FROM c GROUP BY ROLLUP (record_type, province, year)""")
def manifest_of_written_files(t):
    """The tables are written, and the manifest is read from the log of what was written, not from the rows."""
    parts = []
    for name, df in (("school", t.school_fx), ("control", t.control_fx)):
        log = TableLog(t.spark, f"{_folder(t)}/{name}", df.schema)
        log.append(df, "export")
        parts.append(log.live().withColumn("record_type", F.lit(name)))
    return files.written_manifest(parts[0].unionByName(parts[1]))


@query("A12_export_provinces", "SELECT DISTINCT province FROM school_dirty WHERE trim(province) <> '' AND year IN (1997, 1998) ORDER BY province")
def export_provinces(t):
    return files.export_provinces(t.school_dirty, [1997, 1998])


@query("A10_exported_years", """SELECT province, CAST(year AS INT) AS year, school_name AS "院校名称", min_score AS "投档最低分" FROM school_fx WHERE year IN (1997, 1998)""")
def exported_years(t):
    path = _folder(t) + "/export"
    files.export_csv(t.school_export, "school", path, [1997, 1998])
    back = t.spark.read.option("header", True).csv(path)
    return back.select("province", F.col("year").cast("int").alias("year"), "院校名称", F.col("投档最低分").cast("double").alias("投档最低分"))


@query("A14_json_report", "SELECT province, count(*) AS n, year AS report_year FROM school_fx GROUP BY province, year")
def json_report(t):
    counts = t.school_fx.groupBy("province", "year").agg(F.count("*").alias("n"))
    path = _folder(t) + "/report"
    files.save_report(counts.withColumnRenamed("year", "report_year"), path)
    return t.spark.read.schema("province string, n bigint, report_year int").json(path)


@query("A17_rejects", f"""WITH {_HEADS}, {_alias_values('school')}, {_FITS},
names AS (SELECT file_id, string_agg(DISTINCT header, '|' ORDER BY header) AS parsed_columns, string_agg(DISTINCT canonical, '|' ORDER BY canonical) AS normalized_columns FROM used GROUP BY 1)
SELECT file_id, 'school' AS record_type, 'no valid rows' AS error, CAST(1 AS INT) AS header_row, parsed_columns, normalized_columns, count(*) FILTER (row_idx < 30) AS preview_cells
FROM school_cells JOIN names USING (file_id) WHERE file_id % 9 = 4 GROUP BY file_id, parsed_columns, normalized_columns""")
def rejects(t):
    sheets = t.school_cells
    failed = sheets.where("row_idx = 0 AND file_id % 9 = 4").select("file_id", F.lit("school").alias("record_type"), F.lit("no valid rows").alias("error"))
    headers, _ = cells.split_header(sheets, ["file_id"])
    columns = cells.used_columns(cells.resolve_columns(headers, ["file_id"], cells.aliases_for("school")), ["file_id"])
    preview = files.reject_preview(failed, sheets, cells.header_rows(sheets, ["file_id"]), columns)
    return preview.groupBy("file_id", "record_type", "error", "header_row", "parsed_columns", "normalized_columns").agg(F.count("*").alias("preview_cells"))


@query("A18_typed_records", """
SELECT '{"year":' || year || ',"province":"' || province || '"' || coalesce(',"score":' || CAST(score AS INT) || '.0', '') || ',"_record_type":"control"}' AS record FROM control_fx""")
def typed_records(t):
    return files.typed_records(t.control_fx.select("year", "province", "score"), "control")
