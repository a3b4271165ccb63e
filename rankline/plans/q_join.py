"""Metadata joins, dimensions and scan summaries."""

from pyspark.sql import functions as F

from ..functions import dimensions
from ..operators import load, metajoin, search, stats
from . import sqlbits as q
from .inputs import define
from .q_clean import _LOG, _ORDER
from .registry import query

_M = "m.standard_name, m.city, m.is_985, m.is_211, m.is_double_first_class, m.school_type"
_ON = "(s.school_name = m.standard_name OR s.school_name = m.school_name OR starts_with(lower(s.school_name), lower(m.standard_name)))"
_S = ", ".join("s." + c for c in search.SCHOOL_COLUMNS)
_TIES = ", ".join(f"s.{c} NULLS FIRST" for c in search.TIES) + ", m.standard_name NULLS FIRST"


@query("H1_enriched_rows", f"SELECT {_S}, {_M} FROM school_fx s LEFT JOIN meta_fx m ON {_ON}")
def enriched_rows(t):
    return metajoin.enriched(t.school_fx, t.meta_fx)


@query("H1_search_enriched", f"""
SELECT {_S}, {_M}, count(*) OVER () AS total FROM school_fx s JOIN meta_fx m ON {_ON} WHERE s.min_rank >= 100 AND m.is_211 AND m.city = 'CITY_2'
ORDER BY s.min_rank NULLS LAST, {_TIES} LIMIT 200""")
def search_enriched(t):
    return metajoin.search_enriched(t.school_fx, t.meta_fx, rank_min=100, is_211=True, city="CITY_2", limit=999)


@query("H2_search_enriched_by_keyword", f"""
SELECT {_S}, {_M}, count(*) OVER () AS total FROM school_fx s LEFT JOIN meta_fx m ON {_ON} WHERE s.batch = '本科批' AND contains(s.school_name, 'ring') AND s.min_score >= 300
ORDER BY s.min_score DESC NULLS LAST, {_TIES} LIMIT 500""")
def search_enriched_by_keyword(t):
    return metajoin.search_enriched(t.school_fx, t.meta_fx, batch="本科批", keyword="Ring", min_score=300, limit=500, default=500, maximum=500)


@query("H3_tier_reachable", f"""
SELECT m.standard_name, m.city, s.subject_type, s.year, m.is_985, m.is_211, m.is_double_first_class, min(s.min_score) AS min_score
FROM school_fx s JOIN meta_fx m ON {_ON} WHERE s.min_score <= 600 AND m.is_211 GROUP BY ALL
ORDER BY min_score DESC, m.standard_name, m.city, s.subject_type, s.year, m.is_985, m.is_211, m.is_double_first_class LIMIT 100""")
def tier_reachable(t):
    return metajoin.tier_reachable(t.school_fx, t.meta_fx, max_score=600, tier="211")


define("download_fx", """
SELECT event_id, 'img' || CAST(user_id AS STRING) || '.png' AS file_name, 'https://x.example/' || CAST(event_id AS STRING) AS source_url,
  'https://x.example/p' || CAST(event_id % 50 AS STRING) AS page_url, event_type AS source_title FROM {events} WHERE event_type <> 'error'""")
define("image_fx", "SELECT image_id, 'img' || CAST(image_id AS STRING) || '.png' AS file_name, count(*) % 5 = 0 AS corrupted FROM items_fx GROUP BY image_id")
_LAST = "SELECT file_name, arg_max(source_url, event_id) AS source_url, arg_max(page_url, event_id) AS page_url, arg_max(source_title, event_id) AS source_title FROM download_fx GROUP BY file_name"


@query("H8_images_with_downloads", f"SELECT i.*, d.source_url, d.page_url, d.source_title FROM image_fx i LEFT JOIN ({_LAST}) d USING (file_name)")
def images_with_downloads(t):
    return metajoin.attach_downloads(t.image_fx, t.download_fx, "event_id")


@query("K22_corruption_summary", f"""
SELECT count(*) AS image_count, count(*) FILTER (NOT corrupted) AS ok_count, count(*) FILTER (corrupted) AS corrupted_count,
  count(*) FILTER (corrupted AND d.source_url IS NOT NULL) AS corrupted_with_source FROM image_fx i LEFT JOIN ({_LAST}) d USING (file_name)""")
def corruption_summary(t):
    rows = metajoin.attach_downloads(t.image_fx, t.download_fx, "event_id")
    return rows.agg(
        F.count("*").alias("image_count"), F.count_if(~F.col("corrupted")).alias("ok_count"), F.count_if("corrupted").alias("corrupted_count"),
        F.count_if(F.col("corrupted") & F.col("source_url").isNotNull()).alias("corrupted_with_source"),
    )


# Availability per province and year, measured on the school rows.
define("avail_fx", """
SELECT province, year, CASE n % 4 WHEN 0 THEN 'imported' WHEN 1 THEN 'not_started' WHEN 2 THEN 'imported_partial' ELSE 'other' END AS school_import_status,
  n % 2 = 0 AS machine_readable, CASE n % 5 WHEN 0 THEN 'partial' WHEN 1 THEN 'unknown' WHEN 2 THEN '' ELSE NULL END AS machine_readable_level,
  CASE n % 3 WHEN 0 THEN 'score' WHEN 1 THEN 'rank' ELSE 'unsupported_pdf_or_image' END AS query_mode, CASE n % 6 WHEN 0 THEN 'partial' WHEN 1 THEN 'available' WHEN 2 THEN '' ELSE NULL END AS access_status,
  CASE n % 2 WHEN 0 THEN 'Excel' ELSE 'PDF' END AS source_format, 'n' || CAST(n % 7 AS STRING) AS notes
FROM (SELECT CASE province WHEN 'AFRICA' THEN '江苏' WHEN 'AMERICA' THEN '广东' WHEN 'ASIA' THEN '福建' WHEN 'EUROPE' THEN '河南' ELSE '湖南' END AS province, year, count(*) AS n
      FROM school_fx GROUP BY 1, 2) x""")
_ACCESS = "coalesce(nullif(access_status, ''), CASE province WHEN '江苏' THEN 'available' WHEN '广东' THEN 'partial' WHEN '福建' THEN 'waf_blocked' WHEN '河南' THEN 'verification_required' ELSE 'unknown' END)"


@query("G4_availability", f"SELECT province, year, school_import_status, query_mode, {_ACCESS} AS access_status, source_format, notes FROM avail_fx")
def availability(t):
    return dimensions.with_access(t.avail_fx).select("province", "year", "school_import_status", "query_mode", "access_status", "source_format", "notes")


def _labels(column, labels):
    return f"CASE {column} " + " ".join(f"WHEN {q.lit(k)} THEN {q.lit(v)}" for k, v in labels.items()) + f" ELSE {column} END"


@query("C37_display_labels", f"""
SELECT province, year, coalesce({_labels("nullif(machine_readable_level, '')", dimensions.READABLE_LABELS)}, CASE WHEN machine_readable THEN '是' ELSE '否' END) AS readable,
 {_labels('school_import_status', dimensions.IMPORT_LABELS)} AS import_label, {_labels('query_mode', dimensions.MODE_LABELS)} AS mode_label, {_ACCESS} AS access_status, source_format, notes FROM avail_fx""")
def display_labels(t):
    return dimensions.display_rows(t.avail_fx)


# The stated rows of the provinces with the number of school rows that the tables hold for each, and of years without a statement.
_STATED = ", ".join(f"({q.lit(r[0])}, {r[1]}, {q.lit(r[9])}, {q.lit(r[5])}, {q.lit(r[10])})" for r in dimensions.AVAILABILITY)


@query("G4_stated_availability", f"""
WITH a(province, year, access_status, source_format, notes) AS (VALUES {_STATED}), n AS (SELECT province, count(*) AS years FROM avail_fx GROUP BY 1)
SELECT a.province, CAST(a.year AS INT) AS year, access_status, source_format, notes, coalesce(years, 0) AS years_in_tables FROM a LEFT JOIN n USING (province)""")
def stated_availability(t):
    held = t.avail_fx.groupBy("province").agg(F.count("*").alias("years_in_tables"))
    rows = dimensions.display_rows(dimensions.availability(t.spark)).join(held, "province", "left").fillna(0, ["years_in_tables"])
    return rows.select("province", "year", "access_status", "source_format", "notes", "years_in_tables")


@query("I12_overview_distribution", f"""
SELECT 'access_status' AS field, {_ACCESS} AS value, count(*) AS n FROM avail_fx WHERE year = 1997 GROUP BY 2
UNION ALL SELECT 'query_mode', query_mode, count(*) FROM avail_fx WHERE year = 1997 GROUP BY 2""")
def overview_distribution(t):
    return dimensions.overview(t.avail_fx, 1997)


define("school_zh", """
SELECT s.*, CASE province WHEN 'AFRICA' THEN '江苏' WHEN 'AMERICA' THEN '广东' WHEN 'ASIA' THEN '福建' WHEN 'EUROPE' THEN '河南' ELSE '湖南' END AS zh FROM school_fx s""")


@query("I12_province_groups", """
SELECT count(DISTINCT zh) FILTER (zh IN ('江苏', '浙江', '山东', '广东')) AS structured_count, count(DISTINCT zh) FILTER (zh IN ('河南', '福建', '湖南')) AS source_aware_count,
 count(*) AS school_total FROM school_zh""")
def province_groups(t):
    return dimensions.group_counts(t.school_zh.select(F.col("zh").alias("province")))


@query("H9_availability_lookup", """
SELECT s.year, s.zh AS province, a.query_mode, count(*) AS n FROM school_zh s LEFT JOIN avail_fx a ON a.province = s.zh AND a.year = s.year AND a.machine_readable GROUP BY 1, 2, 3""")
def availability_lookup(t):
    rows = t.school_zh.select("year", F.col("zh").alias("province"))
    facts = t.avail_fx.where("machine_readable").select("province", "year", "query_mode")
    return rows.join(facts, ["province", "year"], "left").groupBy("year", "province", "query_mode").agg(F.count("*").alias("n"))


define("registry_fx", """
SELECT zh AS province, year, 'school' AS data_type FROM school_zh UNION ALL SELECT CASE province WHEN 'AFRICA' THEN '江苏' ELSE '福建' END, year, 'rank' FROM rank_fx
UNION ALL SELECT '江苏', year, 'control' FROM control_fx""")


@query("G14_province_coverage", """
SELECT province, min(year) || '-' || max(year) AS year_range, concat_ws('、', max('school') FILTER (data_type = 'school'), max('rank') FILTER (data_type = 'rank'), max('control') FILTER (data_type = 'control')) AS data_types,
  CASE province WHEN '江苏' THEN 'score' WHEN '福建' THEN 'score' WHEN '河南' THEN 'score' ELSE 'mixed' END AS query_mode FROM registry_fx GROUP BY province""")
def province_coverage(t):
    return dimensions.coverage(t.registry_fx)


# ---- outcome logs ----

_FILES = f"""
files AS (SELECT file_id, min(province) AS province, min(year) AS year, src_line, count(*) FILTER (outcome = 'inserted') AS ins, count(*) FILTER (outcome = 'failed') AS bad FROM o GROUP BY file_id, src_line),
outc AS (SELECT *, CASE WHEN src_line = 7 THEN 'skipped_wrong_type' WHEN src_line = 6 THEN 'downloaded_not_imported' WHEN ins > 0 THEN 'imported' WHEN bad > 0 THEN 'failed' ELSE 'skipped' END AS outcome FROM files)"""


def _file_log(t):
    log = load.outcomes(t.school_batch, t.school_stored, "school", _ORDER)
    files = log.groupBy("file_id", "src_line").agg(
        F.min("province").alias("province"), F.min("year").alias("year"),
        F.count_if(F.col("outcome") == "inserted").alias("ins"), F.count_if(F.col("outcome") == "failed").alias("bad"),
    )
    outcome = (
        F.when(F.col("src_line") == 7, "skipped_wrong_type").when(F.col("src_line") == 6, "downloaded_not_imported")
        .when(F.col("ins") > 0, "imported").when(F.col("bad") > 0, "failed").otherwise("skipped")
    )
    return files.withColumn("outcome", outcome)


@query("I18_outcomes_per_year", f"""WITH {_LOG}, {_FILES}
SELECT province, year, count(*) AS files, count(*) FILTER (outcome = 'imported') AS imported, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'skipped_wrong_type') AS skipped_wrong_type,
 count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'downloaded_not_imported') AS downloaded_not_imported FROM outc GROUP BY 1, 2""")
def outcomes_per_year(t):
    return stats.outcome_summary(_file_log(t), "province", "year").select(
        "province", "year", "files", "imported", "skipped", "skipped_wrong_type", "failed", "downloaded_not_imported"
    )


define("scan_fx", """
SELECT province, year, CASE WHEN province = 'ASIA' THEN 'waf_blocked' WHEN province = 'EUROPE' THEN 'partial' ELSE 'available' END AS access_status,
  CASE WHEN province = 'AMERICA' AND year % 2 = 0 THEN 'timeout' END AS error, CAST(count(*) AS INT) AS discovered_pages, CAST(sum(plan_count) AS INT) AS downloaded_files,
  CAST(count(min_score) AS INT) AS imported, CAST(count(min_rank) AS INT) AS skipped, CASE WHEN province = 'AFRICA' THEN 0 WHEN province = 'EUROPE' THEN 2 END AS failed FROM school_raw GROUP BY province, year""")
_SCAN = """SELECT province, sum(discovered_pages)::BIGINT AS discovered_pages, sum(downloaded_files)::BIGINT AS downloaded_files, sum(imported)::BIGINT AS imported, sum(skipped)::BIGINT AS skipped,
  sum(coalesce(failed, 0))::BIGINT AS failed, CASE WHEN max(access_status) NOT IN ('available', 'partial', 'unknown') THEN 'skipped_due_to_access_status' WHEN count(error) > 0 THEN 'partial'
  WHEN sum(coalesce(failed, 0)) > 0 THEN 'failed' ELSE 'ok' END AS status FROM scan_fx GROUP BY province"""


@query("I16_scan_report", _SCAN)
def scan_report(t):
    return stats.scan_report(t.scan_fx)


@query("I16_scan_totals", f"""SELECT count(*) AS total_provinces, count(*) FILTER (province IN ('AFRICA', 'ASIA')) AS structured, count(*) FILTER (province = 'EUROPE') AS source_aware,
 count(*) FILTER (status = 'skipped_due_to_access_status') AS skipped, count(*) FILTER (status = 'failed') AS failed FROM ({_SCAN}) s""")
def scan_totals(t):
    return stats.scan_totals(stats.scan_report(t.scan_fx), ("AFRICA", "ASIA"), ("EUROPE",))


define("link_fx", """
SELECT CAST(year(o_orderdate) AS INT) AS year, CASE o_orderkey % 3 WHEN 0 THEN 'school' WHEN 1 THEN 'rank' ELSE 'control' END AS data_type, o_orderkey,
  CASE o_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' todo ' ELSE 'https://x.example/' || CAST(o_orderkey AS STRING) END AS url,
  CASE o_custkey % 3 WHEN 0 THEN 'TODO' ELSE 'https://x.example/a.xlsx' END AS att FROM {orders}""")


@query("I19_source_link_status", """
SELECT year, data_type, count(*) FILTER (trim(url) <> '' AND upper(trim(url)) <> 'TODO') AS configured, count(*) FILTER (trim(url) = '' OR upper(trim(url)) = 'TODO') AS missing, count(*) AS total,
  sum(CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN att = 'TODO' THEN 0 ELSE 1 END ELSE 0 END)::BIGINT AS attachments_configured,
  sum(CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN att = 'TODO' THEN 2 ELSE 1 END ELSE 0 END)::BIGINT AS attachments_missing FROM link_fx GROUP BY 1, 2""")
def source_link_status(t):
    atts = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.col("att"), F.lit(" ")))
    return stats.source_link_status(t.link_fx.withColumn("attachments", atts))
