"""Aggregates, quality report and comparison (I, J, M)."""

from pyspark.sql import functions as F

from ..operators import compare, quality, stats
from .inputs import define
from .registry import query

# A fourth table: one line per (school, major), where the major is derived from the part brand.
define("major_fx", """
SELECT DISTINCT year, province, school_name, school_code, '专业' || CAST(plan_count % 7 AS STRING) AS major_name,
       subject_type, major_group, min_score, min_rank FROM school_fx WHERE min_score IS NOT NULL""")
# School rows with a source: some come from text recognition and some of those carry broken names.
define("school_sourced", """
SELECT s.*, CASE WHEN plan_count % 4 = 0 THEN 'ocr_experimental:/img/' || CAST(plan_count AS STRING) || '.png' ELSE 'file.xlsx' END AS source_url,
       CASE plan_count % 8 WHEN 0 THEN '4' WHEN 4 THEN '北京大学' ELSE school_name END AS shown_name FROM school_fx s""")


@query("I1_table_summary", """
WITH k AS (SELECT 'school' AS table_name, year, province FROM school_fx UNION ALL SELECT 'rank', year, province FROM rank_fx
           UNION ALL SELECT 'control', year, province FROM control_fx UNION ALL SELECT 'major', year, province FROM major_fx)
SELECT table_name, count(*) AS row_count, (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST(year AS VARCHAR) AS y FROM k)) AS years_available,
       (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT province AS p FROM k)) AS provinces_available FROM k GROUP BY table_name""")
def table_summary(t):
    return stats.table_summary({"school": t.school_fx, "rank": t.rank_fx, "control": t.control_fx, "major": t.major_fx})


@query("I2_home_totals", "SELECT count(*) AS school_total, count(DISTINCT year) AS year_count, count(DISTINCT province) AS province_count FROM school_fx")
def home_totals(t):
    return stats.home_totals(t.school_fx)


@query("I3_rows_per_year", "SELECT year, count(*) AS cnt FROM school_fx GROUP BY year ORDER BY year")
def rows_per_year(t):
    return stats.rows_per_year(t.school_fx)


_COMPARE = """SELECT year, count(*) AS total_records, count(*) FILTER (subject_type = '历史类') AS history_count,
 count(*) FILTER (subject_type = '物理类') AS physics_count, round(avg(min_score), 2) AS avg_min_score, max(min_score) AS max_min_score
 FROM school_fx WHERE year IN (1996, 1997) GROUP BY year"""


@query("I4_year_comparison", _COMPARE + " ORDER BY year")
def year_comparison(t):
    return stats.year_comparison(t.school_fx, (1996, 1997))


@query("I5_year_comparison_long", f"""
SELECT year, '历史类' AS subject_type, history_count AS n FROM ({_COMPARE}) a
UNION ALL SELECT year, '物理类', physics_count FROM ({_COMPARE}) b""")
def year_comparison_long(t):
    return stats.year_comparison_long(stats.year_comparison(t.school_fx, (1996, 1997)))


@query("I6_tier_counts", """SELECT count(*) AS total, count(*) FILTER (is_985) AS count_985, count(*) FILTER (is_211) AS count_211,
 count(*) FILTER (is_double_first_class) AS count_dfc FROM meta_fx""")
def tier_counts(t):
    return stats.tier_counts(t.meta_fx)


@query("I7_count_by_city", "SELECT city, count(*) AS n FROM meta_fx WHERE trim(city) <> '' GROUP BY city ORDER BY n DESC, city")
def count_by_city(t):
    return stats.count_by_text(t.meta_fx, "city")


@query("I7_count_by_school_type", "SELECT school_type, count(*) AS n FROM meta_fx WHERE trim(school_type) <> '' GROUP BY school_type ORDER BY n DESC, school_type")
def count_by_school_type(t):
    return stats.count_by_text(t.meta_fx, "school_type")


@query("I8_category_breakdown", "SELECT admission_category, batch, count(*) AS n FROM school_fx GROUP BY 1, 2 ORDER BY 1, 2")
def category_breakdown(t):
    return stats.count_by(t.school_fx, "admission_category", "batch").orderBy("admission_category", "batch")


_MODE = """CASE WHEN {s} < 0.2 THEN 'score' WHEN {r} < 0.2 AND {s} >= 0.8 THEN 'rank' ELSE 'mixed' END"""
# Requested keys include years after the data and a province without rows.
define("mode_request", """
SELECT DISTINCT year, province FROM school_fx UNION SELECT year + 10, province FROM school_fx UNION SELECT year, '浙江' FROM school_fx""")
_RATES = f"""
rates AS (SELECT q.year, q.province, count(s.year) AS total,
  CASE WHEN count(s.year) = 0 THEN 1.0 ELSE CAST(count(*) FILTER (s.year IS NOT NULL AND s.min_score IS NULL) AS DOUBLE) / count(s.year) END AS ms,
  CASE WHEN count(s.year) = 0 THEN 1.0 ELSE CAST(count(*) FILTER (s.year IS NOT NULL AND s.min_rank IS NULL) AS DOUBLE) / count(s.year) END AS mr
  FROM mode_request q LEFT JOIN school_fx s ON q.year = s.year AND q.province = s.province GROUP BY 1, 2),
modes AS (SELECT *, CASE WHEN total = 0 THEN CASE province WHEN '浙江' THEN 'score' ELSE 'mixed' END ELSE {_MODE.format(s='ms', r='mr')} END AS mode FROM rates)"""


@query("I9_null_rates", "WITH " + _RATES + """
SELECT year, province, total, CAST(ms AS DOUBLE) AS min_score_null_rate, CAST(mr AS DOUBLE) AS min_rank_null_rate, mode AS recommended_query_mode FROM modes""")
def null_rates(t):
    return stats.null_rates(t.school_fx, t.mode_request)


@query("I10_query_mode", "WITH " + _RATES + """
SELECT year, province, mode AS query_mode FROM modes
UNION ALL SELECT DISTINCT CAST(NULL AS INT), province, 'mixed' FROM mode_request
UNION ALL SELECT DISTINCT year, '山东', 'rank' FROM mode_request""")
def query_mode(t):
    t = t.kept("school_fx", "year", "province", "min_score", "min_rank").kept("mode_request")
    extra = t.sql("""SELECT year, province FROM mode_request UNION ALL SELECT DISTINCT CAST(NULL AS INT), province FROM mode_request
                     UNION ALL SELECT DISTINCT year, '山东' FROM mode_request""")
    return stats.resolved_modes(extra, t.school_fx)


@query("I17_score_query_gate", "WITH " + _RATES + """
SELECT year, province, CASE WHEN total = 0 THEN province = '浙江' ELSE ms <= 0.8 END AS available FROM modes""")
def score_query_gate(t):
    return stats.score_query_gate(t.mode_request, t.school_fx).select("year", "province", "available")


@query("I11_blank_counts", """
WITH n AS (SELECT 'noise' AS table_name, 'subject_raw' AS column_name, count(*) AS total, count(*) FILTER (coalesce(trim(subject_raw), '') = '') AS blank FROM school_noise
 UNION ALL SELECT 'noise', 'province_raw', count(*), count(*) FILTER (coalesce(trim(province_raw), '') = '') FROM school_noise
 UNION ALL SELECT 'rank', 'subject_type', count(*), count(*) FILTER (coalesce(trim(subject_type), '') = '') FROM rank_fx
 UNION ALL SELECT 'control', 'subject_type', count(*), count(*) FILTER (coalesce(trim(subject_type), '') = '') FROM control_fx)
SELECT *, CASE WHEN blank = 0 THEN 'ok' ELSE 'check' END AS status FROM n""")
def blank_counts(t):
    return stats.blank_counts({
        "noise": (t.school_noise, ("subject_raw", "province_raw")),
        "rank": (t.rank_fx, ("subject_type",)),
        "control": (t.control_fx, ("subject_type",)),
    })


_HIST = """
WITH v AS (SELECT CAST({c} AS DOUBLE) AS x FROM school_fx WHERE {c} IS NOT NULL), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT i AS bin, lo, hi, (hi - lo) / {n} AS w FROM e, range(1, {n} + 1) r(i))
SELECT CAST(b.bin AS INT) AS bin, CAST(trunc(lo + (b.bin - 1) * w - CASE WHEN b.bin = 1 THEN (hi - lo) * 0.001 ELSE 0 END) AS BIGINT) AS left_edge,
       CAST(trunc(lo + b.bin * w) AS BIGINT) AS right_edge,
       count(v.x) AS n
FROM b LEFT JOIN v ON (v.x > lo + (b.bin - 1) * w OR b.bin = 1) AND (v.x <= lo + b.bin * w OR b.bin = {n})
GROUP BY ALL"""


@query("I13_score_histogram", _HIST.format(c="min_score", n=20))
def score_histogram(t):
    return stats.equal_width_histogram(t.school_fx, "min_score", 20)


@query("I14_rank_histogram", _HIST.format(c="min_rank", n=30))
def rank_histogram(t):
    return stats.equal_width_histogram(t.school_fx, "min_rank", 30)


@query("I15_box_statistics", """
SELECT subject_type, min(min_score) AS low, quantile_cont(min_score, 0.25) AS q1, quantile_cont(min_score, 0.5) AS median,
       quantile_cont(min_score, 0.75) AS q3, max(min_score) AS high, count(min_score) AS n FROM school_fx WHERE min_score IS NOT NULL GROUP BY subject_type""")
def box_statistics(t):
    return stats.box_statistics(t.school_fx, "subject_type", "min_score")


@query("J1_table_counts", """
SELECT 'school' AS table_name, year, province, count(*) AS n FROM school_fx GROUP BY 2, 3
UNION ALL SELECT 'rank', year, province, count(*) FROM rank_fx GROUP BY 2, 3
UNION ALL SELECT 'control', year, province, count(*) FROM control_fx GROUP BY 2, 3
UNION ALL SELECT 'major', year, province, count(*) FROM major_fx GROUP BY 2, 3""")
def table_counts(t):
    return quality.table_counts({"school": t.school_fx, "rank": t.rank_fx, "control": t.control_fx, "major": t.major_fx})


@query("J1_subject_distribution", """
SELECT 'school' AS table_name, year, province, coalesce(nullif(subject_raw, ''), '(空)') AS subject_type, count(*) AS n FROM school_noise GROUP BY 2, 3, 4
UNION ALL SELECT 'rank', year, province, subject_type, count(*) FROM rank_fx GROUP BY 2, 3, 4""")
def subject_distribution(t):
    schools = t.school_noise.select("year", "province", F.col("subject_raw").alias("subject_type"))
    return quality.distribution({"school": schools, "rank": t.rank_fx}, "subject_type")


@query("J1_batch_distribution", "SELECT 'control' AS table_name, year, province, batch, count(*) AS n FROM control_fx GROUP BY 2, 3, 4")
def batch_distribution(t):
    return quality.distribution({"control": t.control_fx}, "batch")


@query("J2_score_ranges", """
SELECT 'school' AS scope, year, province, '*' AS subject_type, min(min_score) AS lo, max(min_score) AS hi FROM school_fx GROUP BY 2, 3
UNION ALL SELECT 'rank', year, province, subject_type, CAST(min(score) AS DOUBLE), CAST(max(score) AS DOUBLE) FROM rank_fx GROUP BY 2, 3, 4""")
def score_ranges(t):
    return quality.score_ranges(t.school_fx, t.rank_fx)


@query("J3_blank_subjects_and_names", """
SELECT 'noise.subject_type' AS field, year, province, count(*) FILTER (coalesce(subject_raw, '') = '') AS blank FROM school_noise GROUP BY 2, 3
UNION ALL SELECT 'rank.subject_type', year, province, count(*) FILTER (coalesce(subject_type, '') = '') FROM rank_fx GROUP BY 2, 3
UNION ALL SELECT 'school.school_name', year, province, count(*) FILTER (coalesce(school_name, '') = '') FROM school_fx GROUP BY 2, 3""")
def blank_subjects(t):
    noise = t.school_noise.select("year", "province", F.col("subject_raw").alias("subject_type"))
    return quality.blank_subjects({"noise": noise, "rank": t.rank_fx}, t.school_fx)


_FALLS = """SELECT year, province, subject_type, score AS higher_score, cumulative_count AS higher_cum,
  lead(score) OVER w AS lower_score, lead(cumulative_count) OVER w AS lower_cum FROM rank_bad WHERE cumulative_count IS NOT NULL
  WINDOW w AS (PARTITION BY year, province, subject_type ORDER BY score DESC)"""


@query("J4_monotonic_violations", f"SELECT * FROM ({_FALLS}) x WHERE higher_cum > lower_cum")
def monotonic_violations(t):
    return quality.monotonic_violations(t.rank_bad)


# Rank rows of which some (year, province) miss a subject.
define("rank_holes", """
SELECT * FROM rank_bad WHERE NOT (subject_type = '物理类' AND (year + length(province)) % 3 = 0) AND NOT (subject_type = '历史类' AND (year + length(province)) % 4 = 0)""")
_GAPS = """SELECT DISTINCT k.year, k.province, e.subject_type FROM (SELECT DISTINCT year, province FROM rank_holes) k
  CROSS JOIN (VALUES ('历史类'), ('物理类')) e(subject_type)
  WHERE NOT EXISTS (SELECT 1 FROM rank_holes r WHERE r.year = k.year AND r.province = k.province AND r.subject_type = e.subject_type)"""


@query("J5_missing_subjects", _GAPS)
def missing_subjects(t):
    return quality.missing_subjects(t.rank_holes)


@query("J6_recognised_share", """
WITH s AS (SELECT year, province, starts_with(source_url, 'ocr_experimental:') AS ocr,
  NOT (length(shown_name) > 1 AND regexp_matches(shown_name, '[一-鿿]')) AS bad FROM school_sourced)
SELECT year, province, count(*) FILTER (ocr) AS ocr_record_count, count(*) FILTER (ocr) > 0 AS requires_manual_review,
  CASE WHEN count(*) FILTER (ocr) > 0 THEN 'ocr_experimental' END AS source_quality, count(*) FILTER (ocr AND bad) AS invalid_school_name_count,
  CAST(count(*) FILTER (ocr AND bad) AS DOUBLE) / count(*) FILTER (ocr) AS invalid_school_name_rate FROM s GROUP BY 1, 2""")
def recognised_share(t):
    return quality.recognised_share(t.school_sourced.withColumn("school_name", F.col("shown_name")))


@query("J7_null_rates_and_mode", f"""
SELECT year, province, total, ms AS min_score_null_rate, mr AS min_rank_null_rate, {_MODE.format(s='ms', r='mr')} AS recommended_query_mode FROM (
 SELECT year, province, count(*) AS total, CAST(count(*) - count(min_score) AS DOUBLE) / count(*) AS ms,
 CAST(count(*) - count(min_rank) AS DOUBLE) / count(*) AS mr FROM school_fx GROUP BY 1, 2) x""")
def report_null_rates(t):
    return quality.null_rate_report(t.school_fx)


@query("M5_quality_step_status", f"""
WITH g AS (SELECT year, province, count(*) AS n FROM ({_GAPS}) a GROUP BY 1, 2),
f AS (SELECT year, province, count(*) AS n FROM ({_FALLS.replace('rank_bad', 'rank_holes')}) b WHERE higher_cum > lower_cum GROUP BY 1, 2)
SELECT k.year, k.province, coalesce(g.n, 0) AS missing_subjects, coalesce(f.n, 0) AS violations,
  CASE WHEN coalesce(g.n, 0) > 0 OR coalesce(f.n, 0) > 0 THEN 'partial' ELSE 'ok' END AS status
FROM (SELECT DISTINCT year, province FROM rank_holes) k LEFT JOIN g USING (year, province) LEFT JOIN f USING (year, province)""")
def quality_step_status(t):
    return quality.year_step_status(t.rank_holes)


@query("M1_null_rates_per_column", """
UNPIVOT (SELECT avg(CASE WHEN major_group IS NULL THEN 1.0 ELSE 0.0 END) AS major_group, avg(CASE WHEN min_score IS NULL THEN 1.0 ELSE 0.0 END) AS min_score,
 avg(CASE WHEN min_rank IS NULL THEN 1.0 ELSE 0.0 END) AS min_rank, avg(CASE WHEN school_name IS NULL THEN 1.0 ELSE 0.0 END) AS school_name FROM school_raw)
ON COLUMNS(*) INTO NAME column_name VALUE null_rate""".replace("UNPIVOT (", "SELECT * FROM (UNPIVOT (").replace("VALUE null_rate", "VALUE null_rate)"))
def column_null_rates(t):
    return compare.null_rates(t.school_raw.select("major_group", "min_score", "min_rank", "school_name"))


_DUP = "SELECT count(*) AS row_count, 1 - CAST((SELECT count(*) FROM (SELECT DISTINCT {c} FROM {t})) AS DOUBLE) / count(*) AS duplicate_rate FROM {t}"
_DUPCOLS = "year, province, school_code, subject_type, admission_category, batch, major_group"


@query("M2_duplicate_rate", _DUP.format(c=_DUPCOLS, t="school_raw"))
def duplicate_rate(t):
    return compare.duplicate_rate(t.school_raw.select(*_DUPCOLS.split(", ")))


@query("M3_compare_columns", """
WITH a AS (SELECT 'school_code' AS column_name, avg(CASE WHEN school_code IS NULL THEN 1.0 ELSE 0.0 END) AS rate_a FROM school_raw
 UNION ALL SELECT 'major_group', avg(CASE WHEN major_group IS NULL THEN 1.0 ELSE 0.0 END) FROM school_raw
 UNION ALL SELECT 'src_line', 0.0),
b AS (SELECT 'school_code' AS column_name, avg(CASE WHEN school_code IS NULL THEN 1.0 ELSE 0.0 END) AS rate_b FROM school_fx
 UNION ALL SELECT 'major_group', avg(CASE WHEN major_group IS NULL THEN 1.0 ELSE 0.0 END) FROM school_fx
 UNION ALL SELECT 'plan_count', avg(CASE WHEN plan_count IS NULL THEN 1.0 ELSE 0.0 END) FROM school_fx)
SELECT column_name, rate_a, rate_b, CASE WHEN rate_b IS NULL THEN 'only_a' WHEN rate_a IS NULL THEN 'only_b' ELSE 'common' END AS place
FROM a FULL JOIN b USING (column_name)""")
def compare_columns(t):
    return compare.compare_columns(t.school_raw.select("school_code", "major_group", "src_line"), t.school_fx.select("school_code", "major_group", "plan_count"))


@query("M3_compare_sizes", f"""
SELECT a.row_count AS rows_a, b.row_count AS rows_b, a.duplicate_rate AS duplicate_rate_a, b.duplicate_rate AS duplicate_rate_b,
 a.row_count - b.row_count AS row_difference FROM ({_DUP.format(c=_DUPCOLS, t='school_raw')}) a, ({_DUP.format(c=_DUPCOLS, t='school_fx')}) b""")
def compare_sizes(t):
    cols = _DUPCOLS.split(", ")
    return compare.compare_sizes(t.school_raw.select(*cols), t.school_fx.select(*cols))


define("metric_fx", """
SELECT 'school:' || province AS metric, count(*) AS value FROM school_fx GROUP BY province
UNION ALL SELECT 'rank:' || province, count(*) FROM rank_fx GROUP BY province""")
define("expect_fx", """
SELECT CASE WHEN metric LIKE 'school%' THEN 'data_quality' ELSE 'tables' END AS section, metric,
       CASE WHEN metric LIKE '%ASIA' THEN value + 1 ELSE 1 END AS minimum FROM metric_fx
UNION ALL SELECT DISTINCT 'tables', 'absent:' || province, 1 FROM school_fx""")


@query("M4_regression_gate", """
WITH c AS (SELECT e.section, coalesce(m.value >= e.minimum, false) AS passed FROM expect_fx e LEFT JOIN metric_fx m USING (metric))
SELECT coalesce(section, 'overall') AS section, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, count(*) AS total,
 CASE WHEN count(*) FILTER (NOT passed) = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM c GROUP BY ROLLUP (section)""")
def regression_gate(t):
    return compare.gate(t.expect_fx, t.metric_fx)
