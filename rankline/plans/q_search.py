"""Searches, pages, charts and distinct values."""

from ..operators import search
from ..operators.search import SCHOOL_COLUMNS
from .registry import query

_COLS = ", ".join(SCHOOL_COLUMNS)
_TIES = ", ".join(f"{c} NULLS FIRST" for c in search.TIES)


@query("G1_search_schools_by_score_range", f"""
SELECT {_COLS}, count(*) OVER () AS total FROM school_fx
WHERE province = 'ASIA' AND min_score >= 400 AND min_score <= 600 AND contains(school_name, 'ring')
ORDER BY min_score DESC NULLS LAST, {_TIES} LIMIT 200""")
def search_by_score(t):
    return search.search_schools(t.school_fx, province="ASIA", subject_type="全部", keyword="RING", min_score=400, max_score=600, limit=1000)


@query("G1_search_schools_by_rank_range", f"""
SELECT {_COLS}, count(*) OVER () AS total FROM school_fx WHERE min_rank >= 500 AND min_rank <= 90000
ORDER BY min_rank ASC NULLS LAST, {_TIES} LIMIT 50""")
def search_by_rank(t):
    return search.search_schools(t.school_fx, rank_min=500, rank_max=90000, limit=0)


@query("G7_control_lines", """
SELECT year, province, subject_type, batch, score, count(*) OVER () AS total FROM control_fx WHERE contains(batch, '科')
ORDER BY year DESC, score DESC, province, subject_type, batch LIMIT 100""")
def control_lines(t):
    return search.control_page(t.control_fx, batch="科")


@query("G8_search_with_category_and_batch", f"""
SELECT {_COLS}, count(*) OVER () AS total FROM school_fx WHERE admission_category = '普通类' AND batch = '本科批' AND contains(school_name, 'cold')
ORDER BY min_score DESC NULLS LAST, {_TIES} LIMIT 500""")
def search_with_category(t):
    return search.search_schools(
        t.school_fx, admission_category="普通类", batch="本科批", keyword=" Cold ", limit=500, default=500, maximum=500
    )


@query("G9_chart_rows", """
SELECT year, province, subject_type, school_name, min_score, min_rank FROM school_fx WHERE min_rank IS NOT NULL AND subject_type = '物理类'""")
def chart_rows(t):
    return search.chart_rows(t.school_fx, mode="rank", subject_type="物理类")


@query("G10_export_rows", f"SELECT {_COLS} FROM school_fx ORDER BY year DESC, min_score DESC NULLS LAST, {_TIES}")
def export_rows(t):
    return search.export_rows(t.school_fx)


@query("G11_top_schools", f"""
SELECT school_name, min_score, subject_type, year, admission_category, batch FROM school_fx
WHERE min_score IS NOT NULL ORDER BY min_score DESC, {_TIES} LIMIT 20""")
def top_schools(t):
    return search.top_schools(t.school_fx)


_TOP = """
SELECT school_name, subject_type, {v}, school_name || ' (' || subject_type || ')' AS label FROM (
  SELECT *, row_number() OVER (PARTITION BY school_name, subject_type ORDER BY {v} {d}) AS rn FROM school_fx WHERE {v} IS NOT NULL) x
WHERE rn = 1 ORDER BY {v} {d}, school_name, subject_type LIMIT 20"""


@query("G12_top_distinct_by_score", _TOP.format(v="min_score", d="DESC"))
def top_distinct_score(t):
    return search.top_distinct(t.school_fx)


@query("G12_top_distinct_by_rank", _TOP.format(v="min_rank", d="ASC"))
def top_distinct_rank(t):
    return search.top_distinct(t.school_fx, mode="rank")


@query("G13_distinct_values", "SELECT DISTINCT batch AS v FROM school_fx WHERE trim(batch) <> '' ORDER BY v")
def distinct_batches(t):
    return search.distinct_values(t.school_fx, "batch")


@query("G13_metadata_distinct_values", "SELECT DISTINCT school_type AS v FROM meta_fx WHERE trim(school_type) <> '' ORDER BY v")
def distinct_school_types(t):
    return search.distinct_values(t.meta_fx, "school_type", search.METADATA_DISTINCT_COLUMNS)
