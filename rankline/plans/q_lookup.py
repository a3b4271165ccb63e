"""Score/rank lookups and requests built on them."""

from pyspark.sql import functions as F

from ..operators import lookup, search
from ..operators.rangetop import LIMIT_DEFAULT
from .inputs import define
from .registry import query

define("probe_score", "SELECT DISTINCT year, province, subject_type, score + 3 AS q FROM rank_fx")
define("probe_rank", "SELECT DISTINCT year, province, subject_type, cumulative_count + 2 AS q FROM rank_fx")

_H4 = """
SELECT p.year, p.province, p.subject_type, p.q, CAST(r.cumulative_count AS INT) AS rank,
       CAST(CASE WHEN r.cumulative_count IS NULL THEN NULL ELSE CAST(r.score AS DOUBLE) END AS DOUBLE) AS matched_score,
       CASE WHEN r.cumulative_count IS NULL THEN NULL ELSE r.score = p.q END AS exact_match
FROM probe_score p ASOF LEFT JOIN {table} r
  ON p.year = r.year AND p.province = r.province AND p.subject_type = r.subject_type AND p.q >= r.score
WHERE p.q BETWEEN 0 AND 750
UNION ALL
SELECT year, province, subject_type, q, NULL, NULL, NULL FROM probe_score WHERE q NOT BETWEEN 0 AND 750
"""
_REQUEST = ("year", "province", "subject_type", "q")


@query("H4_score_to_rank", _H4.replace("{table}", "rank_fx"))
def score_to_rank(t):
    return lookup.score_to_rank(t.probe_score, t.rank_fx, score="q").select(*_REQUEST, "rank", "matched_score", "exact_match")


@query("H4_score_to_rank_gaps", _H4.replace("{table}", "rank_bad"))
def score_to_rank_gaps(t):
    return lookup.score_to_rank(t.probe_score, t.rank_bad, score="q").select(*_REQUEST, "rank", "matched_score", "exact_match")


_H5 = """
SELECT p.year, p.province, p.subject_type, p.q, CAST(max(r.score) AS INT) AS found_score,
       CAST(arg_max(r.cumulative_count, r.score) AS INT) AS matched_cumulative_count
FROM probe_rank p LEFT JOIN {table} r
  ON p.year = r.year AND p.province = r.province AND p.subject_type = r.subject_type AND r.cumulative_count >= p.q AND p.q > 0
GROUP BY 1,2,3,4
"""


@query("H5_rank_to_score", _H5.replace("{table}", "rank_fx"))
def rank_to_score(t):
    return lookup.rank_to_score(t.probe_rank, t.rank_fx, rank="q").select(*_REQUEST, "found_score", "matched_cumulative_count")


@query("H5_rank_to_score_not_monotone", _H5.replace("{table}", "rank_bad"))
def rank_to_score_not_monotone(t):
    return lookup.rank_to_score(t.probe_rank, t.rank_bad, rank="q").select(*_REQUEST, "found_score", "matched_cumulative_count")


define("probe_years", """
SELECT province, subject_type, year AS from_year, year + 1 AS to_year, q AS score FROM probe_score
UNION ALL SELECT province, subject_type, year, year, q FROM probe_score WHERE q % 10 = 0""")
_CONVERT = """
ranked AS (
  SELECT p.*, r.cumulative_count AS estimated_rank, CAST(r.score AS DOUBLE) AS from_matched_score, r.score = p.score AS from_exact_match
  FROM probe_years p ASOF JOIN rank_fx r
    ON p.from_year = r.year AND p.province = r.province AND p.subject_type = r.subject_type AND p.score >= r.score
  WHERE p.score BETWEEN 0 AND 750 AND p.from_year <> p.to_year AND r.cumulative_count IS NOT NULL),
converted AS (
  SELECT a.province, a.subject_type, a.from_year, a.to_year, a.score, a.estimated_rank, a.from_matched_score, a.from_exact_match,
         max(r.score) AS equivalent_score, arg_max(r.cumulative_count, r.score) AS to_matched_cumulative_count
  FROM ranked a JOIN rank_fx r
    ON a.to_year = r.year AND a.province = r.province AND a.subject_type = r.subject_type AND r.cumulative_count >= a.estimated_rank
  GROUP BY ALL)
"""


@query("H6_score_between_years", "WITH " + _CONVERT + """
SELECT province, subject_type, from_year, to_year, score, CAST(estimated_rank AS INT) AS estimated_rank, from_matched_score,
       from_exact_match, CAST(equivalent_score AS INT) AS equivalent_score, CAST(to_matched_cumulative_count AS INT) AS to_matched_cumulative_count
FROM converted""")
def score_between_years(t):
    return lookup.convert_between_years(t.probe_years, t.once("rank_fx")).select(
        "province", "subject_type", "from_year", "to_year", "score", "estimated_rank", "from_matched_score", "from_exact_match",
        "equivalent_score", "to_matched_cumulative_count",
    )


_TIES = """s.school_name NULLS FIRST, s.school_code NULLS FIRST, s.admission_category NULLS FIRST, s.batch NULLS FIRST, s.major_group NULLS FIRST"""
_OUT = ("school_name", "school_code", "admission_category", "batch", "major_group", "min_score", "min_rank")


@query("H7_schools_by_equivalent_score", "WITH " + _CONVERT + f"""
SELECT from_year, to_year, province, subject_type, score, CAST(equivalent_score AS INT) AS equivalent_score, total, place,
       school_name, school_code, admission_category, batch, major_group, min_score, min_rank FROM (
  SELECT c.from_year, c.to_year, c.province, c.subject_type, c.score, c.equivalent_score, s.school_name, s.school_code,
         s.admission_category, s.batch, s.major_group, s.min_score, s.min_rank,
         count(*) OVER w0 AS total, row_number() OVER (w0 ORDER BY s.min_score DESC, {_TIES}) AS place
  FROM converted c JOIN school_fx s ON c.to_year = s.year AND c.province = s.province AND c.subject_type = s.subject_type
   AND s.min_score BETWEEN c.equivalent_score - 10 AND c.equivalent_score + 10
  WINDOW w0 AS (PARTITION BY c.from_year, c.to_year, c.province, c.subject_type, c.score)) x
WHERE place <= {LIMIT_DEFAULT}""")
def schools_by_equivalent_score(t):
    requests = t.probe_years.withColumn("tolerance", F.lit(10)).withColumn("limit", F.lit(0))
    hits = search.schools_by_equivalent_score(requests, t.once("rank_fx"), t.once("school_fx"))
    return hits.select("from_year", "to_year", "province", "subject_type", "score", "equivalent_score", "total", "place", *_OUT)


_RANGE = """
SELECT year, province, subject_type, q, total, place, school_name, school_code, admission_category, batch, major_group, min_score, min_rank FROM (
  SELECT p.year, p.province, p.subject_type, p.q, s.school_name, s.school_code, s.admission_category, s.batch, s.major_group, s.min_score, s.min_rank,
         count(*) OVER w0 AS total, row_number() OVER (w0 ORDER BY {order}, {ties}) AS place
  FROM {probe} p JOIN school_fx s ON p.year = s.year AND p.province = s.province AND p.subject_type = s.subject_type AND {between}
  {gate}
  WINDOW w0 AS (PARTITION BY p.year, p.province, p.subject_type, p.q)) x
WHERE place <= {limit}"""


@query("G2_schools_by_rank", _RANGE.format(
    order="s.min_rank", ties=_TIES, probe="probe_rank", gate="", limit=20,
    between="s.min_rank BETWEEN greatest(1, p.q - 1000) AND p.q + 1000"))
def schools_by_rank(t):
    requests = t.probe_rank.select("*", F.col("q").alias("rank"), F.lit(1000).alias("tolerance"), F.lit(20).alias("limit"))
    hits = search.schools_by_rank(requests, t.once("school_fx"))
    return hits.select(*_REQUEST, "total", "place", *_OUT)


@query("G3_schools_by_score", _RANGE.format(
    order="s.min_score DESC", ties=_TIES, probe="probe_score", limit=20, between="s.min_score BETWEEN p.q - 5 AND p.q + 5",
    gate="""WHERE (p.year, p.province) IN (SELECT (year, province) FROM school_fx GROUP BY year, province
            HAVING avg(CASE WHEN min_score IS NULL THEN 1.0 ELSE 0.0 END) <= 0.8)"""))
def schools_by_score(t):
    requests = t.probe_score.select("*", F.col("q").alias("score"), F.lit(5).alias("tolerance"), F.lit(20).alias("limit"))
    hits = search.schools_by_score(requests, t.once("school_fx"))
    return hits.select(*_REQUEST, "total", "place", *_OUT)


@query("G5_rank_page", """
SELECT year, province, subject_type, score, same_score_count, cumulative_count, count(*) OVER () AS total FROM rank_fx
WHERE year = 1995 AND province = 'ASIA' AND subject_type = '物理类' ORDER BY score DESC LIMIT 100""")
def rank_page(t):
    return search.rank_page(t.rank_fx, year=1995, province="ASIA", subject_type="物理类")


@query("G6_rank_of_score", """
WITH p AS (SELECT DISTINCT year, province, subject_type, score + CASE WHEN score % 3 = 0 THEN 0.5 ELSE 1.0 END AS q FROM rank_fx)
SELECT p.year, p.province, p.subject_type, CAST(p.q AS DOUBLE) AS q, coalesce(e.score, w.score) AS score,
       coalesce(e.same_score_count, w.same_score_count) AS same_score_count, coalesce(e.cumulative_count, w.cumulative_count) AS cumulative_count
FROM p LEFT JOIN rank_fx e ON p.year = e.year AND p.province = e.province AND p.subject_type = e.subject_type AND p.q = e.score
LEFT JOIN rank_fx w ON p.year = w.year AND p.province = w.province AND p.subject_type = w.subject_type AND trunc(p.q) = w.score""")
def rank_of_score(t):
    requests = t.rank_fx.select(
        "year", "province", "subject_type", (F.col("score") + F.when(F.col("score") % 3 == 0, 0.5).otherwise(1.0)).cast("double").alias("q")
    ).distinct()
    return lookup.exact_or_whole_score(requests, t.rank_fx).select(*_REQUEST, "row.*")
