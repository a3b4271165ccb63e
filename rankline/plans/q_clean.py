"""Normalisation, validation and load (D, E, F)."""

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import load, normalize, observed, validate
from ..operators.tablelog import TableLog
from ..session import shared_folder, written
from . import sqlbits as q
from .inputs import define
from .q_text import _SPLIT
from .registry import query

_ID = ("src_order", "src_line", "src_supp")
_IDS = "src_order, src_line, src_supp"

define("typed_fx", """
SELECT n.src_order, n.src_line, n.src_supp, n.plan_count AS pc, n.code_raw, n.name_raw, n.major_raw, n.score_raw,
  CASE n.plan_count % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(1990 + n.src_line AS STRING) END AS year_raw,
  CASE n.src_line % 5 WHEN 0 THEN '江苏省' WHEN 1 THEN ' js ' WHEN 2 THEN '重庆市' WHEN 3 THEN '' ELSE '河南' END AS province_raw,
  CASE n.plan_count % 6 WHEN 0 THEN '理科综合' WHEN 1 THEN '首选历史' WHEN 2 THEN '不分文理' WHEN 3 THEN NULL WHEN 4 THEN '文史' ELSE '其他' END AS subject_raw,
  CASE n.plan_count % 5 WHEN 0 THEN '艺术本科' WHEN 1 THEN '提前批次' WHEN 2 THEN NULL WHEN 3 THEN '体育类' ELSE '第二段' END AS batch_raw,
  CASE n.src_line % 3 WHEN 0 THEN ' G1 ' ELSE '' END AS group_raw, CAST(n.plan_count AS STRING) || '.9' AS rank_raw,
  CASE n.plan_count % 3 WHEN 0 THEN ' 语数1 ' ELSE ' ' END AS tie_raw
FROM noise_fields n""")

_P = q.province("CASE WHEN trim(coalesce(province_raw, '')) = '' THEN '广东' ELSE province_raw END")
_SU = "coalesce(trim(subject_raw), '')"
_SUBJECT = q.alias(_SU, rules.SUBJECT_ALIASES, _SU)
_Y = "CAST(CASE WHEN coalesce(trim(year_raw), '') = '' THEN 2024 ELSE TRY_CAST(year_raw AS INT) END AS INT)"


def _typed(t):
    return t.typed_fx.withColumnsRenamed({
        "year_raw": "year", "province_raw": "province", "subject_raw": "subject_type", "score_raw": "min_score", "rank_raw": "min_rank",
        "code_raw": "school_code", "name_raw": "school_name", "major_raw": "major_name", "group_raw": "major_group", "tie_raw": "tie_breaker_text",
        "pc": "plan_count",
    }).withColumn("admission_category", F.col("batch_raw")).withColumn("batch", F.col("batch_raw")).drop("batch_raw")


@query("D1_defaults", f"SELECT {_IDS}, {_Y} AS year, {_P} AS province, {_SUBJECT} AS subject_type FROM typed_fx")
def defaults(t):
    df = normalize.defaulted(_typed(t), normalize.RANK[:3], year=2024, province="广东", keep=_ID)
    return df.select(*_ID, "year", "province", "subject_type")


@query("D2_standard_columns", f"SELECT {_IDS}, name_raw AS school_name, CAST(NULL AS VARCHAR) AS ownership FROM typed_fx")
def standard_columns(t):
    return normalize.project(_typed(t), ("school_name", "ownership"), keep=_ID)


_CAT = f"CASE WHEN coalesce(trim(batch_raw), '') = '' THEN '普通类' ELSE {q.alias('trim(batch_raw)', rules.CATEGORY_ALIASES, 'trim(batch_raw)')} END"
_BAT = f"CASE WHEN coalesce(trim(batch_raw), '') = '' THEN '本科批' ELSE {q.alias('trim(batch_raw)', rules.SCHOOL_BATCH_ALIASES, 'trim(batch_raw)')} END"
_MAJOR = """CASE WHEN trim(group_raw) <> '' THEN trim(group_raw) WHEN regexp_matches(major_raw, '^[0-9]{1,3}\\S.+$')
  THEN regexp_replace(major_raw, '^([0-9]{1,3})(\\S.+)$', '\\1-\\2') ELSE major_raw END"""
_SCHOOL = ("WITH " + _SPLIT.replace("FROM noise_fields", "FROM typed_fx") + f""",
f AS (SELECT *, {_CAT} AS cat, {_BAT} AS bat, {_MAJOR} AS grp, coalesce(code_out, name_out) AS code2,
        CASE WHEN code_out IS NOT NULL THEN name_out END AS name2 FROM split)
SELECT {_IDS}, {_Y} AS year, {_P} AS province, {_SUBJECT} AS subject_type, cat AS admission_category, bat AS batch, code2 AS school_code,
  CASE WHEN grp IS NOT NULL AND cat IN ('艺术类', '体育类') AND (name2 IS NULL OR name2 = code2) THEN grp ELSE name2 END AS school_name,
  grp AS major_group, {q.to_float('score_raw')} AS min_score, CAST(trunc(TRY_CAST(rank_raw AS DOUBLE)) AS INT) AS min_rank,
  nullif(trim(tie_raw), '') AS tie_breaker_text, CAST(pc AS INT) AS plan_count FROM f""").replace(
    "nullif(trim(name_raw), '') AS n", f"nullif({q.squeeze('trim(name_raw)')}, '') AS n")


@query("D3_normalize_school", _SCHOOL)
def normalize_school(t):
    return normalize.normalize_school(_typed(t), year=2024, province="广东", keep=_ID)


@query("D4_normalize_rank", f"""
SELECT {_IDS}, {_Y} AS year, {_P} AS province, '物理类' AS subject_type, TRY_CAST(trunc(TRY_CAST(trim(score_raw) AS DOUBLE)) AS INT) AS score,
  CAST(pc AS INT) AS same_score_count, CAST(trunc(CAST(rank_raw AS DOUBLE)) AS INT) AS cumulative_count FROM typed_fx""")
def normalize_rank(t):
    df = _typed(t).drop("subject_type").withColumnsRenamed({"min_score": "score", "plan_count": "same_score_count", "min_rank": "cumulative_count"})
    return normalize.normalize_rank(df, year=2024, province="广东", subject_type="理科", keep=_ID)


@query("D5_normalize_control", f"""
SELECT {_IDS}, {_Y} AS year, {_P} AS province, {_SUBJECT} AS subject_type,
  nullif({q.alias('trim(batch_raw)', rules.BATCH_ALIASES, 'trim(batch_raw)')}, '') AS batch, CAST(trunc(CAST(rank_raw AS DOUBLE)) AS INT) AS score FROM typed_fx""")
def normalize_control(t):
    df = _typed(t).withColumnRenamed("min_rank", "score")
    return normalize.normalize_control(df, year=2024, province="广东", keep=_ID)


_MAJORS = f"""
SELECT {_IDS}, {_Y} AS year, {_P} AS province, {_SUBJECT} AS subject_type, nullif({q.squeeze('trim(name_raw)')}, '') AS school_name,
  nullif(trim(major_raw), '') AS major_name, TRY_CAST(trunc(TRY_CAST(trim(score_raw) AS DOUBLE)) AS INT) AS min_score,
  CAST(trunc(CAST(rank_raw AS DOUBLE)) AS INT) AS min_rank FROM typed_fx"""


@query("D6_normalize_major", _MAJORS)
def normalize_major(t):
    return normalize.normalize_major(_typed(t), year=2024, province="广东", keep=_ID)


@query("D7_normalize_by_type", f"""
SELECT {_IDS}, 'major' AS record_type, school_name, province FROM ({_MAJORS}) m UNION ALL SELECT {_IDS}, 'school', school_name, province FROM ({_SCHOOL}) s""")
def normalize_by_type(t):
    parts = [
        normalize.normalize(_typed(t), kind, year=2024, province="广东", keep=_ID).select(*_ID, F.lit(kind).alias("record_type"), "school_name", "province")
        for kind in ("major", "school")
    ]
    return parts[0].unionByName(parts[1])


@query("D8_enrich_for_load", f"""
SELECT {_IDS}, 'f.xlsx' AS source_url, coalesce(nullif(batch_raw, ''), '普通类') AS admission_category, coalesce(nullif(batch_raw, ''), '本科批') AS batch,
  coalesce(nullif(code_raw, ''), name_raw) AS school_code, 'school' AS kind, CAST(NULL AS VARCHAR) AS major_code FROM typed_fx
UNION ALL SELECT {_IDS}, 'f.xlsx', batch_raw, coalesce(nullif(batch_raw, ''), '本科批'), coalesce(nullif(code_raw, ''), name_raw), 'major', major_raw FROM typed_fx""")
def enrich_for_load(t):
    school = normalize.enrich_for_load(_typed(t), "school", "f.xlsx").withColumn("kind", F.lit("school")).withColumn("major_code", F.lit(None).cast("string"))
    major = normalize.enrich_for_load(_typed(t), "major", "f.xlsx").withColumn("kind", F.lit("major"))
    cols = (*_ID, "source_url", "admission_category", "batch", "school_code", "kind", "major_code")
    return school.select(*cols).unionByName(major.select(*cols))


_ERROR = """CASE WHEN m <> '' THEN '缺少必填字段: ' || m WHEN min_score IS NULL AND min_rank IS NULL THEN '缺少 min_score 或 min_rank'
  WHEN min_score < 100 OR min_score > 750 THEN 'min_score 超出范围 [100, 750]: ' || CAST(min_score AS VARCHAR)
  WHEN trim(subject_type) NOT IN ('文科', '理科', '历史类', '物理类', '综合改革') THEN 'subject_type 无效: ' || trim(subject_type) END"""


def _missing(*names: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN trim(coalesce(CAST({n} AS VARCHAR), '')) = '' THEN '{n}' END" for n in names) + ")"


@query("D9_pipeline_stage_counts", f"""
WITH n AS ({_SCHOOL}), m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'school_name')} AS m FROM n), e AS (SELECT *, {_ERROR} AS error FROM m)
SELECT province, count(*) AS normalized, count(*) FILTER (error IS NULL) AS valid, count(error) AS failed FROM e GROUP BY province""")
def pipeline_stage_counts(t):
    rows = _typed(t).transform(lambda d: normalize.normalize_school(d, year=2024, province="广东")).transform(lambda d: validate.checked(d, "school"))
    return rows.groupBy("province").agg(
        F.count("*").alias("normalized"), F.count_if(F.col("error").isNull()).alias("valid"), F.count("error").alias("failed")
    )


@query("D9_counts_of_the_writing_pass", f"""
WITH n AS ({_SCHOOL}), m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'school_name')} AS m FROM n), e AS (SELECT *, {_ERROR} AS error FROM m)
SELECT count(*) AS parsed, count(*) AS normalized, count(*) FILTER (error IS NULL) AS valid, count(error) AS failed, count(*) FILTER (error IS NULL) AS rows_stored FROM e""")
def counts_of_the_writing_pass(t):
    raw = _typed(t)
    schema = normalize.normalize_school(raw.limit(0), year=2024, province="广东").schema
    log = TableLog(t.spark, shared_folder(t.spark) + "/schools", schema)
    counts = observed.school_rows_loaded(raw, log, "one", year=2024, province="广东")
    return counts.withColumn("rows_stored", log.live().agg(F.sum("rows")).scalar())


@query("D10_province_defaults", f"""
WITH p AS (SELECT *, {q.province('province_raw')} AS pv FROM typed_fx), d AS (SELECT *, nullif(trim(subject_raw), '') AS s FROM p)
SELECT {_IDS}, pv AS province, CASE WHEN pv = '河南' THEN CASE WHEN s LIKE '%文科%' THEN '文科' WHEN s LIKE '%理科%' THEN '理科' ELSE coalesce(s, '') END
  ELSE {_SUBJECT} END AS subject_type FROM d""")
def province_defaults(t):
    df = normalize.with_province_defaults(_typed(t))
    return normalize.normalize_school(df, legacy=F.col("legacy"), keep=_ID).select(*_ID, "province", "subject_type")


# ---- validation ----

define("school_dirty", """
SELECT src_order, src_line, src_supp, CAST(year * 10 + length(province) AS BIGINT) AS file_id, school_code, admission_category, batch, major_group, min_rank, plan_count,
  CASE WHEN plan_count % 17 = 3 THEN NULL ELSE year END AS year, CASE WHEN plan_count % 13 = 5 THEN ' ' ELSE province END AS province,
  CASE plan_count % 11 WHEN 4 THEN '其他' WHEN 5 THEN NULL ELSE subject_type END AS subject_type,
  CASE WHEN plan_count % 19 = 7 THEN '' ELSE school_name END AS school_name, CASE WHEN plan_count % 7 = 2 THEN NULL ELSE min_score END AS min_score,
  '专业' || CAST(plan_count AS STRING) AS major_name FROM school_raw""")


@query("E1_school_row_errors", f"WITH m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'school_name')} AS m FROM school_dirty) SELECT {_IDS}, {_ERROR} AS error FROM m")
def school_row_errors(t):
    return validate.checked(t.school_dirty, "school").select(*_ID, "error")


_SUBJECT_ERROR = "CASE WHEN m <> '' THEN '缺少必填字段: ' || m WHEN trim(subject_type) NOT IN ('文科', '理科', '历史类', '物理类', '综合改革') THEN 'subject_type 无效: ' || trim(subject_type) END"
_RANK_DIRTY = "SELECT {ids}, year, province, subject_type, min_score AS score, min_rank AS cumulative_count FROM school_dirty"


@query("E2_rank_row_errors", f"""
WITH r AS ({_RANK_DIRTY.format(ids=_IDS)}), m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'score', 'cumulative_count')} AS m FROM r)
SELECT {_IDS}, {_SUBJECT_ERROR} AS error FROM m""")
def rank_row_errors(t):
    df = t.school_dirty.withColumnsRenamed({"min_score": "score", "min_rank": "cumulative_count"})
    return validate.checked(df, "rank").select(*_ID, "error")


@query("E3_control_row_errors", f"""
WITH r AS (SELECT *, min_score AS score FROM school_dirty), m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'batch', 'score')} AS m FROM r)
SELECT {_IDS}, {_SUBJECT_ERROR} AS error FROM m""")
def control_row_errors(t):
    return validate.checked(t.school_dirty.withColumn("score", F.col("min_score")), "control").select(*_ID, "error")


@query("E4_major_row_errors", f"""
WITH m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'school_name', 'major_name', 'min_score')} AS m FROM school_dirty)
SELECT {_IDS}, CASE WHEN m <> '' THEN '缺少必填字段: ' || m WHEN min_score < 100 OR min_score > 750 THEN 'min_score 超出范围 [100, 750]: ' || CAST(min_score AS VARCHAR) END AS error FROM m""")
def major_row_errors(t):
    return validate.checked(t.school_dirty, "major").select(*_ID, "error")


@query("E5_falling_counts", """
SELECT * FROM (SELECT year, province, subject_type, CAST(score AS INT) AS score, cumulative_count,
  lag(cumulative_count) OVER (PARTITION BY year, province, subject_type ORDER BY score DESC) AS previous_count FROM rank_bad WHERE cumulative_count IS NOT NULL) x
WHERE cumulative_count < previous_count""")
def falling_counts(t):
    return validate.falling_counts(t.rank_bad)


define("rank_file", """
SELECT CAST(year * 10 + length(province) AS BIGINT) AS file_id, CAST(row_number() OVER (PARTITION BY year * 10 + length(province) ORDER BY province, subject_type, score DESC) AS INT) AS row_idx,
  year, province, CASE WHEN score % 23 = 0 THEN '其他' ELSE subject_type END AS subject_type, score, same_score_count, cumulative_count FROM rank_bad""")
_RERR = f"m AS (SELECT *, {_missing('year', 'province', 'subject_type', 'score', 'cumulative_count')} AS m FROM rank_file), e AS (SELECT *, {_SUBJECT_ERROR} AS error FROM m)"


@query("E6_errors_with_row_numbers", f"WITH {_RERR} SELECT file_id, CAST(row_idx AS BIGINT) AS row_num, '第 ' || row_idx || ' 行' || error AS message FROM e WHERE error IS NOT NULL")
def errors_with_row_numbers(t):
    _, errors = validate.split_valid(t.rank_file, "rank", "file_id", "row_idx")
    return errors


@query("E6_failed_counts", f"""
WITH {_RERR}, f AS (SELECT file_id, count(*) AS falls FROM (SELECT file_id, cumulative_count, lag(cumulative_count) OVER (PARTITION BY file_id, year, province, subject_type ORDER BY score DESC) AS p
  FROM e WHERE error IS NULL) x WHERE cumulative_count < p GROUP BY file_id),
s AS (SELECT file_id, count(*) FILTER (error IS NULL) AS valid, count(error) AS row_errors FROM e GROUP BY file_id)
SELECT s.file_id, valid, row_errors, row_errors + coalesce(falls, 0) AS failed_count FROM s LEFT JOIN f USING (file_id)""")
def failed_counts(t):
    return validate.failed_counts(t.rank_file, "rank", "file_id")


# ---- load ----

define("school_stored", "SELECT * FROM school_fx WHERE plan_count > 40")
define("school_batch", """
SELECT src_order, src_line, src_supp, year, province, school_name, school_code, subject_type, admission_category, batch, major_group,
  CASE WHEN src_supp % 11 = 3 THEN 'broken' ELSE CAST(min_score AS STRING) END AS min_score, CAST(min_rank AS STRING) AS min_rank, CAST(plan_count AS STRING) AS plan_count,
  CAST(year * 10 + length(province) AS BIGINT) AS file_id FROM school_raw""")
_ORDER = ["src_order", "src_line", "src_supp", "min_score", "min_rank", "plan_count"]
_OSQL = "src_order, src_line, src_supp, min_score NULLS FIRST, min_rank NULLS FIRST, plan_count"
_SKEY = "year, province, school_code, subject_type, admission_category, batch, coalesce(major_group, '')"
_LOG = f"""
k AS (SELECT *, coalesce(major_group, '') AS g, coalesce(min_score = 'broken', false) AS bad, row_number() OVER (PARTITION BY {_SKEY} ORDER BY {_OSQL}) AS rn FROM school_batch),
w AS (SELECT *, min(rn) FILTER (NOT bad) OVER (PARTITION BY {_SKEY}) AS win FROM k),
o AS (SELECT w.*, CASE WHEN s.year IS NOT NULL THEN 'skipped' WHEN rn = win THEN 'inserted' WHEN rn > win THEN 'skipped' ELSE 'failed' END AS outcome
  FROM w LEFT JOIN school_stored s ON w.year = s.year AND w.province = s.province AND w.school_code = s.school_code AND w.subject_type = s.subject_type
   AND w.admission_category = s.admission_category AND w.batch = s.batch AND w.g = coalesce(s.major_group, ''))"""


_F2 = f"""WITH {_LOG} SELECT year, province, school_code, subject_type, admission_category, batch, major_group, CAST(min_score AS DOUBLE) AS min_score,
 CAST(min_rank AS INT) AS min_rank, CAST(plan_count AS INT) AS plan_count FROM o WHERE outcome = 'inserted'"""


@query("F2_append_schools", _F2)
def append_schools(t):
    fresh = load.new_rows(t.school_batch, t.school_stored, "school", _ORDER)
    return fresh.select("year", "province", "school_code", "subject_type", "admission_category", "batch", "major_group", "min_score", "min_rank", "plan_count")


@query("F5_load_statistics", f"""WITH {_LOG} SELECT file_id, count(*) FILTER (outcome = 'inserted') AS inserted, count(*) FILTER (outcome = 'skipped') AS skipped,
 count(*) FILTER (outcome = 'failed') AS failed FROM o GROUP BY file_id""")
def load_statistics(t):
    return load.load_statistics(load.outcomes(t.school_batch, t.school_stored, "school", _ORDER), "file_id")


@query("F5_merged_statistics", f"""WITH {_LOG} SELECT file_id % 10 AS part, count(*) FILTER (outcome = 'inserted') AS inserted, count(*) FILTER (outcome = 'skipped') AS skipped,
 count(*) FILTER (outcome = 'failed') AS failed FROM o GROUP BY 1""")
def merged_statistics(t):
    """Statistics of the files of two loads, merged over both."""
    per_file = load.load_statistics(load.outcomes(t.school_batch, t.school_stored, "school", _ORDER), "file_id").withColumn("part", F.col("file_id") % 10)
    return load.merge_statistics(per_file.where("file_id % 2 = 0"), per_file.where("file_id % 2 = 1"), by=("part",))


define("control_batch", """
SELECT CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_custkey % 2 = 0 THEN 'EAST' ELSE 'WEST' END AS province,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN '物理类' ELSE '历史类' END AS subject_type, CASE o_orderstatus WHEN 'F' THEN '本科批' WHEN 'O' THEN NULL ELSE ' 提前批 ' END AS batch,
  CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_totalprice AS STRING) END AS score, o_orderkey AS row_no, o_totalprice AS price FROM {orders}""")
define("control_stored", "SELECT DISTINCT year, province, subject_type, '提前批' AS batch, 1.0 AS score FROM control_batch WHERE subject_type = '物理类'")


_F1 = """
WITH g AS (SELECT *, coalesce(trim(batch), '') AS b, row_number() OVER (PARTITION BY year, province, subject_type, coalesce(trim(batch), '') ORDER BY row_no) AS rn FROM control_batch WHERE score <> 'x')
SELECT year, province, subject_type, b AS batch, CAST(score AS DOUBLE) AS score FROM g WHERE rn = 1
 AND NOT EXISTS (SELECT 1 FROM control_stored s WHERE s.year = g.year AND s.province = g.province AND s.subject_type = g.subject_type AND s.batch = g.b)"""


@query("F1_append_controls", _F1)
def append_controls(t):
    return load.new_rows(t.control_batch, t.control_stored, "control", ["row_no"]).select("year", "province", "subject_type", "batch", "score")


define("major_batch", """
SELECT src_order, src_line, src_supp, year, province, school_name, school_code, '专业' || CAST(plan_count % 7 AS STRING) AS major_name, 'M' || CAST(plan_count % 5 AS STRING) AS major_code,
  subject_type, major_group, min_score, min_rank, plan_count FROM school_raw""")
define("major_stored", "SELECT DISTINCT year, province, school_name, major_name, subject_type, major_group FROM major_batch WHERE plan_count % 7 = 3")


_F3 = """
WITH g AS (SELECT *, row_number() OVER (PARTITION BY year, province, school_name, major_name, subject_type, coalesce(major_group, '')
    ORDER BY src_order, src_line, src_supp, min_score NULLS FIRST, min_rank NULLS FIRST, plan_count) AS rn FROM major_batch WHERE min_score IS NOT NULL)
SELECT year, province, school_name, major_name, subject_type, major_group, min_score, min_rank FROM g WHERE rn = 1 AND major_name <> '专业3'"""


@query("F3_append_majors", _F3)
def append_majors(t):
    fresh = load.new_rows(t.major_batch, t.major_stored, "major", ["src_order", "src_line", "src_supp", "min_score", "min_rank", "plan_count"])
    return fresh.select("year", "province", "school_name", "major_name", "subject_type", "major_group", "min_score", "min_rank")


@query("F3_major_code_conflicts", """
SELECT year, province, school_code, major_code, subject_type, coalesce(major_group, '') AS major_group, count(DISTINCT (school_name, major_name)) AS names FROM major_batch
GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(DISTINCT (school_name, major_name)) > 1""")
def major_code_conflicts(t):
    return load.code_conflicts(t.major_batch)


define("rank_batch", """
SELECT year, province, subject_type, score, same_score_count, cumulative_count, 1 AS part FROM rank_bad
UNION ALL SELECT year, province, subject_type, score, same_score_count, 7, 2 FROM rank_fx""")
define("rank_stored", "SELECT * FROM rank_fx WHERE score % 4 = 0")


_F4 = """
SELECT year, province, subject_type, CAST(score AS DOUBLE) AS score, same_score_count, CAST(coalesce(cumulative_count, 7) AS INT) AS cumulative_count FROM rank_bad WHERE score % 4 <> 0"""


@query("F4_append_ranks", _F4)
def append_ranks(t):
    return load.new_rows(t.rank_batch, t.rank_stored, "rank", ["part"]).select("year", "province", "subject_type", "score", "same_score_count", "cumulative_count")


# ---- the write half: a batch is appended, appended again, and the table read back ----

def _stored_keys(stored, record_type):
    """All that loads read of the stored rows, on disk before they begin: what it takes to work them out does not lie beside the shuffles of a load."""
    return written(stored.select(*load.KEYS[record_type]))


def _appended_twice(t, batch, stored, record_type, order):
    path = shared_folder(t.spark) + "/table"
    stored = _stored_keys(stored, record_type)
    fresh = written(load.new_rows(batch, stored, record_type, order))
    load.append_table(fresh, path)
    appended = t.spark.read.schema(fresh.schema).parquet(path)
    both = stored.unionByName(appended.select(*load.KEYS[record_type]))
    load.append_table(load.new_rows(batch, both, record_type, order), path)
    return t.spark.read.schema(fresh.schema).parquet(path)


@query("F1_append_controls_twice", _F1)
def append_controls_twice(t):
    return _appended_twice(t, t.control_batch, t.control_stored, "control", ["row_no"]).select("year", "province", "subject_type", "batch", "score")


@query("F2_append_schools_twice", _F2)
def append_schools_twice(t):
    t = t.kept("school_raw")  # the batch and the stored rows come from it
    back = _appended_twice(t, t.school_batch, t.school_stored, "school", _ORDER)
    return back.select("year", "province", "school_code", "subject_type", "admission_category", "batch", "major_group", "min_score", "min_rank", "plan_count")


@query("F3_append_majors_twice", _F3)
def append_majors_twice(t):
    back = _appended_twice(t, t.major_batch, t.major_stored, "major", ["src_order", "src_line", "src_supp", "min_score", "min_rank", "plan_count"])
    return back.select("year", "province", "school_name", "major_name", "subject_type", "major_group", "min_score", "min_rank")


@query("F4_append_ranks_twice", _F4)
def append_ranks_twice(t):
    back = _appended_twice(t, t.rank_batch, t.rank_stored, "rank", ["part"])
    return back.select("year", "province", "subject_type", "score", "same_score_count", "cumulative_count")


# ---- the same batches through a logged table: an attempt that died half-way, the batch, and the batch again ----

def _appended_after_failure(t, batch, stored, record_type, order, columns):
    fresh = written(load.new_rows(batch, _stored_keys(stored, record_type), record_type, order).select(*columns))  # read by both attempts
    log = TableLog(t.spark, shared_folder(t.spark) + "/table", fresh.schema)
    log.write_attempt(fresh.where(F.pmod(F.xxhash64(*load.KEYS[record_type]), F.lit(2)) == 0), files=2)  # its commit never came
    log.append(fresh, "batch 1")
    log.append(fresh, "batch 1")
    return log.read()


_F1_COLS = ("year", "province", "subject_type", "batch", "score")
_F2_COLS = ("year", "province", "school_code", "subject_type", "admission_category", "batch", "major_group", "min_score", "min_rank", "plan_count")
_F3_COLS = ("year", "province", "school_name", "major_name", "subject_type", "major_group", "min_score", "min_rank")
_F4_COLS = ("year", "province", "subject_type", "score", "same_score_count", "cumulative_count")


@query("F1_append_controls_after_failure", _F1)
def append_controls_after_failure(t):
    return _appended_after_failure(t, t.control_batch, t.control_stored, "control", ["row_no"], _F1_COLS)


@query("F2_append_schools_after_failure", _F2)
def append_schools_after_failure(t):
    t = t.kept("school_raw")  # the batch and the stored rows come from it
    return _appended_after_failure(t, t.school_batch, t.school_stored, "school", _ORDER, _F2_COLS)


@query("F3_append_majors_after_failure", _F3)
def append_majors_after_failure(t):
    order = ["src_order", "src_line", "src_supp", "min_score", "min_rank", "plan_count"]
    return _appended_after_failure(t, t.major_batch, t.major_stored, "major", order, _F3_COLS)


@query("F4_append_ranks_after_failure", _F4)
def append_ranks_after_failure(t):
    return _appended_after_failure(t, t.rank_batch, t.rank_stored, "rank", ["part"], _F4_COLS)


# Batch rows keep, change or add schools; every third one is known by its school name only.
define("meta_full", "SELECT school_name, standard_name, 'P' AS province, city, is_985, is_211, is_double_first_class, school_type, CAST(NULL AS STRING) AS ownership, 'seed' AS source FROM meta_fx")
define("meta_stored", """
SELECT min(school_name) AS school_name, standard_name, min(province) AS province, min(city) AS city, bool_or(is_985) AS is_985, bool_or(is_211) AS is_211,
  bool_or(is_double_first_class) AS is_double_first_class, min(school_type) AS school_type, min(ownership) AS ownership, min(source) AS source
FROM meta_full WHERE city <> 'CITY_X' GROUP BY standard_name""")
define("meta_batch", """
SELECT row_no, school_name, CASE row_no % 3 WHEN 0 THEN standard_name || ' new' ELSE standard_name END AS standard_name, province,
  CASE row_no % 3 WHEN 1 THEN city ELSE 'MOVED' END AS city, is_985, is_211, is_double_first_class, school_type, ownership, source FROM (
  SELECT m.*, row_number() OVER (ORDER BY standard_name) AS row_no FROM meta_stored m) x
UNION ALL SELECT 1000 + length(standard_name), 'U ' || standard_name, 'U ' || standard_name, 'P', NULL, false, false, false, NULL, NULL, 'seed' FROM meta_stored WHERE length(standard_name) = 9""")
_UP = """
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY standard_name ORDER BY row_no DESC) AS rn FROM meta_batch) x WHERE rn = 1),
hits AS (SELECT b.*, coalesce((SELECT s.standard_name FROM meta_stored s WHERE s.standard_name = b.standard_name), (SELECT max(s.standard_name) FROM meta_stored s WHERE s.school_name = b.school_name),
   (SELECT max(s.standard_name) FROM meta_stored s WHERE s.school_name = b.standard_name), (SELECT max(s.standard_name) FROM meta_stored s WHERE s.standard_name = b.school_name)) AS target FROM b),
log AS (SELECT h.*, CASE WHEN target IS NULL THEN 'inserted' WHEN h.city IS NOT DISTINCT FROM s.city AND h.standard_name = s.standard_name AND h.school_name = s.school_name
   AND h.school_type IS NOT DISTINCT FROM s.school_type THEN 'skipped' ELSE 'updated' END AS outcome FROM hits h LEFT JOIN meta_stored s ON s.standard_name = h.target)"""


@query("F6_upsert_metadata", f"""
WITH {_UP} SELECT school_name, standard_name, city, school_type FROM log
UNION ALL SELECT school_name, standard_name, city, school_type FROM meta_stored s WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.target = s.standard_name)""")
def upsert_metadata(t):
    return load.upsert_metadata(t.meta_stored, t.meta_batch, ["row_no"]).table.select("school_name", "standard_name", "city", "school_type")


@query("F6_upsert_outcomes", f"WITH {_UP} SELECT standard_name, outcome FROM log")
def upsert_outcomes(t):
    return load.upsert_metadata(t.meta_stored, t.meta_batch, ["row_no"]).log.select("standard_name", "outcome")


@query("F7_equal_rows", """
SELECT b.standard_name, b.city IS NOT DISTINCT FROM s.city AND b.school_type IS NOT DISTINCT FROM s.school_type AND b.school_name = s.school_name AS same
FROM meta_batch b JOIN meta_stored s USING (standard_name)""")
def equal_rows(t):
    both = t.meta_batch.alias("b").join(t.meta_stored.alias("s"), "standard_name")
    cols = [c for c in load.METADATA if c != "standard_name"]
    same = F.struct(*[F.col(f"b.{c}") for c in cols]).eqNullSafe(F.struct(*[F.col(f"s.{c}") for c in cols]))
    return both.select("standard_name", same.alias("same"))


define("school_blank", """
SELECT s.*, CASE plan_count % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE admission_category END AS cat_raw, CASE plan_count % 3 WHEN 0 THEN ' ' ELSE batch END AS batch_raw FROM school_raw s""")


@query("F9_backfill", """
SELECT src_order, src_line, src_supp, CASE WHEN plan_count % 4 IN (0, 1) THEN '普通类' ELSE admission_category END AS admission_category,
  CASE WHEN plan_count % 3 = 0 THEN '本科批' ELSE batch END AS batch FROM school_blank""")
def backfill(t):
    df = t.school_blank.withColumn("admission_category", F.col("cat_raw")).withColumn("batch", F.col("batch_raw"))
    return load.backfill(df).select(*_ID, "admission_category", "batch")




def _sourced(t):
    return t.school_sourced.withColumn("school_name", F.col("shown_name"))


_DCOLS = ("year", "province", "school_code", "subject_type", "major_group", "source_url")
_BADNAME = "starts_with(source_url, 'ocr_experimental:') AND NOT regexp_matches(shown_name, '..') OR (starts_with(source_url, 'ocr_experimental:') AND NOT regexp_matches(shown_name, '[一-鿿]'))"


@query("F10_dirty_flag", f"SELECT {', '.join(_DCOLS)}, plan_count, {_BADNAME} AS dirty FROM school_sourced")
def dirty_flag(t):
    return _sourced(t).select(*_DCOLS, "plan_count", load.is_dirty().alias("dirty"))


@query("F11_dirty_rows", f"SELECT {', '.join(_DCOLS)} FROM school_sourced WHERE province = 'ASIA' AND ({_BADNAME})")
def dirty_rows(t):
    return load.dirty_rows(_sourced(t), province="ASIA").select(*_DCOLS)


@query("F12_dirty_by_source", f"SELECT source_url, count(*) AS n FROM school_sourced WHERE {_BADNAME} GROUP BY source_url ORDER BY n DESC, source_url")
def dirty_by_source(t):
    return load.dirty_by_source(_sourced(t))


@query("F12_rows_after_cleanup", f"SELECT {', '.join(_DCOLS)} FROM school_sourced WHERE NOT (province = 'ASIA' AND ({_BADNAME}))")
def rows_after_cleanup(t):
    return load.without_dirty(_sourced(t), province="ASIA").select(*_DCOLS)


@query("F12_dirty_samples", f"""SELECT {', '.join(_DCOLS)} FROM school_sourced WHERE {_BADNAME}
ORDER BY year, province, school_code, subject_type, admission_category, batch, major_group NULLS FIRST LIMIT 20""")
def dirty_samples(t):
    order = ["year", "province", "school_code", "subject_type", "admission_category", "batch", "major_group"]
    return load.dirty_samples(_sourced(t), order).select(*_DCOLS)


# ---- clean-up and backfill in place: only files that hold such a row are rewritten ----

def _cleaned(t):
    rows = _sourced(t).select(*_DCOLS, "school_name", "admission_category", "batch", "plan_count")
    log = TableLog(t.spark, shared_folder(t.spark) + "/schools", rows.schema)
    log.append(rows, "load")
    before = log.live()
    scope = load.is_dirty() & (F.col("province") == "ASIA")
    for _ in range(2):  # the second time the log knows the change
        report = log.rewrite("clean-up", F.coalesce(scope, F.lit(False)), lambda df: load.without_dirty(df, province="ASIA"))
    return log, before, report


@query("F12_deleted_in_place", f"SELECT {', '.join(_DCOLS)}, plan_count FROM school_sourced WHERE NOT (province = 'ASIA' AND ({_BADNAME}))")
def deleted_in_place(t):
    log, _, _ = _cleaned(t)
    return log.read().select(*_DCOLS, "plan_count")


@query("F12_files_touched", f"SELECT count(*) AS rows_deleted, true AS all_in_scope, true AS others_untouched FROM school_sourced WHERE province = 'ASIA' AND ({_BADNAME})")
def files_touched(t):
    log, before, report = _cleaned(t)
    stays = F.contains("file", F.lit("province=ASIA/"))
    gone = log.entries().where("action = 'remove'").agg(F.bool_and(stays)).scalar()
    others = before.where(~stays).join(log.live(), "file", "left_anti").agg(F.count("*") == 0).scalar()
    return report.select((F.col("rows_before") - F.col("rows_after")).alias("rows_deleted"), gone.alias("all_in_scope"), (others & (F.col("files_untouched") > 0)).alias("others_untouched"))


@query("F9_backfilled_in_place", """
SELECT src_order, src_line, src_supp, CASE WHEN plan_count % 4 IN (0, 1) THEN '普通类' ELSE admission_category END AS admission_category,
  CASE WHEN plan_count % 3 = 0 THEN '本科批' ELSE batch END AS batch FROM school_blank""")
def backfilled_in_place(t):
    rows = t.school_blank.withColumn("admission_category", F.col("cat_raw")).withColumn("batch", F.col("batch_raw")).select(*_ID, "year", "province", "admission_category", "batch")
    log = TableLog(t.spark, shared_folder(t.spark) + "/schools", rows.schema)
    log.append(rows, "load")
    log.rewrite("backfill", load.is_blank(), load.backfill)
    return log.read().select(*_ID, "admission_category", "batch")
