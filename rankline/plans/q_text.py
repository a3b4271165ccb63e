"""Scalar rules on noisy cells and titles."""

from pyspark.sql import functions as F

from ..functions import rules, text, titles
from ..operators import keywords
from . import sqlbits as q
from .inputs import define
from .registry import query

_ID = ("src_order", "src_line", "src_supp")
_IDS = "src_order, src_line, src_supp"

define("noise_fields", """
SELECT src_order, src_line, src_supp, plan_count, score_raw, name_raw, school_name, school_code, min_score, min_rank,
  CASE plan_count % 3 WHEN 0 THEN NULL WHEN 1 THEN school_code ELSE 'B0123清华大学' END AS code_raw,
  CASE src_line % 4 WHEN 0 THEN CAST(plan_count AS STRING) || '文科试验班类' WHEN 1 THEN '法学' WHEN 2 THEN NULL ELSE '1234' END AS major_raw,
  CASE src_line % 3 WHEN 0 THEN '武汉大学第0' || CAST(src_line AS STRING) || '组' WHEN 1 THEN '北京大学A' || CAST(plan_count AS STRING) || '组' ELSE ' 北京大学 ' END AS group_raw,
  CASE src_line % 4 WHEN 0 THEN 'A00' || CAST(100 + plan_count AS STRING) || ' 北京大学 第05组 化 ' || CAST(CAST(coalesce(min_score, 691) AS INT) AS STRING)
     WHEN 1 THEN 'B' || CAST(1000 + plan_count AS STRING) || ' 清华大学第' || CAST(src_line AS STRING) || '组 不限 690 120 医学类专业'
     WHEN 2 THEN '说明文字' ELSE 'C001 某大学 化生 0' || CAST(10 + plan_count AS STRING) END AS line_raw,
  CASE plan_count % 4 WHEN 0 THEN '本科批' WHEN 1 THEN ' ' ELSE NULL END AS batch_given,
  CASE src_line % 3 WHEN 0 THEN '专科投档' WHEN 1 THEN 'page' ELSE '' END AS file_raw,
  CASE plan_count % 5 WHEN 0 THEN '高职高专普通批' WHEN 1 THEN '本科普通批 首选物理' WHEN 2 THEN '历史科目' ELSE '' END AS title_raw,
  CASE plan_count % 6 WHEN 0 THEN '1' WHEN 1 THEN ' Yes ' WHEN 2 THEN '是' WHEN 3 THEN '0' WHEN 4 THEN NULL ELSE 'no' END AS flag_raw,
  CASE src_line % 3 WHEN 0 THEN 'ocr_experimental:/a/' || school_code WHEN 1 THEN 'x/2023/school/' || school_code || '.xlsx' ELSE NULL END AS source_raw
FROM school_noise""")


@query("C1_missing_values", f"SELECT {_IDS}, CASE WHEN trim(province_raw) <> '' THEN province_raw END AS province, min_score FROM school_noise")
def missing_values(t):
    return t.school_noise.select(*_ID, text.missing_to_null(F.col("province_raw")).alias("province"), text.nan_to_null(F.col("min_score")).alias("min_score"))


@query("C2_to_int", f"SELECT {_IDS}, TRY_CAST(trunc(TRY_CAST(trim(score_raw) AS DOUBLE)) AS INT) AS v FROM school_noise")
def to_int(t):
    return t.school_noise.select(*_ID, text.to_int(F.col("score_raw")).alias("v"))


@query("C3_to_float", f"SELECT {_IDS}, {q.to_float('score_raw')} AS v FROM school_noise")
def to_float(t):
    return t.school_noise.select(*_ID, text.to_float(F.col("score_raw")).alias("v"))


@query("C4_to_text", f"SELECT {_IDS}, nullif(trim(province_raw), '') AS v, nullif(trim(score_raw), '') AS w FROM school_noise")
def to_text(t):
    return t.school_noise.select(*_ID, text.text_or_null(F.col("province_raw")).alias("v"), text.text_or_null(F.col("score_raw")).alias("w"))


@query("C5_score_cell", f"SELECT {_IDS}, coalesce({q.to_float('score_raw')}, {q.digits('score_raw')}) AS v FROM school_noise")
def score_cell(t):
    return t.school_noise.select(*_ID, text.score_cell(F.col("score_raw")).alias("v"))


@query("C6_count_cell", f"SELECT {_IDS}, {q.digits('score_raw')} AS v, {q.digits('name_raw')} AS w FROM school_noise")
def count_cell(t):
    return t.school_noise.select(*_ID, text.digits_only(F.col("score_raw")).alias("v"), text.digits_only(F.col("name_raw")).alias("w"))


@query("C7_province_name", f"SELECT {_IDS}, {q.province('province_raw')} AS v FROM school_noise")
def province_name(t):
    return t.school_noise.select(*_ID, rules.province_name(F.col("province_raw")).alias("v"))


_T = "coalesce(trim(subject_raw), '')"


@query("C8_subject_name", f"""SELECT {_IDS}, {q.alias(_T, rules.SUBJECT_ALIASES, _T)} AS v,
  CASE WHEN contains({_T}, '文科') THEN '文科' WHEN contains({_T}, '理科') THEN '理科' ELSE {_T} END AS legacy FROM school_noise""")
def subject_name(t):
    return t.school_noise.select(
        *_ID, rules.subject_name(F.col("subject_raw")).alias("v"), rules.subject_name(F.col("subject_raw"), F.lit(True)).alias("legacy")
    )


@query("C9_batch_name", f"SELECT {_IDS}, {q.alias('trim(batch_raw)', rules.BATCH_ALIASES, 'trim(batch_raw)')} AS v FROM school_noise")
def batch_name(t):
    return t.school_noise.select(*_ID, rules.batch_name(F.col("batch_raw")).alias("v"))


@query("C10_school_batch_name", f"SELECT {_IDS}, {q.alias('trim(batch_raw)', rules.SCHOOL_BATCH_ALIASES, 'trim(batch_raw)')} AS v FROM school_noise")
def school_batch_name(t):
    return t.school_noise.select(*_ID, rules.school_batch_name(F.col("batch_raw")).alias("v"))


_BN = "trim(batch_raw || name_raw)"


@query("C11_category_name", f"SELECT {_IDS}, {q.alias(_BN, rules.CATEGORY_ALIASES, _BN)} AS v FROM school_noise")
def category_name(t):
    return t.school_noise.select(*_ID, rules.category_name(F.concat("batch_raw", "name_raw")).alias("v"))


@query("C12_school_name", f"SELECT {_IDS}, {q.squeeze('trim(name_raw)')} AS v FROM school_noise")
def school_name(t):
    return t.school_noise.select(*_ID, text.school_name(F.col("name_raw")).alias("v"))


@query("C13_valid_school_name", f"SELECT {_IDS}, {q.valid_name('name_raw')} AS valid, NOT {q.valid_name('name_raw')} AS invalid FROM school_noise")
def valid_school_name(t):
    return t.school_noise.select(
        *_ID, text.valid_school_name(F.col("name_raw")).alias("valid"), text.invalid_school_name(F.col("name_raw")).alias("invalid")
    )


_SPLIT = f"""
s AS (SELECT *, nullif(trim(code_raw), '') AS c, nullif(trim(name_raw), '') AS n FROM noise_fields),
p AS (SELECT *, regexp_extract(c, '^([A-Za-z][0-9]{{3,4}})(.+)$', 1) AS c1, trim(regexp_extract(c, '^([A-Za-z][0-9]{{3,4}})(.+)$', 2)) AS c2,
        regexp_extract(n, '^([A-Za-z][0-9]{{3,4}})(.+)$', 1) AS n1, trim(regexp_extract(n, '^([A-Za-z][0-9]{{3,4}})(.+)$', 2)) AS n2 FROM s),
k AS (SELECT *, CASE WHEN coalesce({q.valid_name('n')}, false) AND c IS NOT NULL AND c1 = '' THEN 'keep'
        WHEN coalesce({q.valid_name('c2')}, false) THEN 'code' WHEN coalesce({q.valid_name('n2')}, false) THEN 'name' ELSE 'none' END AS how FROM p),
split AS (SELECT *, CASE how WHEN 'code' THEN c1 WHEN 'name' THEN n1 ELSE c END AS code_out,
        {q.squeeze("CASE how WHEN 'code' THEN c2 WHEN 'name' THEN n2 ELSE n END")} AS name_out FROM k)"""


@query("C14_split_school", f"WITH {_SPLIT} SELECT {_IDS}, code_out, name_out FROM split")
def split_school(t):
    split = text.with_split_school(t.noise_fields, "code_raw", "name_raw", "code_out", "name_out")
    return split.select(*_ID, "code_out", "name_out")


@query("C15_split_major", f"""
SELECT {_IDS}, CASE WHEN major_raw ~ '^[0-9]{{1,3}}\\S.+$' THEN regexp_extract(major_raw, '^([0-9]{{1,3}})(\\S.+)$', 1) END AS code_out,
  CASE WHEN major_raw ~ '^[0-9]{{1,3}}\\S.+$' THEN regexp_extract(major_raw, '^([0-9]{{1,3}})(\\S.+)$', 2) ELSE major_raw END AS name_out FROM noise_fields
""".replace("major_raw ~ '^[0-9]{1,3}\\S.+$'", "regexp_matches(major_raw, '^[0-9]{1,3}\\S.+$')"))
def split_major(t):
    code, name = text.split_major(F.lit(None).cast("string"), F.col("major_raw"))
    return t.noise_fields.select(*_ID, code.alias("code_out"), name.alias("name_out"))


@query("C16_split_group", f"""
SELECT {_IDS}, coalesce(nullif(regexp_extract(trim(group_raw), '^(.+?)(第[0-9]+组|[A-Za-z]?[0-9]+组)$', 1), ''), trim(group_raw)) AS school_out,
  regexp_extract(trim(group_raw), '^(.+?)(第[0-9]+组|[A-Za-z]?[0-9]+组)$', 2) AS group_out FROM noise_fields""")
def split_group(t):
    school, group = text.split_group(F.col("group_raw"))
    return t.noise_fields.select(*_ID, school.alias("school_out"), group.alias("group_out"))


@query("C17_row_line", f"""
SELECT {_IDS}, 'A00' || (100 + plan_count) AS school_code, '北京大学' AS school_name, '第05组' AS major_group,
  CAST(CAST(coalesce(min_score, 691) AS INT) AS DOUBLE) AS min_score, '再选:化' AS notes FROM noise_fields WHERE src_line % 4 = 0
UNION ALL SELECT {_IDS}, 'B' || (1000 + plan_count), '清华大学', '第' || src_line || '组', 690.0, '医学类专业' FROM noise_fields WHERE src_line % 4 = 1
UNION ALL SELECT {_IDS}, NULL, NULL, NULL, NULL, NULL FROM noise_fields WHERE src_line % 4 IN (2, 3)""")
def row_line(t):
    return t.noise_fields.select(*_ID, text.row_line(F.col("line_raw")).alias("r")).select(*_ID, "r.*")


@query("C18_batch_and_subject_from_context", f"""
WITH b AS (SELECT *, concat_ws(' ', nullif(file_raw, ''), nullif(title_raw, ''), nullif(group_raw, '')) AS blob FROM noise_fields)
SELECT {_IDS}, CASE WHEN trim(batch_given) <> '' THEN trim(batch_given) WHEN contains(blob, '高职高专') THEN '专科批'
   WHEN contains(blob, '专科') AND NOT contains(blob, '本科') THEN '专科批' ELSE '本科批' END AS batch_out,
  CASE WHEN contains(title_raw, '历史') THEN '历史类' WHEN contains(title_raw, '物理') THEN '物理类' END AS subject_out FROM b""")
def from_context(t):
    args = (F.col("file_raw"), F.col("title_raw"), F.col("group_raw"))
    return t.noise_fields.select(
        *_ID, rules.batch_from_context(F.col("batch_given"), *args).alias("batch_out"),
        rules.subject_from_context(F.lit(None).cast("string"), *args).alias("subject_out"),
    )


@query("C19_flag", f"SELECT {_IDS}, coalesce(regexp_full_match(lower(trim(flag_raw)), '1|true|yes|y|是|t'), false) AS v FROM noise_fields")
def flag(t):
    return t.noise_fields.select(*_ID, text.flag(F.col("flag_raw")).alias("v"))


# ---- titles ----

define("title_fx", """
SELECT page_id, slug, title, source_title, page_url, yr FROM (
 SELECT o_orderkey AS page_id,
  CASE o_custkey % 11 WHEN 0 THEN 'fujian' WHEN 1 THEN 'hebei' WHEN 2 THEN 'guangdong' WHEN 3 THEN 'hubei' WHEN 4 THEN 'hunan' WHEN 5 THEN 'liaoning'
    WHEN 6 THEN 'chongqing' WHEN 7 THEN 'jiangsu' WHEN 8 THEN 'henan' WHEN 9 THEN 'zhejiang' ELSE 'shandong' END AS slug,
  CAST(year(o_orderdate) + 26 AS INT) AS yr,
  CASE o_orderkey % 4 WHEN 0 THEN '江苏省' || CAST(year(o_orderdate) + 26 AS STRING) || '年' WHEN 1 THEN '二〇二四年' WHEN 2 THEN '二〇二二年' ELSE '' END
  || CASE o_orderkey % 9 WHEN 0 THEN '普通类' WHEN 1 THEN '艺术类本科' WHEN 2 THEN '体育类' WHEN 3 THEN '音乐类' WHEN 4 THEN '普通批' WHEN 5 THEN '对口' WHEN 6 THEN '体育' WHEN 7 THEN '' ELSE '美术' END
  || CASE o_orderkey % 13 WHEN 0 THEN '（历史科目组合）' WHEN 1 THEN '（物理等科目类）' WHEN 2 THEN '文科' WHEN 3 THEN '理科' WHEN 4 THEN '首选物理' WHEN 5 THEN '历史物理' WHEN 6 THEN '物理' ELSE '' END
  || CASE o_custkey % 7 WHEN 0 THEN '本科批次' WHEN 1 THEN '专科批' WHEN 2 THEN '第二段' WHEN 3 THEN '本科提前批次' WHEN 4 THEN '高职高专批' WHEN 5 THEN '第1次志愿' ELSE '' END
  || CASE o_orderkey % 11 WHEN 0 THEN '平行志愿投档线' WHEN 1 THEN '逐分段统计表' WHEN 2 THEN '录取控制分数线' WHEN 3 THEN '投档情况' WHEN 4 THEN '专业录取情况' WHEN 5 THEN '征求志愿计划' WHEN 6 THEN '院校专业组投档分数线' WHEN 7 THEN '一分一段表' WHEN 8 THEN '通知' WHEN 9 THEN '体育类本科' ELSE '专业录取分数线' END AS title,
  CASE o_custkey % 5 WHEN 0 THEN '普通高校招生本科' WHEN 1 THEN '艺术类专科批' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '体育类本科一批' END AS source_title,
  CASE o_orderkey % 3 WHEN 0 THEN 'https://www.example.org/webfile/index/index_zkxx/' || CAST(year(o_orderdate) + 26 AS STRING) || '-06-24/' || CAST(o_orderkey AS STRING) || '.html'
    WHEN 1 THEN 'https://www.example.org/art/' || CAST(year(o_orderdate) + 26 AS STRING) || '/' || CAST(o_orderkey AS STRING) || '.html?y=2021' ELSE 'https://www.example.org/show?id=' || CAST(o_orderkey AS STRING) END AS page_url
 FROM {orders}) x""")

_NOT_CONTROL = ("投档线", "平行志愿", "征求志愿", "提前批次投档", "本科批次平行志愿", "专科批次平行志愿")


@query("C20_record_type", f"""
SELECT page_id, CASE WHEN {q.has('title', ('逐分段', '一分一段', '分段统计', '高考成绩分段'))} THEN 'rank'
  WHEN {q.has('title', _NOT_CONTROL)} THEN CASE WHEN title LIKE '%投档线%' OR title LIKE '%投档情况%' THEN 'school' ELSE 'unknown' END
  WHEN title LIKE '%录取控制分数线%' THEN 'control' WHEN {q.has('title', titles.SCHOOL_WORDS)} THEN 'school'
  WHEN title LIKE '%专业录取%' THEN 'major' ELSE 'unknown' END AS record_type,
  NOT ({q.has('title', _NOT_CONTROL)}) AND title LIKE '%录取控制分数线%' AS is_control FROM title_fx""")
def record_type(t):
    return t.title_fx.select("page_id", titles.record_type(F.col("title")).alias("record_type"), titles.is_control_title(F.col("title")).alias("is_control"))


_X = "concat_ws(' ', nullif(source_title, ''), nullif(title, ''))"
_GENERIC_CATEGORY = f"""CASE WHEN contains(title, '艺术类') THEN '艺术类' WHEN contains(title, '体育类') THEN '体育类' WHEN contains({_X}, '艺术类') THEN '艺术类'
  WHEN contains({_X}, '体育类') OR ({_X} LIKE '%体育%' AND {_X} LIKE '%本科%') THEN '体育类' ELSE '普通类' END"""
_GENERIC_BATCH = f"""CASE WHEN {_X} LIKE '%本科一批%' THEN '本科一批' WHEN {_X} LIKE '%本科二批%' THEN '本科二批' WHEN {_X} LIKE '%高职高专%' THEN '高职高专批'
  WHEN {_X} LIKE '%第一段%' THEN '本科批' WHEN {_X} LIKE '%第二段%' THEN '专科批' WHEN {_X} LIKE '%第1次%' THEN '本科批' WHEN {_X} LIKE '%第2次%' OR {_X} LIKE '%第3次%' THEN '专科批'
  WHEN {_X} LIKE '%专科%' AND {_X} LIKE '%批%' THEN '专科批' WHEN {_X} LIKE '%提前%' AND {_X} LIKE '%批%' THEN '本科提前批' ELSE '本科批' END"""


@query("C21_category_and_batch", f"SELECT page_id, {_GENERIC_CATEGORY} AS category, {_GENERIC_BATCH} AS batch FROM title_fx")
def category_and_batch(t):
    args = (F.col("title"), F.col("source_title"))
    return t.title_fx.select("page_id", titles.category_from_title(*args).alias("category"), titles.batch_from_title(*args).alias("batch"))


@query("C22_subject_from_title", """
SELECT page_id, CASE WHEN regexp_matches(title, '历史科目组|历史等科目|历史类|文科') THEN '历史类' WHEN regexp_matches(title, '物理科目组|物理等科目|物理类|理科') THEN '物理类'
  WHEN contains(title, '历史') AND NOT contains(title, '物理') THEN '历史类' WHEN contains(title, '物理') THEN '物理类' END AS modern,
  nullif(regexp_extract(title, '文科|理科'), '') AS legacy FROM title_fx""")
def subject_from_title(t):
    return t.title_fx.select(
        "page_id", titles.subject_from_title(F.col("title")).alias("modern"), titles.subject_from_title(F.col("title"), F.lit(True)).alias("legacy")
    )


_YEARS = (2021, 2022, 2023, 2024)


@query("C23_announcement_year", """
SELECT t.page_id, (SELECT CAST(min(y.year) AS INT) FROM (VALUES (2021, '二〇二一'), (2022, '二〇二二'), (2023, '二〇二三'), (2024, '二〇二四')) y(year, zh)
  WHERE contains(t.title, CAST(y.year AS VARCHAR)) OR contains(t.title, y.zh)
     OR regexp_matches(regexp_extract(t.page_url, '^https?://[^/]*([^?#]*)', 1), '/' || y.year || '[-/]')) AS year FROM title_fx t""")
def announcement_year(t):
    return t.title_fx.select("page_id", titles.announcement_year(F.col("title"), F.col("page_url"), _YEARS).alias("year"))


_WORDS = titles.keyword_list(None, "通知")


@query("C24_matched_keyword", f"SELECT page_id, list_filter([{', '.join(q.lit(w) for w in _WORDS)}], lambda w: contains(title, w))[1] AS keyword FROM title_fx")
def matched_keyword(t):
    return t.title_fx.select("page_id", titles.matched_keyword(F.col("title"), titles.keyword_list(None, " 通知 ")).alias("keyword"))


def _rule_values(sets: dict) -> str:
    rows = []
    for slug, rule_list in sets.items():
        for prio, (result, words, absent) in enumerate(rule_list):
            rows.append(f"({q.lit(slug)}, {prio}, {q.lit(result)}, [{', '.join(map(q.lit, words))}], [{', '.join(map(q.lit, absent)) or 'NULL'}])")
    return f"(VALUES {', '.join(rows)}) r(slug, prio, result, words, absent)"


def _ruled(sets: dict, expr: str) -> str:
    """Result of the first rule of the province, from a rule table joined by province."""
    return f"""(SELECT arg_min(r.result, r.prio) FROM {_rule_values(sets)} WHERE r.slug = t.slug
      AND len(list_filter(r.words, lambda w: contains({expr}, w))) > 0 AND len(list_filter(r.absent, lambda w: contains({expr}, w))) = 0)"""


_TX = "concat_ws(' ', nullif(t.source_title, ''), nullif(t.title, ''))"


@query("C25_province_category", f"SELECT page_id, {_ruled(titles.CATEGORY_RULES, 't.title')} AS category FROM title_fx t")
def province_category(t):
    return t.title_fx.select("page_id", titles.province_category(F.col("slug"), F.col("title")).alias("category"))


@query("C26_province_subject", f"SELECT page_id, {_ruled(titles.SUBJECT_RULES, 't.title')} AS subject FROM title_fx t")
def province_subject(t):
    return t.title_fx.select("page_id", titles.province_subject(F.col("slug"), F.col("title")).alias("subject"))


_BATCHED = f"CASE WHEN slug IN ('fujian','hebei','hubei','hunan','liaoning','chongqing') THEN coalesce({_ruled(titles.BATCH_RULES, _TX)}, '本科批') END"


@query("C27_province_batch", f"SELECT page_id, {_BATCHED} AS batch FROM title_fx t")
def province_batch(t):
    return t.title_fx.select("page_id", titles.province_batch(F.col("slug"), F.col("title"), F.col("source_title")).alias("batch"))


# The same rules as ordered lists in one automaton, each distinct title walked once.
_BY_WORDS = f"""
SELECT t.page_id, list_filter([{', '.join(q.lit(w) for w in _WORDS)}], lambda w: contains(title, w))[1] AS keyword, {_ruled(titles.CATEGORY_RULES, 't.title')} AS category,
  {_ruled(titles.SUBJECT_RULES, 't.title')} AS subject FROM title_fx t"""


@query("C25_rules_by_automaton", _BY_WORDS)
def rules_by_automaton(t):
    words = [keywords.Rule(w, ((w,),)) for w in titles.keyword_list(None, "通知")]
    sets = {"category": titles.CATEGORY_RULES, "subject": titles.SUBJECT_RULES}
    lists = {name: {slug: keywords.rules_of(rule_list) for slug, rule_list in by_slug.items()} for name, by_slug in sets.items()}
    found = keywords.first_rules_by(t.title_fx.select("page_id", "slug", "title"), "slug", "title", lists, {"keyword": words})
    return found.select("page_id", "keyword", "category", "subject")


@query("C27_batches_by_automaton", f"SELECT page_id, {_ruled(titles.BATCH_RULES, _TX)} AS batch FROM title_fx t")
def batches_by_automaton(t):
    rows = t.title_fx.select("page_id", "slug", F.concat_ws(" ", F.nullif("source_title", F.lit("")), F.nullif("title", F.lit(""))).alias("text"))
    lists = {slug: keywords.rules_of(rule_list) for slug, rule_list in titles.BATCH_RULES.items()}
    return keywords.first_rules_by(rows, "slug", "text", {"batch": lists}).select("page_id", "batch")


@query("C20_record_type_by_automaton", f"""
SELECT page_id, CASE WHEN {q.has('title', ('逐分段', '一分一段', '分段统计', '高考成绩分段'))} THEN 'rank'
  WHEN {q.has('title', _NOT_CONTROL)} THEN CASE WHEN title LIKE '%投档线%' OR title LIKE '%投档情况%' THEN 'school' ELSE 'unknown' END
  WHEN title LIKE '%录取控制分数线%' THEN 'control' WHEN {q.has('title', titles.SCHOOL_WORDS)} THEN 'school'
  WHEN title LIKE '%专业录取%' THEN 'major' ELSE 'unknown' END AS record_type FROM title_fx""")
def record_type_by_automaton(t):
    lists = {"record_type": [keywords.Rule(result, groups) for result, groups in titles.record_type_rules()]}
    return keywords.first_rules(t.title_fx.select("page_id", "title"), "title", lists).select("page_id", "record_type")


_META = f"""
m AS (SELECT page_id, slug, coalesce(replace(coalesce({_ruled(titles.CATEGORY_RULES, 't.title')}, {_ruled(titles.CATEGORY_RULES, "coalesce(t.source_title, '')")}),
  'unsupported', '艺术类'), {_GENERIC_CATEGORY}) AS category, coalesce({_BATCHED}, {_GENERIC_BATCH}) AS batch FROM title_fx t)"""


@query("C28_province_metadata", f"WITH {_META} SELECT page_id, category, batch FROM m")
def province_metadata(t):
    category, batch = titles.province_metadata(F.col("slug"), F.col("title"), F.col("source_title"))
    return t.title_fx.select("page_id", category.alias("category"), batch.alias("batch"))


@query("C29_importable_category", f"""WITH {_META}
SELECT page_id, slug IN ('jiangsu','henan','zhejiang','shandong') OR category = '普通类' AS importable FROM m""")
def importable_category(t):
    category, _ = titles.province_metadata(F.col("slug"), F.col("title"), F.col("source_title"))
    return t.title_fx.select("page_id", titles.importable(F.col("slug"), category).alias("importable"))


# ---- files, content, boxes, sources ----

define("file_pairs", """
SELECT src_order, src_line, src_supp, plan_count AS na, (src_supp % 60) AS nb, src_line % 2 AS ka, src_line % 3 % 2 AS kb,
  CASE WHEN src_line % 2 = 0 THEN 'd/' || CAST(plan_count AS STRING) || '.png' ELSE 'page' || CAST(plan_count AS STRING) || '.JPG' END AS path_a,
  CASE WHEN src_line % 3 % 2 = 0 THEN 'e/0' || CAST(src_supp % 60 AS STRING) || '.PNG' ELSE 'Page' || CAST(src_supp % 60 AS STRING) || '.jpg' END AS path_b FROM school_noise""")


@query("C30_natural_order", f"""
SELECT {_IDS}, (ka < kb OR (ka = kb AND (na < nb OR (na = nb AND ka = 0 AND path_b LIKE 'e/%' AND lower(split_part(path_a, '/', 2)) < lower(split_part(path_b, '/', 2)))))) AS before
FROM file_pairs""")
def natural_order(t):
    return t.file_pairs.select(*_ID, (text.natural_key(F.col("path_a")) < text.natural_key(F.col("path_b"))).alias("before"))


@query("C31_content_key", "SELECT doc_id, sha256(text) AS key FROM documents")
def content_key(t):
    return t.documents.select("doc_id", text.content_key(F.col("text").cast("binary")).alias("key"))


@query("C32_box_centre", """
SELECT event_id, CAST(x_center AS DOUBLE) AS x_center, CAST(y_center AS DOUBLE) AS y_center, x_center AS corner_x, y_center AS corner_y FROM items_fx""")
def box_centre(t):
    def p(dx, dy):
        return F.array(F.col("x_center") + dx, F.col("y_center") + dy)

    items = t.items_fx.select(
        "event_id", F.array(p(-10, -4), p(10, -4), p(10, 4), p(-10, 4)).alias("polygon"),
        F.array(F.col("x_center") - 10, F.col("y_center") - 4, F.col("x_center") + 10, F.col("y_center") + 4).alias("corners"),
    )
    centre = text.corner_centre(F.col("corners"))
    return items.select("event_id", text.box_centre(F.col("polygon")).alias("c"), centre.alias("k")).select(
        "event_id", "c.*", F.col("k.x_center").alias("corner_x"), F.col("k.y_center").alias("corner_y")
    )


@query("C33_recognised_source", f"SELECT {_IDS}, coalesce(source_raw LIKE 'ocr\\_experimental:%' ESCAPE '\\', false) AS v FROM noise_fields")
def recognised_source(t):
    return t.noise_fields.select(*_ID, text.is_recognised_source(F.col("source_raw")).alias("v"))


@query("C34_key_text", f"SELECT {_IDS}, coalesce(trim(batch_given), '') AS v FROM noise_fields")
def key_text(t):
    return t.noise_fields.select(*_ID, text.text_or_empty(F.col("batch_given")).alias("v"))


define("page_access", """
SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'http://datacenter.haeea.cn/q' ELSE url END AS url, page_id % 5 AS attachments,
  CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN html || '请输入验证码' WHEN 2 THEN html || 'CAPTCHA' WHEN 3 THEN html || 'datacenter.haeea.cn 平行投档' WHEN 4 THEN html || 'datacenter.haeea.cn' ELSE html END AS html
FROM {pages}""")


@query("C35_source_access", """
SELECT page_id, CASE WHEN attachments > 0 THEN 'ok' WHEN page_id % 7 = 0 THEN 'unsupported_verification_required' WHEN page_id % 6 = 0 THEN 'ok'
  WHEN page_id % 6 IN (1, 2) THEN 'unsupported_verification_required' WHEN page_id % 6 = 3 THEN 'unsupported_verification_required' ELSE 'ok' END AS access FROM page_access""")
def source_access(t):
    return t.page_access.select("page_id", rules.source_access(F.col("url"), F.col("html"), F.col("attachments")).alias("access"))


@query("C36_query_mode_rule", """
SELECT school_name, CASE WHEN s < 0.2 THEN 'score' WHEN r < 0.2 AND s >= 0.8 THEN 'rank' ELSE 'mixed' END AS mode FROM (
 SELECT school_name, CAST(count(*) - count(min_score) AS DOUBLE) / count(*) AS s, CAST(count(*) - count(min_rank) AS DOUBLE) / count(*) AS r FROM school_fx GROUP BY school_name) x""")
def query_mode_rule(t):
    rates = t.school_fx.groupBy("school_name").agg(
        F.avg(F.col("min_score").isNull().cast("double")).alias("s"), F.avg(F.col("min_rank").isNull().cast("double")).alias("r")
    )
    return rates.select("school_name", text.query_mode(F.col("s"), F.col("r")).alias("mode"))


define("request_fx", """
SELECT src_order, src_line, src_supp, year + (src_line % 5) * 8 AS year, province, CASE plan_count % 7 WHEN 0 THEN '' WHEN 1 THEN '其他' ELSE subject_type END AS subject,
  min_score AS lo, CASE WHEN plan_count % 3 = 0 THEN min_score - 5 ELSE min_score + 5 END AS hi, min_rank AS rlo, min_rank + plan_count - 10 AS rhi, plan_count * 10 - 50 AS lim FROM school_raw""")


@query("C38_request_rules", f"""
SELECT {_IDS}, CASE WHEN year NOT BETWEEN 2000 AND 2030 THEN 'year' WHEN subject NOT IN ('', '文科', '理科', '历史类', '物理类', '综合改革') THEN 'subject_type'
  WHEN lo > hi THEN 'score_range' WHEN rlo > rhi THEN 'rank_range' END AS error, CAST(CASE WHEN lim < 1 THEN 50 WHEN lim > 200 THEN 200 ELSE lim END AS INT) AS lim FROM request_fx""")
def request_rules(t):
    c = F.col
    error = rules.request_error(c("year"), c("province"), c("subject"), c("lo"), c("hi"), c("rlo"), c("rhi"))
    return t.request_fx.select(*_ID, error.alias("error"), rules.clamp_limit(c("lim"), 50, 200).alias("lim"))


define("access_log", """
SELECT src_order, src_line, src_supp, school_code AS source_id, CASE (plan_count + src_line) % 9 WHEN 0 THEN 'ok' WHEN 1 THEN ' Partial ' WHEN 2 THEN 'waf_blocked' WHEN 3 THEN 'weird'
  WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'unsupported_verification_required' WHEN 7 THEN 'unknown' ELSE 'connection_reset' END AS status_raw FROM school_noise""")
_ACCESS = """CASE WHEN coalesce(status_raw, '') = '' THEN 'available' ELSE CASE lower(trim(status_raw)) WHEN 'ok' THEN 'available' WHEN 'unsupported_verification_required' THEN 'verification_required'
  WHEN 'partial' THEN 'partial' WHEN 'waf_blocked' THEN 'waf_blocked' WHEN 'unknown' THEN 'unknown' WHEN 'connection_reset' THEN 'connection_reset' ELSE 'partial' END END"""


@query("C39_access_status", f"SELECT {_IDS}, {_ACCESS} AS status FROM access_log")
def access_status(t):
    return t.access_log.select(*_ID, rules.access_status(F.col("status_raw")).alias("status"))


@query("C39_worst_access_status", f"""
WITH s AS (SELECT source_id, {_ACCESS} AS status FROM access_log)
SELECT source_id, arg_min(status, CASE status WHEN 'verification_required' THEN 0 WHEN 'waf_blocked' THEN 1 WHEN 'connection_reset' THEN 2 WHEN 'partial' THEN 5
  WHEN 'available' THEN 6 ELSE 7 END) AS status FROM s GROUP BY source_id""")
def worst_access_status(t):
    status = rules.access_status(F.col("status_raw"))
    return t.access_log.select("source_id", status.alias("status")).groupBy("source_id").agg(
        F.min_by("status", rules.access_severity(F.col("status"))).alias("status")
    )


@query("C40_year_in_path", f"SELECT {_IDS}, CASE WHEN source_raw LIKE 'x/2023/%' THEN CAST(2023 AS INT) END AS year FROM noise_fields")
def year_in_path(t):
    return t.noise_fields.select(*_ID, text.year_in_path(F.col("source_raw")).alias("year"))


