"""Recognised items to rows, audits and engine choice."""

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import cache, items, load, normalize, validate
from ..session import cut_lineage, qualified, shared_folder
from ..sources import pages
from .inputs import define
from .registry import query

# Images of up to twelve data rows, one per event, below a title and a header.
define("item_rows", """
SELECT CAST(floor(event_id / 12) AS BIGINT) AS image_id, event_id, CAST(event_id % 12 AS INT) AS r, 'A' || CAST(100 + event_id % 900 AS STRING) AS code,
  CASE event_id % 5 WHEN 0 THEN '武汉大学第01组' WHEN 1 THEN '北京大学' WHEN 2 THEN '4' ELSE '清华大学A05组' END AS name, CASE event_id % 2 WHEN 0 THEN '化' ELSE '不限' END AS req,
  CASE WHEN event_id % 7 = 3 THEN NULL ELSE CAST(CASE WHEN event_id % 50 = 0 THEN 800 ELSE 400 + event_id % 90 END AS STRING) END AS score, 'n' || CAST(event_id % 9 AS STRING) AS note FROM {events}""")


# In even images the score stands halfway between two headers, in odd ones below its own.
def _score_x():
    return F.when(F.col("image_id") % 2 == 0, 300.0).otherwise(340.0)


def _item(y, x, text):
    return F.struct(y.cast("double").alias("y_center"), (x if isinstance(x, Column) else F.lit(float(x))).alias("x_center"), text.alias("text"))


def _table_items(t):
    rows = t.item_rows
    y = F.lit(100) + F.col("r") * 40 + F.col("event_id") % 3
    cells = [_item(y, x, F.col(c)) for x, c in ((52, "code"), (148, "name"), (255, "req"), (_score_x(), "score"), (460, "note"))]
    head = [_item(F.lit(40), x, F.lit(w)) for x, w in zip((50, 150, 250, 350, 450), items.HEADER_MARKERS)]
    title = [_item(F.lit(0), 10, F.lit("湖北省投档线"))]
    all_cells = F.when(F.col("r") == 0, F.array(*cells, *head, *title)).otherwise(F.array(*cells))
    long = rows.select("image_id", "event_id", F.posexplode(all_cells).alias("n", "c")).select("image_id", (F.col("event_id") * 20 + F.col("n")).alias("item_id"), "c.*")
    return long.where("text IS NOT NULL")


def _lines(t):
    """Items with row numbers and the row texts; rows are read twice, so they are written once."""
    rows = cut_lineage(items.cluster_rows(_table_items(t)))
    return rows, items.row_texts(rows, "item_id")


@query("K1_clustered_rows", """
SELECT image_id, event_id, CAST(dense_rank() OVER (PARTITION BY image_id ORDER BY event_id % 12) - 1 AS INT) AS row_id FROM items_fx""")
def clustered_rows(t):
    return items.cluster_rows(t.items_fx).select("image_id", "event_id", "row_id")


@query("K1_row_texts", """
SELECT image_id, CAST(0 AS INT) AS row_id, '湖北省投档线' AS line, CAST(1 AS INT) AS cells FROM item_rows WHERE r = 0
UNION ALL SELECT image_id, 1, '院校专业组代号 院校专业组名称 类别 投档线 备注', 5 FROM item_rows WHERE r = 0
UNION ALL SELECT image_id, r + 2, concat_ws(' ', code, name, req, score, note), CASE WHEN score IS NULL THEN 4 ELSE 5 END FROM item_rows""")
def row_texts(t):
    return _lines(t)[1]


@query("K3_header_line", "SELECT image_id, CAST(1 AS INT) AS header_row FROM item_rows WHERE r = 0")
def header_line(t):
    return items.header_line(_lines(t)[1])


@query("K4_cells_by_nearest_header", """
SELECT image_id, CAST(r + 2 AS INT) AS row_id, 'school_code' AS field, code AS value FROM item_rows UNION ALL SELECT image_id, r + 2, 'major_group_name', name FROM item_rows
UNION ALL SELECT image_id, r + 2, 'subject_type', CASE WHEN image_id % 2 = 0 THEN coalesce(score, req) ELSE req END FROM item_rows UNION ALL SELECT image_id, r + 2, 'notes', note FROM item_rows
UNION ALL SELECT image_id, r + 2, 'min_score', score FROM item_rows WHERE image_id % 2 <> 0 AND score IS NOT NULL""")
def cells_by_nearest_header(t):
    # Of a cell halfway between two headers the left one takes it and, being the last cell of that field, it wins.
    rows, lines = _lines(t)
    return items.assigned_cells(rows, items.header_line(lines))


@query("K5_records_by_line", """
SELECT image_id, CAST(r + 2 AS INT) AS row_id, code AS school_code, CASE event_id % 5 WHEN 0 THEN '武汉大学' WHEN 1 THEN '北京大学' WHEN 2 THEN '4' ELSE '清华大学' END AS school_name,
  CASE event_id % 5 WHEN 0 THEN '第01组' WHEN 3 THEN 'A05组' WHEN 4 THEN 'A05组' END AS major_group, CAST(score AS DOUBLE) AS min_score, CASE WHEN req = '化' THEN '再选:化' END AS notes
FROM item_rows WHERE score IS NOT NULL""")
def records_by_line(t):
    return items.records_by_line(_lines(t)[1])


@query("K6_records_by_header", """
SELECT image_id, CAST(r + 2 AS INT) AS row_id, code AS school_code, CASE event_id % 5 WHEN 0 THEN '武汉大学' WHEN 1 THEN '北京大学' WHEN 2 THEN '4' ELSE '清华大学' END AS school_name,
  CASE event_id % 5 WHEN 0 THEN '第01组' WHEN 3 THEN 'A05组' WHEN 4 THEN 'A05组' END AS major_group, CASE WHEN image_id % 2 = 0 THEN coalesce(score, req) ELSE req END AS subject_type, '本科批' AS batch,
  CASE WHEN image_id % 2 <> 0 THEN CAST(score AS DOUBLE) END AS min_score,
  '普通类' AS admission_category, note AS notes FROM item_rows""")
def records_by_header(t):
    rows, lines = _lines(t)
    return items.records_by_header(rows, lines)


define("engine_raw", """
SELECT event_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '' END AS blank FROM {events}""")


@query("K2_engine_items", """
SELECT event_id, CAST(0 AS INT) AS item_no, event_type AS text, CAST(0.5 AS DOUBLE) AS score, CAST(15 AS DOUBLE) AS x_center, CAST(event_id % 12 AS DOUBLE) AS y_center FROM engine_raw WHERE event_id % 2 = 0
UNION ALL SELECT event_id, CAST(0 AS INT), event_type, 0.5, 15.0, CAST(event_id % 12 AS DOUBLE) FROM engine_raw WHERE event_id % 2 = 1
UNION ALL SELECT event_id, CAST(1 AS INT), 'x', 0.25, 15.0, CAST(event_id % 12 AS DOUBLE) FROM engine_raw WHERE event_id % 3 = 0""")
def engine_items(t):
    y = (F.col("event_id") % 12).cast("string")
    box = F.concat(F.lit("[[10,"), y, F.lit("],[20,"), y, F.lit("]]"))
    modern = F.format_string('{"rec_texts":[" %s ","%s"],"rec_scores":[0.5,0.25],"rec_polys":[%s,%s]}', "event_type", "blank", box, box)
    legacy = F.format_string('[[{"box":%s,"text":"%s","score":0.5},{"box":%s,"text":" %s","score":0.25}]]', box, "event_type", box, "blank")
    raw = t.engine_raw.select("event_id", F.when(F.col("event_id") % 2 == 0, modern).otherwise(legacy).alias("raw"))
    return items.engine_items(raw, "raw")


@query("A8_stored_items", """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE CAST(2 AS INT) END AS n, CASE WHEN event_id % 4 <> 3 THEN event_type END AS first_text FROM engine_raw""")
def stored_items(t):
    good = F.format_string('[{"text":"%s","score":0.9,"box":[[1,2],[3,4]],"x_center":1.5,"y_center":2.5},{"text":"b"}]', "event_type")
    raw = F.when(F.col("event_id") % 4 == 3, F.when(F.col("event_id") % 8 == 3, "not json").otherwise('{"a":1}')).otherwise(good)
    loaded = t.engine_raw.select("event_id", items.load_items(raw).alias("i"))
    return loaded.select("event_id", F.when(F.col("i").isNotNull(), F.size("i")).alias("n"), F.get("i", F.lit(0))["text"].alias("first_text"))


@query("K7_parse_status", """
SELECT image_id, 'parsed' AS status, count(*) FILTER (score IS NOT NULL) AS parsed_rows FROM item_rows GROUP BY 1
UNION ALL SELECT DISTINCT -1 - image_id, 'no_text_detected', 0 FROM item_rows""")
def parse_status(t):
    rows, lines = _lines(t)
    ids = t.item_rows.select("image_id").distinct()
    images = ids.unionByName(ids.select((-1 - F.col("image_id")).alias("image_id"))).withColumn("by_line", F.lit(True))
    return items.parse_status(images, rows, items.header_line(lines), items.records_by_line(lines)).drop("by_line")


# Records of the images with every fault the audits look for: short images, images without valid rows, without names, groups or scores.
define("item_records", """
SELECT image_id, event_id, r AS row_id, code AS school_code,
  CASE WHEN image_id % 4 = 3 AND event_id % 3 = 1 THEN NULL WHEN image_id % 2 = 0 THEN '清华大学' ELSE CASE event_id % 5 WHEN 0 THEN '武汉大学' WHEN 1 THEN '北京大学' WHEN 2 THEN '4' ELSE '清华大学' END END AS school_name,
  CASE WHEN image_id % 2 = 0 THEN 'A05组' ELSE CASE event_id % 5 WHEN 0 THEN '第01组' WHEN 3 THEN 'A05组' WHEN 4 THEN 'A05组' END END AS major_group,
  CASE WHEN image_id % 10 = 6 THEN 800.0 WHEN image_id % 16 = 8 AND event_id % 2 = 0 THEN NULL ELSE CAST(score AS DOUBLE) END AS min_score, CAST(coalesce(CAST(score AS INT), 7) AS INT) AS min_rank, note AS notes
FROM item_rows WHERE score IS NOT NULL AND NOT (image_id % 10 = 4 AND r >= 3)""")


def _records(t, drop_every: int | None = None):
    rows = t.item_records.where(F.col("event_id") % drop_every != 0) if drop_every else t.item_records
    return rows.select(
        "image_id", "row_id", F.lit(2024).alias("year"), F.lit("湖北").alias("province"), F.lit("物理类").alias("subject_type"), F.lit("本科批").alias("batch"),
        F.lit("普通类").alias("admission_category"), "school_code", "school_name", "major_group", F.col("min_score").cast("double").alias("min_score"), "min_rank", "notes",
    )


def _rates(source, p=""):
    """Rates and score range per image of the rows of a source."""
    null = lambda c: f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)"
    return f"""{p}q AS (SELECT image_id, count(*) AS rows, {null('school_name')} AS sn, {null('major_group')} AS gn, {null('min_score')} AS mn,
  CASE WHEN count(school_name) = 0 THEN 0.0 ELSE CAST(count(*) FILTER (school_name = '4') AS DOUBLE) / count(school_name) END AS bad, CAST(min(min_score) AS DOUBLE) AS lo, CAST(max(min_score) AS DOUBLE) AS hi FROM {source} GROUP BY 1)"""


_OK = "school_name IS NOT NULL AND (min_score IS NULL OR min_score <= 750)"


def _audit_sql(p="", every=None):
    """Audit of the records (all, or without every n-th event) in steps whose names begin with p."""
    return f"""
{p}r AS (SELECT * FROM item_records {f'WHERE event_id % {every} <> 0' if every else ''}),
{p}im AS (SELECT DISTINCT image_id FROM item_rows),
{p}v AS (SELECT image_id, count(*) AS parsed_rows, count(*) FILTER ({_OK}) AS valid_rows, count(*) FILTER (NOT ({_OK})) AS invalid_rows FROM {p}r GROUP BY 1),
{p}j AS (SELECT {p}r.* FROM {p}r JOIN {p}v USING (image_id) WHERE valid_rows = 0 OR ({_OK})),
{_rates(p + 'j', p)},
{p}a AS (SELECT im.image_id, coalesce(v.parsed_rows, 0) AS parsed_rows, coalesce(v.valid_rows, 0) AS valid_rows, coalesce(v.invalid_rows, 0) AS invalid_rows, CASE WHEN v.parsed_rows > 0 THEN 'parsed' ELSE 'table_reconstruction_failed' END AS status,
  coalesce(rows, 0) AS rows, coalesce(sn, 1.0) AS sn, coalesce(gn, 1.0) AS gn, coalesce(mn, 1.0) AS mn, coalesce(bad, 0.0) AS bad, lo, hi FROM {p}im im LEFT JOIN {p}v v USING (image_id) LEFT JOIN {p}q q USING (image_id)),
{p}fl AS (SELECT *, concat_ws(',', CASE WHEN status <> 'parsed' THEN 'ocr_status_' || status END, CASE WHEN parsed_rows < 5 THEN 'too_few_parsed_rows' END, CASE WHEN valid_rows = 0 THEN 'no_valid_rows' END,
  CASE WHEN lo < 100 OR hi > 750 THEN 'min_score_out_of_range' END, CASE WHEN rows > 0 AND sn > 0.2 THEN 'high_school_name_null_rate' END, CASE WHEN rows > 0 AND bad > 0.2 THEN 'invalid_school_name_pattern' END,
  CASE WHEN rows > 0 AND gn > 0.2 THEN 'high_major_group_null_rate' END, CASE WHEN rows = 0 OR greatest(sn, gn, mn) > 0.2 + 1e-12 THEN 'column_count_anomaly' END) AS flags FROM {p}a)"""


_QUALITY = _rates("item_records")


@query("K8_field_rates", f"WITH {_QUALITY} SELECT image_id, rows, sn AS school_name_null_rate, gn AS major_group_null_rate, mn AS min_score_null_rate, bad AS invalid_rate, lo AS score_min, hi AS score_max FROM q")
def field_rates(t):
    return items.field_quality(_records(t)).drop("fields_complete")


@query("K9_irregular_rows", "SELECT image_id, image_id % 5 = 0 AS irregular FROM item_rows GROUP BY 1")
def irregular_rows(t):
    # Every fifth image has lost the names and requirements, so its rows have three cells.
    cells = _table_items(t).where(~((F.col("image_id") % 5 == 0) & (F.col("item_id") % 20).isin(1, 2)))
    return items.irregular_rows(items.row_texts(items.cluster_rows(cells), "item_id"))


@query("K10_key_fields_complete", f"WITH {_QUALITY} SELECT image_id, greatest(sn, gn, mn) <= 0.2 + 1e-12 AS fields_complete FROM q")
def key_fields_complete(t):
    return items.field_quality(_records(t)).select("image_id", "fields_complete")


@query("K11_quality_summary", f"""WITH {_QUALITY} SELECT image_id, round(1 - sn, 4) AS school_name_non_null_rate, round(1 - gn, 4) AS major_group_non_null_rate, round(1 - mn, 4) AS min_score_non_null_rate,
 round(bad, 4) AS school_name_invalid_rate, lo AS score_min, hi AS score_max FROM q""")
def quality_summary(t):
    return items.quality_summary(items.field_quality(_records(t)))


def _audit(t, drop_every: int | None = None):
    return _audited(t, _records(t, drop_every))


def _audited(t, records):
    ids = t.item_rows.select("image_id").distinct()
    status = ids.join(records.groupBy("image_id").agg(F.count("*").alias("parsed_rows")), "image_id", "left").fillna(0, ["parsed_rows"])
    status = status.withColumn("status", F.when(F.col("parsed_rows") > 0, "parsed").otherwise("table_reconstruction_failed"))
    return items.audit(ids, records, status)


@query("K12_suspicious_flags", f"WITH {_audit_sql()} SELECT image_id, flags FROM fl")
def suspicious_flags(t):
    return _audit(t).select("image_id", F.array_join("suspicious_flags", ",").alias("flags"))


@query("K13_image_audit", f"WITH {_audit_sql()} SELECT image_id, parsed_rows, valid_rows, invalid_rows, CASE WHEN parsed_rows > 0 THEN CAST(least(parsed_rows, 10) AS INT) END AS samples FROM fl")
def image_audit(t):
    samples = items.sample_rows(_records(t)).select("image_id", F.size("sample_rows").alias("samples"))
    return _audit(t).join(samples, "image_id", "left").select("image_id", "parsed_rows", "valid_rows", "invalid_rows", "samples")


# Batches by last digit: those of the too short (4), the out of range (6) and of the odd images fail, the others pass. Every audited image is judged.
def _gated(t):
    audits = _audit(t).withColumn("corrupted", F.col("image_id") % 13 == 5).withColumn("year", (F.col("image_id") % 10 + 2015).cast("int"))
    return items.batch_gate(audits, "year")


_GATE = f"""{_audit_sql()}, g AS (SELECT CAST(image_id % 10 + 2015 AS INT) AS year, count(*) AS audited, count(*) FILTER (image_id % 13 <> 5) AS eligible, count(*) FILTER (image_id % 13 <> 5 AND flags = '') AS clean
  FROM fl GROUP BY 1)"""


@query("K14_batch_gate", f"WITH {_GATE} SELECT year, audited, eligible, clean, round(CAST(clean AS DOUBLE) / eligible, 4) AS clean_ratio, clean >= 0.8 * eligible AS passed FROM g")
def batch_gate(t):
    return _gated(t)


@query("K15_allowed_loads", f"WITH {_GATE} SELECT y.year, coalesce(clean >= 0.8 * eligible, false) AS allowed FROM (SELECT CAST(x AS INT) AS year FROM range(2015, 2027) r(x)) y LEFT JOIN g USING (year)")
def allowed_loads(t):
    years = t.item_rows.select((F.col("image_id") % 12 + 2015).cast("int").alias("year")).distinct()
    return items.allowed_loads(years, _gated(t), "year")


def _engine_audits(t):
    base = _audit(t).withColumn("engine", F.lit("base")).withColumn("status", F.when(F.col("image_id") % 17 == 2, "baseline_missing").otherwise(F.col("status")))
    fast = _audit(t, 5).withColumn("engine", F.lit("fast"))
    both = base.unionByName(fast)
    return both.withColumns({"seconds": F.when(F.col("engine") == "base", 9.0).otherwise(2.0), "cache_hit": F.col("image_id") % 3 == 0})


_COMPARED = f"""{_audit_sql('b')}, {_audit_sql('f', 5)},
x AS (SELECT b.image_id, b.image_id % 17 = 2 AS missing, b.valid_rows AS bv, f.valid_rows AS fv, b.status AS bs, f.status AS fs, b.lo AS blo, b.hi AS bhi, f.lo AS flo, f.hi AS fhi, f.bad, f.flags FROM bfl b JOIN ffl f USING (image_id)),
cmp AS (SELECT image_id, CASE WHEN NOT missing AND bv > 0 THEN round(CAST(fv AS DOUBLE) / bv, 4) END AS row_count_ratio,
  CASE WHEN NOT missing THEN blo IS NOT NULL AND flo IS NOT NULL AND flo <= bhi AND blo <= fhi END AS score_range_match,
  concat_ws(',', CASE WHEN missing THEN 'baseline_missing' END, CASE WHEN NOT missing AND bv = 0 THEN 'baseline_zero_valid_rows' END, CASE WHEN NOT missing AND bv > 0 AND fv < 0.8 * bv THEN 'valid_rows_ratio_low' END,
    CASE WHEN NOT missing AND bv > 0 AND flags <> '' THEN 'suspicious_flags' END, CASE WHEN NOT missing AND bv > 0 AND NOT coalesce(flo BETWEEN 100 AND 750 AND fhi BETWEEN 100 AND 750, false) THEN 'min_score_range_unreasonable' END,
    CASE WHEN NOT missing AND bv > 0 AND bad >= 0.05 THEN 'school_name_invalid_rate' END) AS reasons,
  CASE WHEN image_id % 3 <> 0 THEN CAST(4.5 AS DOUBLE) END AS speedup, NOT missing AND bs = 'parsed' AND bv > 0 AS base_success, fs = 'parsed' AND fv > 0 AS fast_success FROM x)"""


@query("K16_engine_comparison", f"WITH {_COMPARED} SELECT image_id, row_count_ratio, score_range_match, reasons = '' AS acceptable, reasons, speedup, base_success, fast_success FROM cmp")
def engine_comparison(t):
    return items.compare_engines(_engine_audits(t)).withColumn("reasons", F.array_join("reasons", ","))


@query("K17_comparison_summary", f"""WITH {_COMPARED} SELECT count(*) AS image_count, round(avg(speedup), 2) AS avg_speedup, round(avg(row_count_ratio), 4) AS avg_row_count_ratio, count(*) FILTER (reasons = '') AS acceptable_count,
  count(*) FILTER (base_success) AS base_success_count, count(*) FILTER (fast_success) AS fast_success_count FROM cmp""")
def comparison_summary(t):
    return items.comparison_summary(items.compare_engines(_engine_audits(t)))


def _fast_gate(t):
    base = _audit(t).where("image_id % 6 <> 1").select("image_id", F.col("valid_rows").alias("base_rows"))
    return items.fast_engine_gate(_audit(t, 5), base)


_FAST = f"""{_audit_sql('b')}, {_audit_sql('f', 5)},
fg AS (SELECT f.image_id, concat_ws(',', CASE WHEN f.status <> 'parsed' THEN 'ocr_status_' || f.status END, CASE WHEN b.valid_rows > 0 AND f.valid_rows < 0.8 * b.valid_rows THEN 'valid_rows_below_baseline' END,
  CASE WHEN NOT coalesce(b.valid_rows > 0, false) AND f.valid_rows < 40 THEN 'valid_rows_below_min' END, CASE WHEN f.flags <> '' THEN 'suspicious_flags' END, CASE WHEN f.rows > 0 AND round(f.bad, 4) >= 0.05 THEN 'school_name_invalid_rate' END,
  CASE WHEN f.lo IS NULL THEN 'min_score_range_missing' WHEN f.lo < 100 OR f.hi > 750 THEN 'min_score_out_of_range' END, CASE WHEN f.rows = 0 OR round(1 - f.sn, 4) < 0.95 THEN 'school_name_non_null_rate' END,
  CASE WHEN f.rows = 0 OR round(1 - f.gn, 4) < 0.95 THEN 'major_group_non_null_rate' END, CASE WHEN f.rows = 0 OR round(1 - f.mn, 4) < 0.95 THEN 'min_score_non_null_rate' END) AS reasons
  FROM ffl f LEFT JOIN (SELECT * FROM bfl WHERE image_id % 6 <> 1) b USING (image_id))"""


@query("K18_fast_engine_gate", f"WITH {_FAST} SELECT image_id, reasons = '' AS accepted, reasons FROM fg")
def fast_engine_gate(t):
    return _fast_gate(t).select("image_id", "accepted", F.array_join("reasons", ",").alias("reasons"))


@query("K19_chosen_records", f"""WITH {_FAST} SELECT image_id, 'fast' AS engine, count(*) AS n FROM fr JOIN fg USING (image_id) WHERE reasons = '' GROUP BY 1
UNION ALL SELECT image_id, 'base', count(*) FROM br JOIN fg USING (image_id) WHERE reasons <> '' AND image_id % 6 <> 1 GROUP BY 1""")
def chosen_records(t):
    cached = t.item_rows.where("image_id % 6 <> 1").select("image_id").distinct()
    choice = cut_lineage(items.choose_engine(_fast_gate(t), cached).select("image_id", "engine_selected", "final_status"))
    rows = items.chosen_records(choice, _records(t, 5), _records(t))
    return rows.groupBy("image_id", "engine").agg(F.count("*").alias("n"))


@query("K19_final_status", f"""WITH {_FAST} SELECT image_id, CASE WHEN reasons = '' OR image_id % 6 <> 1 THEN 'parsed' ELSE 'fallback_required_but_no_cache' END AS final_status FROM fg""")
def final_status(t):
    cached = t.item_rows.where("image_id % 6 <> 1").select("image_id").distinct()
    return items.choose_engine(_fast_gate(t), cached).select("image_id", "final_status")


define("doc_keys", "SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN 'base' ELSE 'fast' END AS engine FROM {documents}")


@query("K20_cache_hits", """
WITH k AS (SELECT doc_id, sha256(text) AS content_key, engine FROM doc_keys), c AS (SELECT DISTINCT content_key, 'base' AS engine FROM k WHERE doc_id % 3 = 0)
SELECT engine, count(*) AS images, count(*) FILTER ((content_key, engine) IN (SELECT (content_key, engine) FROM c)) AS cache_hits FROM k GROUP BY engine""")
def cache_hits(t):
    keys = t.doc_keys.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_key"), "engine")
    cache = keys.where("doc_id % 3 = 0").select("content_key", F.lit("base").alias("engine"))
    return items.cache_split(keys, cache).groupBy("engine").agg(F.count("*").alias("images"), F.count_if("cache_hit").alias("cache_hits"))


# Every page as a file of its own; files with equal bytes are one content.
define("page_contents", "SELECT page_id, sha256(html || chr(10)) AS content_key, html FROM {pages}")


# Folders of page files in each part: few enough to make, many enough to be listed side by side.
_FOLDERS = 64


def _write_pages(rows, folder):
    """A file per page, with its text and a line end. Tasks write their pages themselves: a table partitioned by page would need a folder, a checksum file, two
    permission changes and a rename on the driver for every page. A repeated task writes the same files again."""
    def write(found):
        place, base = pages.file_system(folder)
        made = set()
        for (part, page), same in groupby(found, lambda r: (r["part"], r["page_id"])):
            below = f"{base}/part={part}/{(page or 0) % _FOLDERS}"
            if below not in made:
                place.create_dir(below, recursive=True)
                made.add(below)
            with place.open_output_stream(f"{below}/page_id={page}.txt") as out:
                for r in same:
                    out.write(f"{r['value'] or ''}\n".encode())

    rows.repartition("page_id").sortWithinPartitions("part", "page_id").rdd.foreachPartition(write)


def _precomputed(t):
    """Files of all pages through the cache: a first run over the first pages of each host, then a run over all, then the same again."""
    folder = shared_folder(t.spark)
    found = t.pages.select("page_id", F.col("html").alias("value"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("part"))
    _write_pages(found, qualified(t.spark, folder + "/files"))
    store = cache.ItemCache(t.spark, folder + "/cache")

    def recognise(contents):
        # Stands for an engine: the start tags of the page as its items.
        texts = contents.select("content_key", F.col("content").cast("string").alias("text"))
        tags = F.regexp_extract_all("text", F.lit("<([a-z][a-z0-9]*)"), F.lit(1))
        return texts.select("content_key", F.to_json(F.transform(tags, lambda w: F.struct(w.alias("text")))).alias("items"))

    runs = []
    for number, part in enumerate(("/part=even", "", "")):
        seen = store.run(cache.files_of(t.spark, folder + "/files" + part, "*.txt"), "base", recognise, f"run {number}")
        runs.append(seen.select(F.lit(number + 1).alias("run"), "path", "content_key", "cache_hit"))
    return store, runs


@query("K20_runs_over_a_kept_cache", """
WITH k AS (SELECT page_id, content_key, bool_or(page_id % 2 = 0) OVER (PARTITION BY content_key) AS early FROM page_contents)
SELECT CAST(1 AS INT) AS run, count(*) AS files, count(DISTINCT content_key) AS contents, CAST(0 AS BIGINT) AS hits FROM k WHERE page_id % 2 = 0
UNION ALL SELECT 2, count(*), count(DISTINCT content_key), count(*) FILTER (early) FROM k UNION ALL SELECT 3, count(*), count(DISTINCT content_key), count(*) FROM k""")
def runs_over_a_kept_cache(t):
    _, runs = _precomputed(t)
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).groupBy("run").agg(
        F.count("*").alias("files"), F.count_distinct("content_key").alias("contents"), F.count_if("cache_hit").alias("hits")
    )


@query("C31_cached_items", """
SELECT DISTINCT content_key, len(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS n, regexp_extract(html, '<([a-z][a-z0-9]*)', 1) AS first_text FROM page_contents""")
def cached_items(t):
    store, _ = _precomputed(t)
    loaded = store.rows().select("content_key", items.load_items(F.col("items")).alias("i"))
    return loaded.select("content_key", F.size("i").cast("long").alias("n"), F.get("i", F.lit(0))["text"].alias("first_text"))


@query("K21_first_images", "SELECT 'img/' || u || '.png' AS path FROM (SELECT DISTINCT user_id AS u FROM events) x ORDER BY u LIMIT 40")
def first_images(t):
    rows = t.events.select(F.concat(F.lit("img/"), F.col("user_id").cast("string"), F.lit(".png")).alias("path"), F.col("event_type").alias("source_title"), F.lit("a").alias("attachment_title"))
    return items.first_images(rows, 40).select("path")


def _loaded(t, records):
    """Records of recognised images through normalisation, validation and the duplicate-free append, with a marked source."""
    rows = normalize.normalize_school(cut_lineage(records), keep=("image_id", "row_id"))
    # The checked rows are written once; the load reads them for its keys and its rows.
    valid = cut_lineage(validate.checked(rows, "school")).where("error IS NULL").drop("error")
    source = F.concat(F.lit("ocr_experimental:/img/"), F.col("image_id").cast("string"), F.lit(".png"))
    ready = normalize.enrich_for_load(valid, "school", source)
    return load.new_rows(ready, t.school_stored, "school", ["image_id", "row_id"]).select("year", "province", "school_code", "school_name", "major_group", "min_score", "source_url")


# The first good record of a code and group, none of which is stored (the stored provinces are others).
_LOADED = """
SELECT 2024 AS year, '湖北' AS province, school_code, school_name, major_group, min_score, 'ocr_experimental:/img/' || image_id || '.png' AS source_url FROM (
  SELECT *, row_number() OVER (PARTITION BY school_code, coalesce(major_group, '') ORDER BY image_id, row_id) AS rn FROM {rows} WHERE {good}) x WHERE rn = 1"""


@query("F13_load_recognised_records", _LOADED.format(rows="item_records", good=_OK))
def load_recognised_records(t):
    return _loaded(t, _records(t))


# The whole chain on parsed records: items, rows, records by line, audit and gate per batch of images, load of what passed.
_PARSED = f"""
pr AS (SELECT image_id, r + 2 AS row_id, code AS school_code, CASE WHEN image_id % 2 = 0 THEN '清华大学' ELSE CASE event_id % 5 WHEN 0 THEN '武汉大学' WHEN 1 THEN '北京大学' WHEN 2 THEN '4' ELSE '清华大学' END END AS school_name,
  CASE WHEN image_id % 2 = 0 THEN 'A05组' ELSE CASE event_id % 5 WHEN 0 THEN '第01组' WHEN 3 THEN 'A05组' WHEN 4 THEN 'A05组' END END AS major_group, CAST(score AS DOUBLE) AS min_score FROM item_rows WHERE score IS NOT NULL),
{_rates('pr WHERE ' + _OK, 'p')}, n AS (SELECT image_id, count(*) AS parsed_rows FROM pr GROUP BY 1),
cl AS (SELECT image_id, coalesce(parsed_rows >= 5 AND rows > 0 AND greatest(sn, gn, mn) <= 0.2 + 1e-12 AND bad <= 0.2, false) AS clean FROM n LEFT JOIN pq USING (image_id)),
gt AS (SELECT image_id % 40 AS batch_no, count(*) FILTER (clean) >= 0.5 * count(*) AS passed FROM cl GROUP BY 1)"""


@query("F13_recognised_chain", f"WITH {_PARSED}, ok AS (SELECT pr.* FROM pr JOIN gt ON pr.image_id % 40 = gt.batch_no WHERE passed) " + _LOADED.format(rows="ok", good=_OK))
def recognised_chain(t):
    # Even images hold sound names throughout, so their batches pass the gate and the odd ones do not.
    name = (F.col("image_id") % 2 == 0) & (F.col("item_id") % 20 == 1)
    cells = _table_items(t).withColumn("text", F.when(name, "清华大学A05组").otherwise(F.col("text")))
    parsed = items.records_by_line(items.row_texts(items.cluster_rows(cells), "item_id"))
    records = cut_lineage(parsed.select(
        "image_id", "row_id", F.lit(2024).alias("year"), F.lit("湖北").alias("province"), F.lit("物理类").alias("subject_type"), F.lit("本科批").alias("batch"), F.lit("普通类").alias("admission_category"),
        "school_code", "school_name", "major_group", "min_score", F.col("min_score").cast("int").alias("min_rank"), "notes",
    ))
    audits = _audited(t, records).withColumns({"corrupted": F.lit(False), "batch_no": F.col("image_id") % 40})
    gates = items.batch_gate(audits, "batch_no", ratio=0.5)
    passed = gates.where("passed").select("batch_no")
    return _loaded(t, records.join(passed, F.col("image_id") % 40 == F.col("batch_no"), "left_semi"))
