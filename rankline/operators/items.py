"""Recognised text items of images to rows, quality audits and engine choice.

Input is one long table of items: ``image_id``, ``x_center``, ``y_center``, ``text``, plus an item id.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import (
    box_centre, first_number, invalid_school_name, natural_key, row_line, school_name, split_group, strip, text_or_empty, text_or_null,
)

Y_TOLERANCE = 18.0
# Words of header and note rows, column aliases, and the limits of the gates.
HEADER_MARKERS = ("院校专业组代号", "院校专业组名称", "类别", "投档线", "备注")
COLUMN_ALIASES = (
    ("school_code", ("院校专业组代号", "院校代号", "代号")), ("major_group_name", ("院校专业组名称", "院校专业组")),
    ("subject_type", ("类别",)), ("min_score", ("投档线", "最低分")), ("notes", ("备注",)),
)
LINE_NOTES = ("说明", "备注：", "合计", "单位：", "平行志愿投档线", "末位投档")
TABLE_NOTES = ("说明", "备注：", "合计", "单位：")
COUNT_NOTES = ("说明", "备注：", "合计", "单位：", "末位投档")
HEADER_SCAN_ROWS = 12
CELL_RANGE = (4, 6)
SCORE_RANGE = (100.0, 750.0)
PASS_RATIO = 0.80
KEY_FIELDS = ("school_name", "major_group", "min_score")
ITEM_TYPE = "array<struct<text:string,score:double,box:array<array<double>>,x_center:double,y_center:double>>"


def load_items(raw: Column) -> Column:
    """Stored item list of an image; null when the text is no JSON list."""
    is_list = F.startswith(strip(raw), F.lit("["))
    return F.when(is_list, F.from_json(raw, ITEM_TYPE, {"mode": "PERMISSIVE"}))


def explode_items(images: DataFrame, raw: str) -> DataFrame:
    """One row per non-blank item, with its place in the list."""
    items = images.withColumn("_items", load_items(F.col(raw))).select("*", F.posexplode("_items").alias("item_no", "_item")).drop("_items", raw)
    return items.select("*", "_item.*").drop("_item").where(text_or_empty(F.col("text")) != "")


def engine_items(images: DataFrame, raw: str) -> DataFrame:
    """Items of the two engine layouts: lists of [box, [text, score]] lines, or parallel arrays of texts, scores and boxes."""
    line = "array<array<struct<box:array<array<double>>,text:string,score:double>>>"
    page = "struct<rec_texts:array<string>,rec_scores:array<double>,rec_polys:array<array<array<double>>>>"
    pages = F.from_json(F.col(raw), page)
    modern = F.arrays_zip(pages["rec_texts"].alias("text"), pages["rec_scores"].alias("score"), pages["rec_polys"].alias("box"))
    legacy = F.transform(F.flatten(F.from_json(F.col(raw), line)), lambda i: F.struct(i["text"].alias("text"), i["score"].alias("score"), i["box"].alias("box")))
    items = F.when(F.startswith(strip(F.col(raw)), F.lit("{")), modern).otherwise(legacy)
    rows = images.select("*", F.posexplode(items).alias("item_no", "i")).drop(raw)
    rows = rows.withColumn("text", text_or_null(F.col("i.text"))).where("text IS NOT NULL")
    return rows.select("*", F.col("i.score").alias("score"), box_centre(F.col("i.box")).alias("c")).select("*", "c.*").drop("i", "c")


def line_numbers(items: DataFrame, tolerance: float = Y_TOLERANCE) -> DataFrame:
    """Row number per distinct (image_id, y_center).

    Items sorted by y join the current row while they are within the tolerance of its running mean. Items of equal y always share a row, because
    the mean never exceeds the last y. So only the distinct heights form a sequence, with the number of items as weight: its length is bounded
    by the pixel heights of an image and not by its items. One pass over the sorted heights carries (row, mean, n), and takes time in proportion to them.
    """
    heights = items.groupBy("image_id", F.col("y_center").alias("y")).agg(F.count("*").alias("n"))

    def run(batches):
        image = row = mean = weight = None
        for batch in batches:
            rows = []
            for i, y, n in zip(batch["image_id"].to_pylist(), batch["y"].to_pylist(), batch["n"].to_pylist(), strict=True):
                if row is None or i != image:
                    image, row, mean, weight = i, 0, y, n
                elif abs(y - mean) <= tolerance:
                    mean, weight = (mean * weight + y * n) / (weight + n), weight + n
                else:
                    row, mean, weight = row + 1, y, n
                rows.append(row)
            yield pa.RecordBatch.from_arrays([batch["image_id"], batch["y"], pa.array(rows, pa.int32())], names=["image_id", "y_center", "row_id"])

    schema = f"image_id {items.schema['image_id'].dataType.simpleString()}, y_center double, row_id int"
    ordered = heights.select("image_id", F.col("y").cast("double").alias("y"), "n").repartition("image_id").sortWithinPartitions("image_id", "y")
    return ordered.mapInArrow(run, schema)


def cluster_rows(items: DataFrame, tolerance: float = Y_TOLERANCE) -> DataFrame:
    """Items with the number of their row in the image."""
    return items.join(line_numbers(items, tolerance), ["image_id", "y_center"])


def row_texts(rows: DataFrame, item_id: str) -> DataFrame:
    """Text and cell count per row, cells from left to right."""
    parts = F.array_sort(F.collect_list(F.struct("x_center", "y_center", F.col(item_id).alias("i"), "text")))
    return rows.groupBy("image_id", "row_id").agg(parts.alias("p")).select(
        "image_id", "row_id", F.array_join(F.transform("p", lambda c: c["text"]), " ").alias("line"), F.size("p").alias("cells")
    )


def header_line(lines: DataFrame) -> DataFrame:
    """First header row among the first rows of an image; title rows do not count."""
    line = F.col("line")
    title = F.contains(line, F.lit("湖北省")) & F.contains(line, F.lit("投档"))
    marks = sum((F.contains(line, F.lit(m)).cast("int") for m in HEADER_MARKERS[1:]), F.contains(line, F.lit(HEADER_MARKERS[0])).cast("int"))
    named = F.contains(line, F.lit("院校")) & rules.any_in(line, ("投档", "代号"))
    hits = lines.where((F.col("row_id") < HEADER_SCAN_ROWS) & ~title & ((marks >= 2) | named))
    return hits.groupBy("image_id").agg(F.min("row_id").alias("header_row"))


def assigned_cells(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Text per row and field: a cell belongs to the header nearest in x (the left one on ties), the last cell of a field wins.

    The nearest header is the one before or after a position, so it is found for the distinct
    positions of an image by two running values instead of pairing cells with headers.
    """
    placed = rows.join(headers, "image_id")
    tops = placed.where("row_id = header_row").groupBy("image_id", "x_center").agg(F.min_by(strip(F.col("text")), F.struct("y_center", "item_id")).alias("header"))
    body = placed.where("row_id > header_row").drop("header_row")
    points = tops.select("image_id", "x_center", "header").unionByName(
        body.select("image_id", "x_center").distinct().withColumn("header", F.lit(None).cast("string"))
    )
    points = points.withColumn("h", F.when(F.col("header").isNotNull(), F.struct("x_center", "header"))).withColumn("is_header", F.col("header").isNotNull().cast("int"))
    left = Window.partitionBy("image_id").orderBy("x_center", F.desc("is_header")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    right = Window.partitionBy("image_id").orderBy(F.desc("x_center"), F.desc("is_header")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    points = points.withColumn("l", F.last("h", ignorenulls=True).over(left)).withColumn("r", F.last("h", ignorenulls=True).over(right)).where("is_header = 0")
    closer_left = (F.col("x_center") - F.col("l.x_center")) <= (F.col("r.x_center") - F.col("x_center"))
    nearest = F.when(F.col("r").isNull() | closer_left, F.col("l.header")).otherwise(F.col("r.header"))
    nearest = F.coalesce(nearest, F.col("r.header"), F.col("l.header"))
    field = None
    for name, words in COLUMN_ALIASES:
        field = (F if field is None else field).when(rules.any_in(F.col("nearest"), words), F.lit(name))
    named = points.withColumn("nearest", nearest).select("image_id", "x_center", field.alias("field")).where("field IS NOT NULL")
    return body.join(named, ["image_id", "x_center"]).groupBy("image_id", "row_id", "field").agg(
        F.max_by(strip(F.col("text")), F.struct("x_center", "y_center", "item_id")).alias("value")
    )


def records_by_header(rows: DataFrame, lines: DataFrame, subject: str | None = None, batch: str = "本科批") -> DataFrame:
    """Records of images with a header row."""
    cells = assigned_cells(rows, header_line(lines))
    names = [n for n, _ in COLUMN_ALIASES]
    wide = cells.groupBy("image_id", "row_id").agg(*[F.max(F.when(F.col("field") == n, F.nullif("value", F.lit("")))).alias(n) for n in names])
    wide = wide.join(lines.where(~rules.any_in(F.col("line"), TABLE_NOTES)).select("image_id", "row_id"), ["image_id", "row_id"], "left_semi")
    wide = wide.where("min_score IS NOT NULL OR major_group_name IS NOT NULL")
    wide = wide.withColumn("group_name", F.coalesce("major_group_name", "school_code", F.lit(""))).withColumn("score", first_number(F.col("min_score")))
    school, group = split_group(F.col("group_name"))
    wide = wide.withColumns({"school": F.nullif(school, F.lit("")), "group": F.nullif(group, F.lit(""))}).where("score IS NOT NULL OR school IS NOT NULL")
    return wide.select(
        "image_id", "row_id", F.coalesce("school_code", "school", "group_name").alias("school_code"), school_name(F.coalesce("school", "group_name")).alias("school_name"),
        F.col("group").alias("major_group"), F.coalesce(rules.subject_name(F.col("subject_type")), F.lit(subject).cast("string")).alias("subject_type"),
        F.lit(batch).alias("batch"), F.col("score").alias("min_score"), F.lit(rules.DEFAULT_CATEGORY).alias("admission_category"), "notes",
    )


def records_by_line(lines: DataFrame) -> DataFrame:
    """Records of images whose rows follow the code, name, requirement, score pattern."""
    line = F.col("line")
    heading = F.contains(line, F.lit("院校专业")) & rules.any_in(line, ("代号", "名称"))
    data = lines.where(~rules.any_in(line, LINE_NOTES) & ~heading).select("image_id", "row_id", row_line(line).alias("r")).where("r IS NOT NULL")
    return data.select("image_id", "row_id", "r.school_code", school_name(F.col("r.school_name")).alias("school_name"), "r.major_group", "r.min_score", "r.notes")


def parse_status(images: DataFrame, items: DataFrame, headers: DataFrame, records: DataFrame) -> DataFrame:
    """Status per image from what each step found; images read by line pattern need no header."""
    n_items = items.groupBy("image_id").agg(F.count("*").alias("items"))
    n_records = records.groupBy("image_id").agg(F.count("*").alias("parsed_rows"))
    joined = images.join(n_items, "image_id", "left").join(headers, "image_id", "left").join(n_records, "image_id", "left")
    status = (
        F.when(F.coalesce("items", F.lit(0)) == 0, "no_text_detected")
        .when(~F.col("by_line") & F.col("header_row").isNull(), "table_reconstruction_failed")
        .when(F.coalesce("parsed_rows", F.lit(0)) == 0, "table_reconstruction_failed").otherwise("parsed")
    )
    return joined.select(images["*"], status.alias("status"), F.coalesce("parsed_rows", F.lit(0)).alias("parsed_rows"))


# ---- quality gates ----

def _null_rate(column: str) -> Column:
    return F.avg((text_or_empty(F.col(column)) == "").cast("double"))


def field_quality(records: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Rates and score range per image; an image without records has rates of a missing table."""
    named = text_or_empty(F.col("school_name")) != ""
    q = records.groupBy("image_id").agg(
        F.count("*").alias("rows"), *[_null_rate(f).alias(f"{f}_null_rate") for f in KEY_FIELDS],
        F.coalesce(F.try_divide(F.count_if(invalid_school_name(F.col("school_name"))), F.count_if(named)), F.lit(0.0)).alias("invalid_rate"),
        F.min("min_score").alias("score_min"), F.max("min_score").alias("score_max"),
    )
    if images is not None:
        q = images.join(q, "image_id", "left").fillna({"rows": 0, **{f"{f}_null_rate": 1.0 for f in KEY_FIELDS}, "invalid_rate": 0.0})
    return q.withColumn("fields_complete", F.greatest(*[F.col(f"{f}_null_rate") for f in KEY_FIELDS]) <= F.lit(0.2) + F.lit(1e-12))


def quality_summary(quality: DataFrame) -> DataFrame:
    rates = [F.round(1 - F.col(f"{f}_null_rate"), 4).alias(f"{f}_non_null_rate") for f in KEY_FIELDS]
    return quality.select("image_id", *rates, F.round("invalid_rate", 4).alias("school_name_invalid_rate"), "score_min", "score_max")


def irregular_rows(lines: DataFrame) -> DataFrame:
    """Whether more than 30 % of the data rows of an image have an unusual number of cells; true without data rows."""
    line = F.col("line")
    title = F.contains(line, F.lit("湖北省")) & F.contains(line, F.lit("投档"))
    data = ~rules.any_in(line, HEADER_MARKERS) & ~title & ~rules.any_in(line, COUNT_NOTES) & (F.col("cells") >= 3)
    bad = ~F.col("cells").between(*CELL_RANGE)
    return lines.groupBy("image_id").agg(
        F.coalesce(F.try_divide(F.count_if(data & bad), F.count_if(data)) > 0.30, F.lit(True)).alias("irregular")
    )


def suspicious_flags(audits: DataFrame) -> DataFrame:
    """Flags per image. Input: status, parsed_rows, valid_rows and the columns of ``field_quality``."""
    some = F.col("rows") > 0
    flags = F.array_compact(F.array(
        F.when(F.col("status") != "parsed", F.concat(F.lit("ocr_status_"), F.col("status"))),
        F.when(F.col("parsed_rows") < 5, "too_few_parsed_rows"), F.when(F.col("valid_rows") == 0, "no_valid_rows"),
        F.when((F.col("score_min") < SCORE_RANGE[0]) | (F.col("score_max") > SCORE_RANGE[1]), "min_score_out_of_range"),
        F.when(some & (F.col("school_name_null_rate") > 0.20), "high_school_name_null_rate"), F.when(some & (F.col("invalid_rate") > 0.20), "invalid_school_name_pattern"),
        F.when(some & (F.col("major_group_null_rate") > 0.20), "high_major_group_null_rate"), F.when(~some | ~F.col("fields_complete"), "column_count_anomaly"),
    ))
    return audits.withColumn("suspicious_flags", flags)


def sample_rows(records: DataFrame, limit: int = 10) -> DataFrame:
    """First records of each image as JSON; the group limit keeps that many per image and map task."""
    w = Window.partitionBy("image_id").orderBy("row_id")
    top = records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
    row = F.to_json(F.struct("school_code", "school_name", "major_group", "min_score", "notes"))
    return top.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("_rn", row.alias("j")))).alias("s")).select(
        "image_id", F.transform("s", lambda x: x["j"]).alias("sample_rows")
    )


def audit(images: DataFrame, records: DataFrame, status: DataFrame) -> DataFrame:
    """Per image: parsed, valid and invalid rows, quality of the valid rows (of all rows when none is valid), and flags."""
    from .validate import row_error

    checked = records.withColumn("error", row_error("school"))
    counts = checked.groupBy("image_id").agg(F.count_if(F.col("error").isNull()).alias("valid_rows"), F.count("error").alias("invalid_rows"))
    judged = checked.join(counts.select("image_id", "valid_rows"), "image_id").where("error IS NULL OR valid_rows = 0").drop("valid_rows")
    joined = field_quality(judged, images).join(status.select("image_id", "status", "parsed_rows"), "image_id").join(counts, "image_id", "left")
    return suspicious_flags(joined.fillna(0, ["valid_rows", "invalid_rows"]))


def batch_gate(audits: DataFrame, *keys: str, ratio: float = PASS_RATIO) -> DataFrame:
    """Share of images without flags among those that are not corrupted; passes at ``ratio``."""
    good = ~F.col("corrupted")
    sums = audits.groupBy(*keys).agg(
        F.count("*").alias("audited"), F.count_if(good).alias("eligible"), F.count_if(good & (F.size("suspicious_flags") == 0)).alias("clean")
    )
    share = F.coalesce(F.try_divide("clean", "eligible"), F.lit(0.0))
    return sums.withColumn("clean_ratio", F.round(share, 4)).withColumn("passed", (F.col("eligible") > 0) & (share >= ratio))


def allowed_loads(requests: DataFrame, gates: DataFrame, *keys: str) -> DataFrame:
    """Requested keys with whether their batch passed; a key without a batch did not."""
    passed = gates.where("passed").select(*keys, F.lit(True).alias("allowed"))
    return requests.join(passed, list(keys), "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def compare_engines(audits: DataFrame) -> DataFrame:
    """Slow baseline against fast engine per image. Input: image_id, engine (base or fast), status, valid_rows,
    seconds, cache_hit, score_min, score_max, invalid_rate, suspicious_flags."""
    base = audits.where("engine = 'base'").select("image_id", F.struct("status", "valid_rows", "seconds", "cache_hit", "score_min", "score_max").alias("b"))
    fast = audits.where("engine = 'fast'").select("image_id", F.struct("status", "valid_rows", "seconds", "score_min", "score_max", "invalid_rate", "suspicious_flags").alias("f"))
    both = base.join(fast, "image_id", "full")
    b_rows, f_rows = F.coalesce("b.valid_rows", F.lit(0)), F.coalesce("f.valid_rows", F.lit(0))
    missing = F.col("b").isNull() | (F.col("b.status") == "baseline_missing")
    ranged = F.col("b.score_min").isNotNull() & F.col("f.score_min").isNotNull()
    overlap = (F.col("f.score_min") <= F.col("b.score_max")) & (F.col("b.score_min") <= F.col("f.score_max"))
    fair = F.coalesce(F.col("f.score_min").between(*SCORE_RANGE) & F.col("f.score_max").between(*SCORE_RANGE), F.lit(False))
    usable = ~missing & (b_rows > 0)
    reasons = F.array_compact(F.array(
        F.when(missing, "baseline_missing"), F.when(~missing & (b_rows == 0), "baseline_zero_valid_rows"),
        F.when(usable & (f_rows < 0.8 * b_rows), "valid_rows_ratio_low"), F.when(usable & (F.size("f.suspicious_flags") > 0), "suspicious_flags"),
        F.when(usable & ~fair, "min_score_range_unreasonable"), F.when(usable & (F.col("f.invalid_rate") >= 0.05), "school_name_invalid_rate"),
    ))
    speed = F.when(~F.col("b.cache_hit") & (F.col("b.seconds") > 0) & (F.col("f.seconds") > 0), F.round(F.col("b.seconds") / F.col("f.seconds"), 2))

    def good(side: str) -> Column:
        return F.coalesce((F.col(f"{side}.status") == "parsed") & (F.col(f"{side}.valid_rows") > 0), F.lit(False))

    return both.select(
        "image_id", F.when(usable, F.round(f_rows / b_rows, 4)).alias("row_count_ratio"), F.when(~missing, F.when(ranged, overlap).otherwise(False)).alias("score_range_match"),
        (F.size(reasons) == 0).alias("acceptable"), reasons.alias("reasons"), speed.alias("speedup"), good("b").alias("base_success"), good("f").alias("fast_success"),
    )


def comparison_summary(comparisons: DataFrame) -> DataFrame:
    return comparisons.agg(
        F.count("*").alias("image_count"), F.round(F.avg("speedup"), 2).alias("avg_speedup"), F.round(F.avg("row_count_ratio"), 4).alias("avg_row_count_ratio"),
        F.count_if("acceptable").alias("acceptable_count"), F.count_if("base_success").alias("base_success_count"), F.count_if("fast_success").alias("fast_success_count"),
    )


def fast_engine_gate(audits: DataFrame, baselines: DataFrame) -> DataFrame:
    """Reasons against the fast result of an image, judged by the baseline rows or a fixed minimum. Baselines: image_id, base_rows."""
    joined = audits.join(baselines, "image_id", "left")
    based = F.coalesce(F.col("base_rows") > 0, F.lit(False))
    rates = [F.when(F.col("rows").isNull() | (F.col("rows") == 0) | (F.round(1 - F.col(f"{f}_null_rate"), 4) < 0.95), f"{f}_non_null_rate") for f in KEY_FIELDS]
    reasons = F.array_compact(F.array(
        F.when(F.col("status") != "parsed", F.concat(F.lit("ocr_status_"), F.col("status"))),
        F.when(based & (F.col("valid_rows") < 0.8 * F.col("base_rows")), "valid_rows_below_baseline"),
        F.when(~based & (F.col("valid_rows") < 40), "valid_rows_below_min"), F.when(F.size("suspicious_flags") > 0, "suspicious_flags"),
        F.when((F.col("rows") > 0) & (F.round("invalid_rate", 4) >= 0.05), "school_name_invalid_rate"),
        F.when(F.col("score_min").isNull(), "min_score_range_missing")
        .when((F.col("score_min") < SCORE_RANGE[0]) | (F.col("score_max") > SCORE_RANGE[1]), "min_score_out_of_range"), *rates,
    ))
    return joined.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def choose_engine(gated: DataFrame, cached: DataFrame) -> DataFrame:
    """fast when accepted, else the cached baseline, else no result. Cached: image_id with a stored baseline."""
    joined = gated.join(cached.select("image_id", F.lit(True).alias("has_base")), "image_id", "left")
    engine = F.when(F.col("accepted"), "fast").when(F.col("has_base"), "base")
    return joined.withColumn("engine_selected", engine).withColumn(
        "final_status", F.when(engine.isNull(), "fallback_required_but_no_cache").otherwise("parsed")
    ).drop("has_base")


def chosen_records(choice: DataFrame, fast: DataFrame, base: DataFrame) -> DataFrame:
    """Records of the engine chosen per image."""
    def part(rows: DataFrame, engine: str) -> DataFrame:
        return rows.join(choice.where(F.col("engine_selected") == engine).select("image_id"), "image_id", "left_semi").withColumn("engine", F.lit(engine))

    return part(fast, "fast").unionByName(part(base, "base"))


def cache_split(images: DataFrame, cache: DataFrame) -> DataFrame:
    """Images with whether their content was already read by the engine. Both: content_key, engine."""
    keys = ["content_key", "engine"]
    known = cache.select(*keys).distinct().withColumn("cache_hit", F.lit(True))
    return images.join(known, keys, "left").withColumn("cache_hit", F.coalesce("cache_hit", F.lit(False)))


def first_images(downloads: DataFrame, limit: int) -> DataFrame:
    """First distinct image paths in natural order; later titles break ties of equal names."""
    paths = downloads.groupBy("path").agg(F.min(F.struct("source_title", "attachment_title")).alias("t"))
    return paths.orderBy(natural_key(F.col("path")), F.col("t.source_title").asc_nulls_first(), F.col("t.attachment_title").asc_nulls_first(), "path").limit(limit).select("path", "t.*")
