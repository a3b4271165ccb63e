"""Fixed dimensions: availability and coverage of provinces, and display labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rules import DEFAULT_QUERY_MODES, labelled

# Display labels.
READABLE_LABELS = {"full": "是", "partial": "部分", "none": "否", "unknown": "未知"}
IMPORT_LABELS = {
    "imported": "已入库", "downloaded_not_imported": "已下载未入库", "parsed": "已解析入库", "unsupported_pdf_table": "不支持（PDF 表格）",
    "parsed_or_unsupported": "已解析 / 不支持", "imported_partial": "部分已入库", "not_started": "未开始", "plugin_ready": "插件就绪", "pending": "待验证",
}
MODE_LABELS = {
    "score": "按分数", "rank": "按位次", "mixed": "混合", "unsupported": "不支持", "unsupported_pdf_or_image": "不支持（PDF/图片源）", "unknown": "未知",
}
# Access state of a province that states none.
DEFAULT_ACCESS = {
    "江苏": "available", "山东": "available", "浙江": "available", "福建": "waf_blocked", "河北": "connection_reset", "河南": "verification_required",
    "广东": "partial", "湖北": "available", "湖南": "unknown", "辽宁": "unknown", "重庆": "unknown",
}
STRUCTURED = ("江苏", "浙江", "山东", "广东")
SOURCE_AWARE = ("河南", "福建", "河北", "湖北", "湖南", "辽宁", "重庆")
COVERAGE_TYPES = ("school", "rank", "control", "major")

# Province, year, discovery, download, import, format, readable, level, mode, access, notes.
AVAILABILITY = (
    ("江苏", 2021, "discovered", "downloaded", "imported", "Excel", True, None, "score", "available", "school / rank / control 均已入库"),
    ("江苏", 2022, "discovered", "downloaded", "imported", "Excel", True, None, "score", "available", "school / rank / control 均已入库"),
    ("江苏", 2023, "discovered", "downloaded", "imported", "Excel", True, None, "score", "available", "school / rank / control 均已入库"),
    ("江苏", 2024, "discovered", "downloaded", "imported", "Excel", True, None, "score", "available", "school / rank / control 均已入库"),
    ("浙江", 2024, "discovered", "downloaded", "imported", "Excel", True, None, "score", "available", "普通类一、二段平行投档 Excel 已入库"),
    ("山东", 2024, "discovered", "downloaded", "imported", "Excel", True, None, "rank", "available", "常规批投档表以 min_rank 为主，推荐按位次查询"),
    ("河南", 2024, "discovered", "downloaded", "downloaded_not_imported", "RAR + image Word + verification page", False, None, "unsupported_pdf_or_image", "verification_required",
     "公开 RAR 内为图片型 Word；官方数据中心需验证码，不绕过"),
    ("广东", 2024, "discovered", "downloaded", "imported_partial", "ZIP + machine-readable PDF", False, "partial", "score", "partial", "普通类历史/物理已入库；艺体类已下载但暂不建模"),
    ("福建", 2024, "discovered", "not_started", "not_started", "Excel / PDF", True, None, "score", "waf_blocked", "普通类本科/专科投档；艺体类 skipped_unsupported_category"),
    ("河北", 2024, "discovered", "not_started", "not_started", "Excel / PDF", True, None, "score", "connection_reset", "普通类本科/专科专业粒度投档；艺体/对口 skipped_unsupported_category"),
    ("湖北", 2024, "discovered", "downloaded_not_imported", "unsupported_pdf_or_image", "PNG images (hbccks.cn)", False, None, "unsupported_pdf_or_image", "available",
     "2024 普通类本科/专科投档线已发现（hbccks 官方页面）；表格为 PNG 图片，无 OCR 不入库"),
    ("湖南", 2024, "plugin_ready", "pending", "pending", "unknown", False, "unknown", "unknown", "unknown", "Phase 18 插件骨架；待补 seed 或列表页 URL 后验证"),
    ("辽宁", 2024, "plugin_ready", "pending", "pending", "unknown", False, "unknown", "unknown", "unknown", "Phase 18 插件骨架；待补 seed 或列表页 URL 后验证"),
    ("重庆", 2024, "plugin_ready", "pending", "pending", "unknown", False, "unknown", "unknown", "unknown", "Phase 18 插件骨架；待补 seed 或列表页 URL 后验证"),
)
AVAILABILITY_SCHEMA = (
    "province string, year int, school_discovery_status string, school_download_status string, school_import_status string, "
    "source_format string, machine_readable boolean, machine_readable_level string, query_mode string, access_status string, notes string"
)


def availability(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AVAILABILITY, AVAILABILITY_SCHEMA)


def default_access(province: Column) -> Column:
    return labelled(province, DEFAULT_ACCESS, F.lit("unknown"))


def with_access(rows: DataFrame) -> DataFrame:
    """Availability rows with the default access state of the province where none is stated."""
    stated = F.nullif("access_status", F.lit(""))
    return rows.withColumn("access_status", F.coalesce(stated, default_access(F.col("province"))))


def display_rows(rows: DataFrame) -> DataFrame:
    """Availability rows with labels for the codes; unknown codes stay as they are."""
    def label(column: str, labels: dict) -> Column:
        return labelled(F.col(column), labels, F.col(column))

    level = F.nullif("machine_readable_level", F.lit(""))
    return with_access(rows).select(
        "province", "year",
        F.coalesce(labelled(level, READABLE_LABELS, level), F.when(F.col("machine_readable"), "是").otherwise("否")).alias("readable"),
        label("school_import_status", IMPORT_LABELS).alias("import_label"), label("query_mode", MODE_LABELS).alias("mode_label"), "access_status",
        "source_format", "notes",
    )


def overview(rows: DataFrame, year: int) -> DataFrame:
    """Counts per access state and per query mode of one year."""
    r = with_access(rows).where(F.col("year") == year)
    long = r.select(F.explode(F.array(
        F.struct(F.lit("access_status").alias("field"), F.col("access_status").alias("value")),
        F.struct(F.lit("query_mode").alias("field"), F.coalesce("query_mode", F.lit("mixed")).alias("value")),
    )).alias("e"))
    return long.groupBy("e.field", "e.value").agg(F.count("*").alias("n"))


def group_counts(provinces: DataFrame) -> DataFrame:
    """Registered provinces present in a table, by kind."""
    kinds = provinces.groupBy("province").agg(F.count("*").alias("n"))
    return kinds.agg(
        F.count_if(F.col("province").isin(*STRUCTURED)).alias("structured_count"),
        F.count_if(F.col("province").isin(*SOURCE_AWARE)).alias("source_aware_count"), F.sum("n").alias("school_total"),
    )


def coverage(entries: DataFrame) -> DataFrame:
    """Year range, record types and query mode per province from (province, year, data_type)."""
    sums = entries.groupBy("province").agg(F.min("year").alias("lo"), F.max("year").alias("hi"), F.collect_set("data_type").alias("types"))
    ordered = F.filter(F.array(*[F.lit(k) for k in COVERAGE_TYPES]), lambda k: F.array_contains("types", k))
    return sums.select(
        "province", F.concat(F.col("lo").cast("string"), F.lit("-"), F.col("hi").cast("string")).alias("year_range"),
        F.coalesce(F.nullif(F.array_join(ordered, "、"), F.lit("")), F.lit("—")).alias("data_types"),
        labelled(F.col("province"), DEFAULT_QUERY_MODES, F.lit("mixed")).alias("query_mode"),
    )
