"""CSV source of school metadata, and the sinks: partitioned CSV, manifest, JSON reports, rejects, records."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import flag, text_or_empty, text_or_null
from ..operators.load import METADATA
from ..operators.stats import stack

# Exported columns with their display names, and the row order, per record type.
EXPORTS = {
    "school": (
        (("year", "年份"), ("province", "省份"), ("subject_type", "科类"), ("admission_category", "招生类别"), ("batch", "批次"), ("school_name", "院校名称"), ("school_code", "院校代号"),
         ("major_group", "专业组"), ("min_score", "投档最低分"), ("min_rank", "位次"), ("plan_count", "计划数"), ("tie_breaker_text", "同分排序项"), ("source_url", "来源")),
        ("batch", "subject_type", "-min_score", "school_name"),
    ),
    "major": (
        (("year", "年份"), ("province", "省份"), ("school_name", "院校名称"), ("school_code", "院校代号"), ("major_name", "专业名称"), ("major_code", "专业代号"), ("subject_type", "科类"),
         ("major_group", "专业组"), ("min_score", "最低分"), ("avg_score", "平均分"), ("max_score", "最高分"), ("min_rank", "位次"), ("source_url", "来源")),
        ("school_name", "major_name"),
    ),
    "control": (
        (("year", "年份"), ("province", "省份"), ("subject_type", "科类"), ("batch", "批次"), ("score", "控制线分数"), ("source_url", "来源")), ("batch", "subject_type"),
    ),
    "rank": (
        (("year", "年份"), ("province", "省份"), ("subject_type", "科类"), ("score", "分数"), ("same_score_count", "同分人数"), ("cumulative_count", "累计人数"), ("source_url", "来源")),
        ("subject_type", "-score"),
    ),
}


def clean_metadata_rows(raw: DataFrame) -> DataFrame:
    """Text rows of the metadata file: rows without standard name or province are left out, flags read, blanks null."""
    missing = [c for c in ("standard_name", "province") if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")

    def cell(c: str):
        return F.col(c) if c in raw.columns else F.lit(None).cast("string")

    out = raw.select(*[(F.coalesce(flag(cell(c)), F.lit(False)) if c.startswith("is_") else text_or_null(cell(c))).alias(c) for c in METADATA])
    out = out.withColumn("province", rules.province_name(F.col("province"))).withColumn("school_name", F.coalesce("school_name", "standard_name"))
    return out.where((text_or_empty(F.col("standard_name")) != "") & (F.col("province") != ""))


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    return clean_metadata_rows(spark.read.option("header", True).option("encoding", "UTF-8").csv(path))


def export_frame(df: DataFrame, record_type: str, years: list[int] | None = None) -> DataFrame:
    """Export rows under their display names, with the two partition keys in front."""
    if record_type not in EXPORTS:
        raise ValueError(f"unknown record type: {record_type}")
    columns, _ = EXPORTS[record_type]
    rows = df.where(text_or_empty(F.col("province")) != "")
    if years:
        rows = rows.where(F.col("year").isin(*years))
    named = [(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(label) for c, label in columns]
    return rows.select(F.col("year").alias("year_key"), F.col("province").alias("province_key"), *named)


def export_csv(df: DataFrame, record_type: str, path: str, years: list[int] | None = None) -> None:
    """One folder per province and year. Rows are range-partitioned by the full order, so a large
    province and year is cut into several ordered files instead of meeting in one task."""
    labels = dict(EXPORTS[record_type][0])
    order = [F.col(labels[c.lstrip("-")]).desc_nulls_last() if c.startswith("-") else F.col(labels[c]).asc_nulls_first() for c in EXPORTS[record_type][1]]
    frame = export_frame(df, record_type, years)
    full = ["province_key", F.desc("year_key"), *order]
    out = frame.repartitionByRange(*full).sortWithinPartitions(*full).withColumnsRenamed({"province_key": "province", "year_key": "year"})
    out.write.mode("overwrite").partitionBy("province", "year").option("header", True).csv(path)


def export_manifest(tables: dict[str, DataFrame], years: list[int] | None = None) -> DataFrame:
    """Rows per (record type, province, year), with totals and the number of files, as one rollup."""
    frames = [export_frame(df, name, years).select(F.lit(name).alias("record_type"), F.col("province_key").alias("province"), F.col("year_key").alias("year")) for name, df in tables.items()]
    return _manifest(stack(frames).groupBy("record_type", "province", "year").agg(F.count("*").alias("rows")))


def written_manifest(written: DataFrame) -> DataFrame:
    """The same manifest from the files (record_type, file, rows) that were written, by the folders they lie in."""
    part = lambda name: F.regexp_extract("file", f"{name}=([^/]*)/", 1)
    counts = written.select("record_type", part("province").alias("province"), part("year").cast("int").alias("year"), "rows")
    return _manifest(counts.groupBy("record_type", "province", "year").agg(F.sum("rows").alias("rows")))


def _manifest(counts: DataFrame) -> DataFrame:
    sums = counts.rollup("record_type", "province", "year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "file").when(F.col("gid") == 1, "province").when(F.col("gid") == 3, "record_type").otherwise("total")
    return sums.withColumn("level", level).drop("gid")


def export_provinces(df: DataFrame, years: list[int] | None = None) -> DataFrame:
    rows = df.where(text_or_empty(F.col("province")) != "")
    if years:
        rows = rows.where(F.col("year").isin(*years))
    return rows.select("province").distinct().orderBy("province")


def save_csv(df: DataFrame, path: str) -> None:
    out = df.write.mode("overwrite").option("header", True)
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def save_report(report: DataFrame, path: str) -> None:
    """A report of one or several years (column report_year) as JSON lines."""
    report.write.mode("overwrite").json(path)


def typed_records(df: DataFrame, record_type: str) -> DataFrame:
    """Rows as JSON records tagged with their type; missing values are left out."""
    return df.select(F.to_json(F.struct(*df.columns, F.lit(record_type).alias("_record_type"))).alias("record"))


def check_read_only(spark: SparkSession, sql: str) -> None:
    """Raise ValueError unless the text is one query: the parsed plan must hold no command and no statement that writes.

    ``spark.sql`` runs commands (DDL, SET, INSERT and the like) at once, so the plan is parsed and looked at before.
    """
    kind = spark.sparkContext._jvm.java.lang.Class.forName
    package = "org.apache.spark.sql.catalyst.plans.logical"
    refused = [kind(f"{package}.{name}") for name in ("Command", "ParsedStatement", "InsertIntoDir")]
    waiting = [spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)]
    while waiting:
        plan = waiting.pop()
        if any(c.isInstance(plan) for c in refused):
            raise ValueError(f"only queries are allowed, not {plan.nodeName()}")
        for part in (plan.children(), plan.innerChildren()):
            waiting += [part.apply(i) for i in range(part.size()) if kind(f"{package}.LogicalPlan").isInstance(part.apply(i))]


def query_tables(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """SQL with named parameters over the given tables, which it names in braces. Anything but a query is refused before it runs."""
    check_read_only(spark, re.sub(r"\{(\w+)\}", r"`\1`", sql))
    return spark.sql(sql, args=args, **tables)


def reject_preview(failed: DataFrame, cells: DataFrame, headers: DataFrame, columns: DataFrame) -> DataFrame:
    """Failed files with header row, mapped columns and the cells of their first 30 rows.

    ``failed``: file_id, record_type, error. ``headers``: file_id, header_row. ``columns``: file_id, header, canonical.
    """
    names = columns.groupBy("file_id").agg(
        F.array_join(F.array_sort(F.collect_set("header")), "|").alias("parsed_columns"), F.array_join(F.array_sort(F.collect_set("canonical")), "|").alias("normalized_columns")
    )
    first = cells.where("row_idx < 30").select("file_id", "row_idx", "col_idx", "value")
    return failed.join(headers.select("file_id", "header_row"), "file_id", "left").join(names, "file_id", "left").join(first, "file_id", "left")
