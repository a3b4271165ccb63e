"""Data-quality report for all (year, province) at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import invalid_school_name, is_recognised_source, text_or_empty
from . import stats
from .ordered import with_next

EXPECTED_SUBJECTS = ("历史类", "物理类")
EMPTY = "(空)"


def distribution(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """Rows per (table, year, province, value); blank values are shown as one value."""
    frames = [
        df.select(F.lit(name).alias("table_name"), "year", "province", F.coalesce(F.nullif(column, F.lit("")), F.lit(EMPTY)).alias(column))
        for name, df in tables.items()
    ]
    return stats.count_by(stats.stack(frames), "table_name", "year", "province", column)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    frames = [df.select(F.lit(name).alias("table_name"), "year", "province") for name, df in tables.items()]
    return stats.count_by(stats.stack(frames), "table_name", "year", "province")


def score_ranges(schools: DataFrame, ranks: DataFrame) -> DataFrame:
    """Range of school scores per (year, province) and of rank scores per subject."""
    s = schools.select("year", "province", F.lit("*").alias("subject_type"), F.col("min_score").cast("double").alias("score"))
    r = ranks.select("year", "province", "subject_type", F.col("score").cast("double").alias("score"))
    return s.withColumn("scope", F.lit("school")).unionByName(r.withColumn("scope", F.lit("rank"))).groupBy(
        "scope", "year", "province", "subject_type"
    ).agg(F.min("score").alias("lo"), F.max("score").alias("hi"))


def blank_subjects(tables: dict[str, DataFrame], names: DataFrame) -> DataFrame:
    frames = [
        df.select(F.lit(f"{n}.subject_type").alias("field"), "year", "province", (F.coalesce("subject_type", F.lit("")) == "").alias("blank"))
        for n, df in tables.items()
    ]
    frames.append(names.select(F.lit("school.school_name").alias("field"), "year", "province", (F.coalesce("school_name", F.lit("")) == "").alias("blank")))
    return stats.stack(frames).groupBy("field", "year", "province").agg(F.count_if("blank").alias("blank"))


def monotonic_violations(ranks: DataFrame) -> DataFrame:
    """Neighbouring rows of a subject where the count falls although the score falls."""
    rows = ranks.where("cumulative_count IS NOT NULL").withColumn("pos", -F.col("score").cast("double"))
    pairs = with_next(rows, ["year", "province", "subject_type"], "pos", ["score", "cumulative_count"], width=50)
    return pairs.where("cumulative_count > next.cumulative_count").select(
        "year", "province", "subject_type", F.col("score").alias("higher_score"), F.col("cumulative_count").alias("higher_cum"),
        F.col("next.score").alias("lower_score"), F.col("next.cumulative_count").alias("lower_cum"),
    )


def missing_subjects(ranks: DataFrame, expected=EXPECTED_SUBJECTS) -> DataFrame:
    """Expected subjects without rows, per (year, province); blank subjects count as absent."""
    present = ranks.groupBy("year", "province").agg(
        *[F.bool_or(F.coalesce(F.col("subject_type") == s, F.lit(False))).alias(f"has_{i}") for i, s in enumerate(expected)]
    )
    gaps = F.array_compact(F.array(*[F.when(~F.col(f"has_{i}"), F.lit(s)) for i, s in enumerate(expected)]))
    return present.select("year", "province", F.explode(gaps).alias("subject_type"))


def recognised_share(schools: DataFrame) -> DataFrame:
    """Recognised rows, review flag and invalid names per (year, province)."""
    ocr = is_recognised_source(F.col("source_url"))
    bad = ocr & invalid_school_name(F.col("school_name"))
    sums = schools.groupBy("year", "province").agg(F.count_if(ocr).alias("ocr_record_count"), F.count_if(bad).alias("invalid_school_name_count"))
    return sums.select(
        "year", "province", "ocr_record_count", (F.col("ocr_record_count") > 0).alias("requires_manual_review"),
        F.when(F.col("ocr_record_count") > 0, "ocr_experimental").alias("source_quality"), "invalid_school_name_count",
        F.coalesce(F.try_divide("invalid_school_name_count", "ocr_record_count"), F.lit(0.0)).alias("invalid_school_name_rate"),
    )


def year_step_status(ranks: DataFrame) -> DataFrame:
    """ok, or partial when subjects are missing or the counts are not monotone, per (year, province)."""
    keys = ["year", "province"]
    gaps = missing_subjects(ranks).groupBy(*keys).agg(F.count("*").alias("missing_subjects"))
    falls = monotonic_violations(ranks).groupBy(*keys).agg(F.count("*").alias("violations"))
    joined = ranks.select(*keys).distinct().join(gaps, keys, "left").join(falls, keys, "left").fillna(0, ["missing_subjects", "violations"])
    return joined.withColumn("status", F.when((F.col("missing_subjects") > 0) | (F.col("violations") > 0), "partial").otherwise("ok"))


def null_rate_report(schools: DataFrame) -> DataFrame:
    return stats.null_rates(schools)
