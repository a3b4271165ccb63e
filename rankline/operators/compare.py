"""Comparison of two datasets and pass/fail gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rates(df: DataFrame) -> DataFrame:
    """Null rate of every column in one pass: (column_name, null_rate)."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return rates.unpivot([], list(df.columns), "column_name", "null_rate").where("null_rate IS NOT NULL")


def duplicate_rate(df: DataFrame) -> DataFrame:
    """1 - distinct rows / rows; equal rows are merged before they meet."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    sums = groups.agg(F.count("*").alias("d"), F.sum("_n").alias("t"))
    return sums.select(
        F.coalesce("t", F.lit(0)).alias("row_count"), F.coalesce(1 - F.try_divide("d", "t"), F.lit(0.0)).alias("duplicate_rate")
    )


def compare_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per column: where it exists and its null rate on both sides."""
    ra = null_rates(a).withColumnRenamed("null_rate", "rate_a")
    rb = null_rates(b).withColumnRenamed("null_rate", "rate_b")
    place = F.when(F.col("rate_b").isNull(), "only_a").when(F.col("rate_a").isNull(), "only_b").otherwise("common")
    return ra.join(rb, "column_name", "full").withColumn("place", place)


def compare_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    sides = duplicate_rate(a).withColumn("side", F.lit("a")).unionByName(duplicate_rate(b).withColumn("side", F.lit("b")))
    return sides.agg(
        F.max(F.when(F.col("side") == "a", F.col("row_count"))).alias("rows_a"),
        F.max(F.when(F.col("side") == "b", F.col("row_count"))).alias("rows_b"),
        F.max(F.when(F.col("side") == "a", F.col("duplicate_rate"))).alias("duplicate_rate_a"),
        F.max(F.when(F.col("side") == "b", F.col("duplicate_rate"))).alias("duplicate_rate_b"),
    ).withColumn("row_difference", F.col("rows_a") - F.col("rows_b"))


def gate(expectations: DataFrame, metrics: DataFrame) -> DataFrame:
    """Expectations (section, metric, minimum) against metrics (metric, value): pass/fail per section and overall."""
    checked = expectations.join(metrics, "metric", "left").withColumn(
        "passed", F.coalesce(F.col("value") >= F.col("minimum"), F.lit(False))
    )
    return checked.rollup("section").agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.count("*").alias("total"),
    ).select(
        F.coalesce("section", F.lit("overall")).alias("section"), "passed", "failed", "total",
        F.when(F.col("failed") == 0, "pass").otherwise("fail").alias("verdict"),
    )
