"""Counts, rates, histograms and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import query_mode, text_or_empty
from ..session import written


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its count, plus the sorted years and provinces of all tables."""
    keys = stack([df.select(F.lit(name).alias("table_name"), "year", "province") for name, df in tables.items()])
    # A few rows; written, as the counts and the lists would each work out all tables again.
    per_key = written(keys.groupBy("table_name", "year", "province").agg(F.count("*").alias("n")))
    counts = per_key.groupBy("table_name").agg(F.sum("n").alias("row_count"))
    # One value holds both lists, so the tables are read once for them.
    names = per_key.agg(F.struct(
        F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",").alias("years"),
        F.array_join(F.array_sort(F.collect_set(F.nullif("province", F.lit("")))), ",").alias("provinces"),
    ).alias("names")).scalar()
    return counts.withColumn("names", names).select("table_name", "row_count", F.col("names.years").alias("years_available"), F.col("names.provinces").alias("provinces_available"))


def home_totals(schools: DataFrame) -> DataFrame:
    # Pre-aggregated on the two keys, so the distinct counts see key pairs and not rows.
    pairs = schools.groupBy("year", "province").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.sum("n").alias("school_total"), F.count_distinct("year").alias("year_count"), F.count_distinct("province").alias("province_count")
    )


def rows_per_year(schools: DataFrame) -> DataFrame:
    return schools.groupBy("year").agg(F.count("*").alias("cnt")).orderBy("year")


def year_comparison(schools: DataFrame, years) -> DataFrame:
    return (
        schools.where(F.col("year").isin(*years)).groupBy("year").agg(
            F.count("*").alias("total_records"),
            F.count_if(F.col("subject_type") == "历史类").alias("history_count"),
            F.count_if(F.col("subject_type") == "物理类").alias("physics_count"),
            F.round(F.avg("min_score"), 2).alias("avg_min_score"),
            F.max("min_score").alias("max_min_score"),
        ).orderBy("year")
    )


def year_comparison_long(comparison: DataFrame) -> DataFrame:
    long = comparison.unpivot(["year"], ["history_count", "physics_count"], "measure", "n")
    return long.select("year", F.when(F.col("measure") == "history_count", "历史类").otherwise("物理类").alias("subject_type"), "n")


def tier_counts(metadata: DataFrame) -> DataFrame:
    return metadata.agg(
        F.count("*").alias("total"), F.count_if("is_985").alias("count_985"), F.count_if("is_211").alias("count_211"),
        F.count_if("is_double_first_class").alias("count_dfc"),
    )


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def count_by_text(df: DataFrame, column: str) -> DataFrame:
    """Count per non-blank value, largest first."""
    return count_by(df.where(text_or_empty(F.col(column)) != ""), column).orderBy(F.desc("n"), column)


def null_rates(schools: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Null rates of score and rank per (year, province) with the recommended query mode.

    Requested keys without rows get rates of 1 and the default mode of the province.
    """
    rates = schools.groupBy("year", "province").agg(
        F.count("*").alias("total"),
        F.avg(F.col("min_score").isNull().cast("double")).alias("min_score_null_rate"),
        F.avg(F.col("min_rank").isNull().cast("double")).alias("min_rank_null_rate"),
    ).withColumn("mode", query_mode(F.col("min_score_null_rate"), F.col("min_rank_null_rate")))
    if requests is not None:
        rates = requests.select("year", "province").distinct().join(rates, ["year", "province"], "left")
    return rates.select(
        "year", "province", F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("min_score_null_rate", F.lit(1.0)).alias("min_score_null_rate"),
        F.coalesce("min_rank_null_rate", F.lit(1.0)).alias("min_rank_null_rate"),
        F.coalesce("mode", rules.default_query_mode(F.col("province"))).alias("recommended_query_mode"),
    )


def resolved_modes(requests: DataFrame, schools: DataFrame, fixed_rank: tuple[str, ...] = ("山东",)) -> DataFrame:
    """Query mode per request (year, province); a missing argument gives mixed, some provinces are fixed."""
    rates = null_rates(schools, requests.where("year IS NOT NULL AND province IS NOT NULL")).select(
        "year", "province", "recommended_query_mode"
    )
    joined = requests.join(rates, ["year", "province"], "left")
    missing = F.col("year").isNull() | (text_or_empty(F.col("province")) == "")
    return joined.withColumn(
        "query_mode",
        F.when(F.col("province").isin(*fixed_rank), "rank").when(missing, "mixed").otherwise(F.col("recommended_query_mode")),
    ).drop("recommended_query_mode")


def score_query_gate(requests: DataFrame, schools: DataFrame) -> DataFrame:
    """Whether a score search makes sense per requested (year, province)."""
    rates = null_rates(schools, requests)
    default = rules.default_query_mode(F.col("province")) == "score"
    return rates.withColumn("available", F.when(F.col("total") == 0, default).otherwise(F.col("min_score_null_rate") <= 0.8))


def blank_counts(tables: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Rows, blank cells per checked column and a status, one row per (table, column)."""
    frames = []
    for name, (df, columns) in tables.items():
        sums = df.agg(F.count("*").alias("total"), *[F.count_if(text_or_empty(F.col(c)) == "").alias(c) for c in columns])
        frames.append(sums.unpivot(["total"], list(columns), "column_name", "blank").withColumn("table_name", F.lit(name)))
    return stack(frames).withColumn("status", F.when(F.col("blank") == 0, "ok").otherwise("check"))


def equal_width_histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Right-closed bins over min..max; the first bin includes the minimum, empty bins are kept.

    Values are counted before binning, so the binning works on distinct values. A constant
    column gets an interval of 0.1 % around the value.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))
    ends = counts.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pad = F.when(F.col("lo") == F.col("hi"), F.when(F.col("lo") == 0, 0.001).otherwise(F.abs("lo") * 0.001)).otherwise(0.0)
    ends = ends.withColumn("pad", pad).withColumn("base", F.col("lo") - F.col("pad")).withColumn("spread", (F.col("hi") + F.col("pad")) - F.col("base"))
    # One value holds all that the bins need, so it is worked out once.
    scale = ends.select(F.struct("lo", "base", "spread", (F.col("spread") / bins).alias("width"), (F.col("pad") == 0).alias("plain"))).scalar()
    numbered = counts.withColumn("s", scale)
    binned = numbered.withColumn("bin", F.least(F.greatest(F.ceil((F.col("x") - F.col("s.base")) / F.col("s.width")), F.lit(1)), F.lit(bins)).cast("int"))
    sums = binned.groupBy("bin").agg(F.sum("n").alias("n"))
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), scale.alias("s")).where("s.lo IS NOT NULL")
    # The outer left edge is drawn a little below the minimum, as the first bin includes it.
    left = F.col("s.base") + (F.col("bin") - 1) * F.col("s.width") - F.when((F.col("bin") == 1) & F.col("s.plain"), F.col("s.spread") * 0.001).otherwise(0.0)
    right = F.col("s.base") + F.col("bin") * F.col("s.width")
    return edges.join(sums, "bin", "left").select(
        "bin", left.try_cast("long").alias("left_edge"), right.try_cast("long").alias("right_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )


def values_at(df: DataFrame, group: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Exact percentiles per group, one array ``q`` in order of the shares, with linear interpolation between neighbours.

    Values are counted first. The counts are cut into ranges of the order (group, value); running sums inside a range, and over one row per range, give the
    position of every distinct value, and the few values around a wanted position are picked by it. No buffer holds a group's values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))
    counts = written(counts.repartitionByRange(group, "x").withColumn("band", F.spark_partition_id()))
    inside = Window.partitionBy(group, "band").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(group).orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = counts.groupBy(group, "band").agg(F.sum("n").alias("m"))
    bands = bands.select(group, "band", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"), F.sum("m").over(Window.partitionBy(group)).alias("total"))
    placed = counts.withColumn("to", F.sum("n").over(inside)).join(bands.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")) & (counts["band"] == bands["band"])).drop("_g")
    placed = placed.withColumn("to", F.col("to") + F.col("start")).withColumn("from", F.col("to") - F.col("n"))
    place = lambda s: (F.col("total") - 1) * F.lit(float(s))
    at = lambda k: F.max(F.when((F.col("from") <= k) & (k < F.col("to")), F.col("x")))
    sides = [(at(F.floor(place(s))), at(F.ceil(place(s)))) for s in shares]
    found = placed.groupBy(group).agg(F.max("total").alias("total"), *[c.alias(f"{side}{i}") for i, pair in enumerate(sides) for side, c in zip(("lo", "hi"), pair)])

    def between(i: int, s: float) -> Column:
        low, high = F.floor(place(s)), F.ceil(place(s))
        return F.when((low == high) | (F.col(f"lo{i}") == F.col(f"hi{i}")), F.col(f"lo{i}")).otherwise((high - place(s)) * F.col(f"lo{i}") + (place(s) - low) * F.col(f"hi{i}"))

    return found.select(group, F.array(*[between(i, s) for i, s in enumerate(shares)]).alias("q"))


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact five-number summary per group, and the number of values."""
    quartiles = values_at(df, group, value, (0.25, 0.5, 0.75)).withColumnRenamed(group, "_g")
    ends = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.min(F.col(value).cast("double")).alias("low"), F.max(F.col(value).cast("double")).alias("high"), F.count("*").alias("n"))
    return ends.join(quartiles, F.col(group).eqNullSafe(F.col("_g"))).select(
        group, "low", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q3"), "high", "n"
    )


SUMMARY_MEASURES = ("discovered_pages", "downloaded_files", "imported", "skipped", "failed")


def scan_report(per_year: DataFrame) -> DataFrame:
    """Totals per province over its years with the status of the province.

    Input: province, year, access_status, error and the summary measures.
    """
    blocked = ~F.first("access_status", ignorenulls=True).isin("available", "partial", "unknown")
    sums = [F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in SUMMARY_MEASURES]
    return per_year.groupBy("province").agg(
        *sums,
        F.when(blocked, "skipped_due_to_access_status")
        .when(F.count("error") > 0, "partial")
        .when(F.sum(F.coalesce("failed", F.lit(0))) > 0, "failed")
        .otherwise("ok").alias("status"),
    )


def scan_totals(report: DataFrame, structured, source_aware) -> DataFrame:
    return report.agg(
        F.count("*").alias("total_provinces"),
        F.count_if(F.col("province").isin(*structured)).alias("structured"),
        F.count_if(F.col("province").isin(*source_aware)).alias("source_aware"),
        F.count_if(F.col("status") == "skipped_due_to_access_status").alias("skipped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


YEAR_OUTCOMES = (
    "imported", "skipped", "skipped_wrong_type", "failed", "downloaded_not_imported",
    "skipped_unsupported_category", "ocr_failed", "ocr_skipped", "skipped_corrupted_image",
)


def outcome_summary(log: DataFrame, *keys: str) -> DataFrame:
    """Outcome counts per key as columns, from a log with one row per file."""
    # count_if columns instead of a pivot: one pass, a fixed schema and a partial aggregate per task.
    return log.groupBy(*keys).agg(
        F.count("*").alias("files"), *[F.count_if(F.col("outcome") == o).alias(o) for o in YEAR_OUTCOMES]
    )


def source_link_status(sources: DataFrame) -> DataFrame:
    """Configured and missing links per (year, data_type); attachments counted in the same pass.

    Input: year, data_type, url, attachments array<string>.
    """
    def good(c):
        return (text_or_empty(c) != "") & (F.upper(text_or_empty(c)) != "TODO")

    atts = F.coalesce("attachments", F.array().cast("array<string>"))
    ok_atts = F.size(F.filter(atts, good))
    return sources.groupBy("year", "data_type").agg(
        F.count_if(good(F.col("url"))).alias("configured"),
        F.count_if(~good(F.col("url"))).alias("missing"),
        F.count("*").alias("total"),
        F.sum(ok_atts.cast("long")).alias("attachments_configured"),
        F.sum((F.size(atts) - ok_atts).cast("long")).alias("attachments_missing"),
    )
