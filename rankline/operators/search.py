"""Filtered searches, pages of tables and distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import fold, text_or_empty
from . import stats
from .lookup import KEYS, convert_between_years
from .rangetop import LIMIT_DEFAULT, LIMIT_MAX, range_top

ALL = "全部"
SCHOOL_COLUMNS = (
    "year", "province", "subject_type", "admission_category", "batch", "school_name", "school_code",
    "major_group", "min_score", "min_rank", "plan_count",
)
# All key columns: a total order over school rows, so that a limit is repeatable.
TIES = ("school_name", "school_code", "year", "province", "subject_type", "admission_category", "batch", "major_group")
DISTINCT_COLUMNS = ("year", "province", "subject_type", "admission_category", "batch")
METADATA_DISTINCT_COLUMNS = ("city", "school_type", "ownership", "province")


def limited(value: int, default: int, maximum: int) -> int:
    return default if value < 1 else min(value, maximum)


def filtered(
    df: DataFrame, *, keyword: str | None = None, min_score: float | None = None, max_score: float | None = None,
    rank_min: int | None = None, rank_max: int | None = None, **equal: object,
) -> DataFrame:
    """Optional filters; None, blank and the choice for all mean no filter."""
    for column, value in equal.items():
        if value is not None and value != "" and value != ALL:
            df = df.where(F.col(column) == F.lit(value))
    if keyword and keyword.strip():
        df = df.where(F.contains(fold(F.col("school_name")), fold(F.lit(keyword.strip()))))
    for column, low, high in (("min_score", min_score, max_score), ("min_rank", rank_min, rank_max)):
        if low is not None:
            df = df.where(F.col(column) >= low)
        if high is not None:
            df = df.where(F.col(column) <= high)
    return df


def school_order(by_rank: bool, ties=TIES) -> list:
    first = F.col("min_rank").asc_nulls_last() if by_rank else F.col("min_score").desc_nulls_last()
    return [first, *[F.col(t).asc_nulls_first() for t in ties]]


def by_rank_order(min_score=None, max_score=None, rank_min=None, rank_max=None) -> bool:
    """Rank order only when a rank bound and no score bound is given."""
    return (rank_min is not None or rank_max is not None) and min_score is None and max_score is None


def search_schools(schools: DataFrame, *, limit: int = LIMIT_DEFAULT, default: int = LIMIT_DEFAULT, maximum: int = LIMIT_MAX, **filters) -> DataFrame:
    """Page of schools with the number of all matches in ``total``."""
    bounds = {k: filters.get(k) for k in ("min_score", "max_score", "rank_min", "rank_max")}
    hits = filtered(schools, **filters)
    page = hits.orderBy(*school_order(by_rank_order(**bounds))).limit(limited(limit, default, maximum))
    return page.withColumn("total", hits.agg(F.count("*")).scalar())


def schools_by_rank(requests: DataFrame, schools: DataFrame) -> DataFrame:
    """Requests (keys, rank, tolerance, limit): schools with a rank within the tolerance, best rank first."""
    ranges = requests.withColumn("lo", F.greatest(F.lit(1), F.col("rank") - F.col("tolerance")).cast("double")).withColumn(
        "hi", (F.col("rank") + F.col("tolerance")).cast("double")
    ).withColumn("limit", rules.clamp_limit(F.col("limit"), LIMIT_DEFAULT, LIMIT_MAX))
    return range_top(ranges, schools, KEYS, "min_rank", TIES, descending=False, width=4096, carry=SCHOOL_COLUMNS)


def schools_in_score_range(ranges: DataFrame, schools: DataFrame) -> DataFrame:
    return range_top(ranges, schools, KEYS, "min_score", TIES, descending=True, width=50, carry=SCHOOL_COLUMNS)


def schools_by_score(requests: DataFrame, schools: DataFrame) -> DataFrame:
    """Requests (keys, score, tolerance, limit); refused where scores are mostly missing."""
    gate = stats.score_query_gate(requests.select("year", "province").distinct(), schools).where("available")
    ranges = requests.join(gate.select("year", "province"), ["year", "province"], "left_semi")
    ranges = ranges.withColumn("lo", (F.col("score") - F.col("tolerance")).cast("double")).withColumn(
        "hi", (F.col("score") + F.col("tolerance")).cast("double")
    ).withColumn("limit", rules.clamp_limit(F.col("limit"), LIMIT_DEFAULT, LIMIT_MAX))
    return schools_in_score_range(ranges, schools)


def schools_by_equivalent_score(requests: DataFrame, ranks: DataFrame, schools: DataFrame) -> DataFrame:
    """Requests (from_year, to_year, province, subject_type, score, tolerance, limit): schools of the
    target year around the score that has the same rank there."""
    ranges = convert_between_years(requests, ranks)
    ranges = ranges.withColumn("year", F.col("to_year")).withColumn(
        "lo", (F.col("equivalent_score") - F.col("tolerance")).cast("double")
    ).withColumn("hi", (F.col("equivalent_score") + F.col("tolerance")).cast("double")).withColumn(
        "limit", rules.clamp_limit(F.col("limit"), LIMIT_DEFAULT, LIMIT_MAX)
    )
    return schools_in_score_range(ranges, schools)


def rank_page(ranks: DataFrame, *, year: int, province: str, subject_type: str, limit: int = 100) -> DataFrame:
    hits = filtered(ranks, year=year, province=province, subject_type=subject_type)
    page = hits.orderBy(F.desc("score")).limit(limited(limit, 100, 500))
    return page.withColumn("total", hits.agg(F.count("*")).scalar())


def control_page(controls: DataFrame, *, batch: str | None = None, limit: int = 100, **equal) -> DataFrame:
    hits = filtered(controls, **equal)
    if batch and batch.strip():
        hits = hits.where(F.contains(fold(F.col("batch")), fold(F.lit(batch.strip()))))
    order = [F.desc("year"), F.desc("score"), "province", "subject_type", "batch"]
    return hits.orderBy(*order).limit(limited(limit, 100, 200)).withColumn("total", hits.agg(F.count("*")).scalar())


def chart_rows(schools: DataFrame, *, mode: str = "score", **filters) -> DataFrame:
    value = "min_rank" if mode == "rank" else "min_score"
    return filtered(schools, **filters).where(F.col(value).isNotNull()).select(
        "year", "province", "subject_type", "school_name", "min_score", "min_rank"
    )


def export_rows(schools: DataFrame) -> DataFrame:
    order = [F.desc("year"), F.col("min_score").desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in TIES]]
    return schools.select(*SCHOOL_COLUMNS).orderBy(*order)


def top_schools(schools: DataFrame, limit: int = 20) -> DataFrame:
    return (
        schools.where("min_score IS NOT NULL").orderBy(*school_order(False)).limit(limit)
        .select("school_name", "min_score", "subject_type", "year", "admission_category", "batch")
    )


def top_distinct(schools: DataFrame, *, mode: str = "score", limit: int = 20) -> DataFrame:
    """Best row of each (school, subject), then the best of those, with a display label."""
    value = "min_rank" if mode == "rank" else "min_score"
    best = F.min(value) if mode == "rank" else F.max(value)
    best_rows = schools.where(F.col(value).isNotNull()).groupBy("school_name", "subject_type").agg(best.alias(value))
    first = F.asc(value) if mode == "rank" else F.desc(value)
    return best_rows.orderBy(first, "school_name", "subject_type").limit(limit).withColumn(
        "label", F.concat("school_name", F.lit(" ("), "subject_type", F.lit(")"))
    )


def distinct_values(df: DataFrame, column: str, allowed=DISTINCT_COLUMNS) -> DataFrame:
    if column not in allowed:
        raise ValueError(f"unsupported column: {column}")
    return df.where(text_or_empty(F.col(column)) != "").select(F.col(column).alias("v")).distinct().orderBy("v")


def first_per(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key; the group limit keeps one row per key in every map task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
