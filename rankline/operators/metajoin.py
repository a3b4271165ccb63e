"""School rows joined with school metadata by name, school name or name prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold
from .search import LIMIT_DEFAULT, LIMIT_MAX, TIES, by_rank_order, filtered, limited, school_order

TIERS = {"985": "is_985", "211": "is_211", "双一流": "is_double_first_class"}


def name_pairs(schools: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct (school_name, standard_name) that belong together.

    A prefix match by a nested loop compares every school with every metadata row. Here each
    distinct school name is exploded into its prefixes of the lengths that standard names have,
    and prefixes meet standard names by equality. A standard name is a prefix of itself, so plain
    equality needs no branch of its own.
    """
    names = schools.where("school_name IS NOT NULL").select("school_name").distinct()
    lengths = metadata.agg(F.collect_set(F.length("standard_name")).alias("n")).scalar()
    prefixes = names.withColumn("lengths", lengths).withColumn("n", F.explode("lengths")).where(F.col("n") <= F.length("school_name"))
    prefixes = prefixes.select("school_name", fold(F.substring("school_name", F.lit(1), F.col("n"))).alias("k"))
    by_prefix = prefixes.join(metadata.select(fold(F.col("standard_name")).alias("k"), "standard_name"), "k").drop("k")
    by_name = names.join(metadata.select("school_name", "standard_name"), "school_name")
    return by_prefix.unionByName(by_name).distinct()


def enriched(schools: DataFrame, metadata: DataFrame, how: str = "left") -> DataFrame:
    """School rows with the columns of their metadata rows; a school with several matches fans out."""
    facts = metadata.drop("school_name")
    if "province" in facts.columns:
        facts = facts.withColumnRenamed("province", "metadata_province")
    matched = name_pairs(schools, metadata).join(facts, "standard_name")
    return schools.join(matched, "school_name", how)


def search_enriched(
    schools: DataFrame, metadata: DataFrame, *, limit: int = LIMIT_DEFAULT, default: int = LIMIT_DEFAULT, maximum: int = LIMIT_MAX,
    is_985: bool | None = None, is_211: bool | None = None, is_double_first_class: bool | None = None,
    city: str | None = None, school_type: str | None = None, **filters,
) -> DataFrame:
    """Page of enriched schools with ``total``. Any metadata filter drops schools without metadata."""
    bounds = {k: filters.get(k) for k in ("min_score", "max_score", "rank_min", "rank_max")}
    facts = {"is_985": is_985, "is_211": is_211, "is_double_first_class": is_double_first_class}
    facts.update({"city": (city or "").strip(), "school_type": (school_type or "").strip()})
    given = {k: v for k, v in facts.items() if v is not None and v != ""}
    found = filtered(schools, **filters)
    order = school_order(by_rank_order(**bounds), (*TIES, "standard_name"))
    n = limited(limit, default, maximum)
    if given:
        hits = filtered(enriched(found, metadata, "inner"), **given)
        return hits.orderBy(*order).limit(n).withColumn("total", hits.agg(F.count("*")).scalar())
    # Every school gives a row or more, so the first rows come from the first schools, and only those are joined. The
    # total counts rows per name times matches per name.
    first = found.orderBy(*school_order(by_rank_order(**bounds), TIES)).limit(n)
    matches = name_pairs(found, metadata).join(metadata.groupBy("standard_name").agg(F.count("*").alias("m")), "standard_name")
    fan = matches.groupBy("school_name").agg(F.sum("m").alias("fan"))
    names = found.groupBy("school_name").agg(F.count("*").alias("n")).join(fan, "school_name", "left")
    total = names.agg(F.coalesce(F.sum(F.col("n") * F.coalesce("fan", F.lit(1))), F.lit(0))).scalar()
    return enriched(first, metadata, "left").orderBy(*order).limit(n).withColumn("total", total)


def tier_reachable(schools: DataFrame, metadata: DataFrame, *, max_score: float, tier: str, limit: int = 100, **equal) -> DataFrame:
    """Schools of a tier with a line at or below the score, one row per standard name, subject and year."""
    if tier not in TIERS:
        raise ValueError(f"unsupported tier: {tier}")
    rows = filtered(schools, max_score=max_score, **equal).select("school_name", "subject_type", "year", "min_score")
    rows = rows.groupBy("school_name", "subject_type", "year").agg(F.min("min_score").alias("min_score"))
    hits = enriched(rows, metadata.where(F.col(TIERS[tier])), "inner")
    keys = ["standard_name", "city", "subject_type", "year", *TIERS.values()]
    return hits.groupBy(*keys).agg(F.min("min_score").alias("min_score")).orderBy(F.desc("min_score"), *keys).limit(limit)


def attach_downloads(images: DataFrame, downloads: DataFrame, order: str) -> DataFrame:
    """Images with the last download record of the same file name."""
    last = downloads.groupBy("file_name").agg(F.max_by(F.struct("source_url", "page_url", "source_title"), F.col(order)).alias("d"))
    return images.join(last, "file_name", "left").select(images["*"], "d.*")
