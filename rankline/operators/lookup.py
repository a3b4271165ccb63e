"""Score to rank, rank to score and cross-year conversion for whole tables of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import asof_backward, asof_forward, running_max_above

KEYS = ("year", "province", "subject_type")
SCORE_BAND = 50
RANK_BAND = 4096


def _valid_score(c: Column) -> Column:
    return c.between(0, 750)


def score_to_rank(requests: DataFrame, table: DataFrame, score: str = "score", year: str = "year") -> DataFrame:
    """Requests plus ``rank``, ``exact_match``, ``matched_score``; null rank means not found.

    The row with the nearest score at or below the request answers. If that row has no
    cumulative count there is no answer, even when a lower row has one.
    """
    probes = requests.where(_valid_score(F.col(score))).select(
        F.col(year).alias("year"), "province", "subject_type", F.col(score).cast("double").alias("score")
    )
    # The payload wraps the nullable count, so that a row without a count still stops the search.
    row = F.struct(F.col("score").alias("matched_score"), F.col("cumulative_count").alias("rank"))
    hits = asof_backward(probes, table.select(*KEYS, F.col("score").cast("double").alias("score"), "cumulative_count"), KEYS, "score", row, SCORE_BAND)
    found = hits.where("hit.rank IS NOT NULL").select(
        F.col("year").alias("k_year"), F.col("province").alias("k_province"), F.col("subject_type").alias("k_subject"),
        F.col("score").alias("k_score"), F.col("hit.rank").cast("int").alias("rank"),
        (F.col("hit.matched_score") == F.col("score")).alias("exact_match"), F.col("hit.matched_score").alias("matched_score"),
    )
    on = (
        (F.col(year) == F.col("k_year")) & (F.col("province") == F.col("k_province"))
        & (F.col("subject_type") == F.col("k_subject")) & (F.col(score).cast("double") == F.col("k_score"))
    )
    return requests.join(found, on, "left").drop("k_year", "k_province", "k_subject", "k_score")


def rank_steps(table: DataFrame) -> DataFrame:
    """Scores at which the running maximum of the count grows, from the top score down.

    The answer for a rank is the step with the smallest count at or above it, also when the
    stored counts are not monotone. One row per score is left first; the maximum runs over score bands.
    """
    rows = table.where("cumulative_count IS NOT NULL").groupBy(*KEYS, F.col("score").cast("double").alias("score")).agg(F.max("cumulative_count").alias("cumulative_count"))
    rows = running_max_above(rows, KEYS, "score", "cumulative_count", SCORE_BAND)
    return rows.where("above IS NULL OR cumulative_count > above").drop("above")


def rank_to_score(requests: DataFrame, table: DataFrame, rank: str = "rank", year: str = "year") -> DataFrame:
    """Requests plus ``found_score`` (whole number) and ``matched_cumulative_count``; null means not found."""
    probes = requests.where(F.col(rank) > 0).select(
        F.col(year).alias("year"), "province", "subject_type", F.col(rank).cast("double").alias("pos")
    )
    steps = rank_steps(table).withColumn("pos", F.col("cumulative_count").cast("double"))
    hits = asof_forward(probes, steps, KEYS, "pos", F.struct("score", "cumulative_count"), RANK_BAND)
    found = hits.where("hit IS NOT NULL").select(
        F.col("year").alias("k_year"), F.col("province").alias("k_province"), F.col("subject_type").alias("k_subject"),
        F.col("pos").alias("k_pos"), F.col("hit.score").cast("int").alias("found_score"),
        F.col("hit.cumulative_count").alias("matched_cumulative_count"),
    )
    on = (
        (F.col(year) == F.col("k_year")) & (F.col("province") == F.col("k_province"))
        & (F.col("subject_type") == F.col("k_subject")) & (F.col(rank).cast("double") == F.col("k_pos"))
    )
    return requests.join(found, on, "left").drop("k_year", "k_province", "k_subject", "k_pos")


def convert_between_years(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Requests (from_year, to_year, province, subject_type, score) with an answer.

    Requests with equal years are refused, those without an answer in either year drop out.
    """
    ranked = score_to_rank(requests.where("from_year <> to_year"), table, year="from_year").where("rank IS NOT NULL")
    ranked = ranked.withColumnsRenamed({"rank": "estimated_rank", "exact_match": "from_exact_match", "matched_score": "from_matched_score"})
    scored = rank_to_score(ranked, table, rank="estimated_rank", year="to_year").where("found_score IS NOT NULL")
    return scored.withColumnsRenamed({"found_score": "equivalent_score", "matched_cumulative_count": "to_matched_cumulative_count"})


def exact_or_whole_score(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Rank row of exactly the requested score, else of its whole part."""
    keyed = table.select(*KEYS, F.col("score").cast("double").alias("score"), F.struct("score", "same_score_count", "cumulative_count").alias("row"))
    exact = requests.join(keyed.withColumnsRenamed({"score": "q", "row": "exact_row"}), [*KEYS, "q"], "left")
    whole = exact.withColumn("whole", F.col("q").try_cast("long").cast("double"))
    return (
        whole.join(keyed.withColumnsRenamed({"score": "whole", "row": "whole_row"}), [*KEYS, "whole"], "left")
        .withColumn("row", F.coalesce("exact_row", "whole_row"))
        .drop("whole", "exact_row", "whole_row")
    )
