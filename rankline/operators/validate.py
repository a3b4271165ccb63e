"""Row rules per record type: the first broken rule is the error of the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import valid_subject
from ..functions.text import strip, text_or_empty
from .ordered import running_start, with_next

MIN_SCORE, MAX_SCORE = 100, 750
REQUIRED = {
    "school": ("year", "province", "subject_type", "school_name"),
    "rank": ("year", "province", "subject_type", "score", "cumulative_count"),
    "control": ("year", "province", "subject_type", "batch", "score"),
    "major": ("year", "province", "subject_type", "school_name", "major_name", "min_score"),
}


def _missing(c: str) -> Column:
    return text_or_empty(F.col(c)) == ""


def _missing_error(record_type: str) -> Column:
    names = F.concat_ws(", ", *[F.when(_missing(c), F.lit(c)) for c in REQUIRED[record_type]])
    return F.when(names != "", F.concat(F.lit("缺少必填字段: "), names))


def _range_error() -> Column:
    score = F.col("min_score").cast("double")
    return F.when(
        ~score.between(MIN_SCORE, MAX_SCORE),
        F.concat(F.lit(f"min_score 超出范围 [{MIN_SCORE}, {MAX_SCORE}]: "), score.cast("string")),
    )


def _subject_error() -> Column:
    return F.when(~valid_subject(F.col("subject_type")), F.concat(F.lit("subject_type 无效: "), strip(F.col("subject_type"))))


def row_error(record_type: str) -> Column:
    """Text of the first broken rule, null for a valid row. Major rows are not checked for their subject."""
    if record_type == "school":
        no_value = F.when(_missing("min_score") & _missing("min_rank"), "缺少 min_score 或 min_rank")
        return F.coalesce(_missing_error("school"), no_value, _range_error(), _subject_error())
    if record_type == "major":
        return F.coalesce(_missing_error("major"), _range_error())
    if record_type in ("rank", "control"):
        return F.coalesce(_missing_error(record_type), _subject_error())
    raise ValueError(f"unknown record type: {record_type}")


def checked(df: DataFrame, record_type: str) -> DataFrame:
    return df.withColumn("error", row_error(record_type))


def falling_counts(df: DataFrame, keys=("year", "province", "subject_type")) -> DataFrame:
    """Rows whose count is below that of the next higher score of the same key (a warning, rows stay valid)."""
    rows = df.where("score IS NOT NULL AND cumulative_count IS NOT NULL").withColumn("pos", -F.col("score").cast("double"))
    pairs = with_next(rows, keys, "pos", ["score", "cumulative_count"], width=50)
    return pairs.where("next.cumulative_count < cumulative_count").select(
        *keys, F.col("next.score").alias("score"), F.col("next.cumulative_count").alias("cumulative_count"),
        F.col("cumulative_count").alias("previous_count"),
    )


def numbered(df: DataFrame, file: str, row_idx: str, band: int = 10000) -> DataFrame:
    """Add ``row_num``: 1-based order of the rows of a file, without sorting a whole file in one task."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return running_start(ones, [file], row_idx, [], "_one", band).withColumn("row_num", F.col("start") + 1).drop("_one", "start")


def split_valid(df: DataFrame, record_type: str, file: str, row_idx: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, errors with row number and message)."""
    rows = checked(numbered(df, file, row_idx), record_type)
    errors = rows.where("error IS NOT NULL").select(
        file, "row_num", F.concat(F.lit("第 "), F.col("row_num").cast("string"), F.lit(" 行"), F.col("error")).alias("message")
    )
    return rows.where("error IS NULL").drop("error"), errors


def failed_counts(df: DataFrame, record_type: str, file: str) -> DataFrame:
    """Valid rows, broken rows and failed count per file; for rank rows falling counts are failures too."""
    rows = checked(df, record_type)
    sums = rows.groupBy(file).agg(F.count_if(F.col("error").isNull()).alias("valid"), F.count("error").alias("row_errors"))
    if record_type == "rank":
        falls = falling_counts(rows.where("error IS NULL"), (file, "year", "province", "subject_type"))
        sums = sums.join(falls.groupBy(file).agg(F.count("*").alias("falls")), file, "left")
    else:
        sums = sums.withColumn("falls", F.lit(0).cast("long"))
    return sums.select(file, "valid", "row_errors", (F.col("row_errors") + F.coalesce("falls", F.lit(0))).alias("failed_count"))
