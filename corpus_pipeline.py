"""The corpus pipeline: documents in, packed training sequences out, each stage one of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankline.llm import common, linededup, omh, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned from the labels."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that stand on many sources; its length follows its text."""
    out = linededup.remove_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns."""
    return omh.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the documents that are left, in sequences of up to 1024; one row per piece, with its ids."""
    return packing.pack_documents(docs, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", pack)]

# Learned rules, sketches of texts and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again before the next."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
