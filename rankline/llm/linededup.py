"""Removal of lines that stand on many sites, with HyperLogLog sketches of the sites of every line.

Sketches per line hash merge in the aggregation, so a line on a third of all rows is never gathered.
An estimate clearly above or below the threshold decides; lines near it get an exact distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored, table

MIN_SITES = 8
LOG_K = 12
SALTS = 16
# Fixed: relative standard error of such a sketch is at most 1.04 / sqrt(2^LOG_K); near means within six of them.
NEAR = 6 * 1.04 / 2 ** (LOG_K / 2)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def blank_free(line: Column) -> Column:
    """The line without white space at its ends: what counts as the same line."""
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def line_sites(df: DataFrame, text_column: str, site_column: str) -> DataFrame:
    """Hash and site of every line with text; lines of a document without site have a null site."""
    lines = df.select(F.col(site_column).cast("string").alias("site"), F.explode(F.array_distinct(F.transform(lines_of(F.col(text_column)), blank_free))).alias("line"))
    return lines.where("line <> ''").select(*row_key("line"), "site")


def boilerplate(df: DataFrame, min_sites: int = MIN_SITES, text_column: str = "text", site_column: str = "source") -> DataFrame:
    """Hashes (k1, k2) of the lines on ``min_sites`` distinct sites or more. A null site counts for none."""
    sites = line_sites(df, text_column, site_column).where("site IS NOT NULL")
    counted = sites.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", LOG_K).alias("sketch"))
    # Fewer lines than sites asked for cannot reach them, whatever the sketch says.
    counted = stored(counted.where(F.col("n") >= min_sites).select("k1", "k2", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - NEAR)))
    sure = counted.where(F.col("estimate") > min_sites * (1 + NEAR)).select("k1", "k2")
    near = counted.where(F.col("estimate") <= min_sites * (1 + NEAR)).select("k1", "k2")
    pairs = sites.distinct()  # one row per line and site, whatever the number of documents
    exact = pairs.join(near, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.count("*").alias("n_sites")).where(F.col("n_sites") >= min_sites)
    return sure.unionByName(exact.select("k1", "k2"))


def remove_boilerplate(
    df: DataFrame, min_sites: int = MIN_SITES, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source", count_column: str | None = None
) -> DataFrame:
    """Every row with the lines taken out of its text that stand on ``min_sites`` sites or more.

    Lines are compared without white space at their ends; blank lines stay. A text that loses nothing is unchanged, one that
    loses all its lines becomes empty; a null text stays null. Rows are neither lost nor added, repeated rows stay repeated,
    and rows without site keep their text out of the count but lose lines like others. All columns stay; ``count_column`` adds the
    number of lines removed (taking the place of a column of that name). An empty table gives an empty result.
    """
    columns = df.columns
    bad = stored(boilerplate(df, min_sites, text_column, site_column))
    bad = bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = df.select(F.struct(*columns).alias("row"), *[c.alias(n) for c, n in zip(row_key(id_column, text_column), ("d1", "d2"), strict=True)])
    text = F.col(f"row.{text_column}")
    # A document's lines go by hash to the boilerplate lines, spread over salts because a line may be on a third of all rows.
    marks = keyed.select("d1", "d2", F.posexplode(F.transform(lines_of(text), blank_free)).alias("pos", "line")).where("line <> ''")
    marks = marks.select("d1", "d2", "pos", *row_key("line"), F.pmod("d1", F.lit(SALTS)).cast("int").alias("salt"))
    hits = marks.join(bad, ["k1", "k2", "salt"], "left_semi").groupBy("d1", "d2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    joined = keyed.join(hits, ["d1", "d2"], "left")
    drop = F.map_from_arrays("gone", F.transform("gone", lambda p: F.lit(True)))
    kept = F.filter(lines_of(text), lambda line, i: F.col("drop")[i].isNull())
    out = joined.withColumn("drop", drop).select(
        "row", F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_gone")
    )
    shown = [F.col("text").alias(c) if c == text_column else F.col(f"row.{c}").alias(c) for c in columns if c != count_column]
    return out.select(*shown, *([F.greatest("n_gone", F.lit(0)).cast("long").alias(count_column)] if count_column else []))


def op3(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return remove_boilerplate(docs, count_column="n_removed").select("doc_id", "text", "n_removed")


OP3_SQL = rf"""
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(l, 1) AS pos, unnest(l) AS raw
  FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), trimmed AS (
  SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM lines
), bad AS (
  SELECT line FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), kept AS (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE line NOT IN (SELECT line FROM bad)) AS text,
         count(*) FILTER (WHERE line IN (SELECT line FROM bad)) AS n_removed
  FROM trimmed GROUP BY doc_id
)
SELECT doc_id, coalesce(text, '') AS text, CAST(n_removed AS BIGINT) AS n_removed FROM kept"""
