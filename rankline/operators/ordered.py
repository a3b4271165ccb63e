"""Order-dependent steps (as-of, running totals, neighbours) that never sort a whole key in one task.

A key such as (year, province, subject) may hold a third of all rows. Every step here first cuts
the ordering column into bands of a fixed width, works inside (key, band), and carries only one
row per band across bands. A window over a key alone therefore sees bands, not rows. The carried
rows are read from the same shuffle as the rows themselves (the exchange is reused).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def band_of(pos: Column, width: float) -> Column:
    return F.floor(pos / width)


def asof_forward(
    probes: DataFrame, table: DataFrame, keys: Sequence[str], pos: str, payload: Column, width: float
) -> DataFrame:
    """For every distinct (keys, pos) of the probes: payload of the row with the smallest pos at or after it.

    ``payload`` is read from ``table``; it is returned as column ``hit``, null when no row follows.
    The payload of the table must not be null.
    """
    return _asof(probes, table, keys, pos, payload, width, 1.0)


def asof_backward(
    probes: DataFrame, table: DataFrame, keys: Sequence[str], pos: str, payload: Column, width: float
) -> DataFrame:
    """As ``asof_forward`` for the row with the largest pos at or before the probe."""
    return _asof(probes, table, keys, pos, payload, width, -1.0)


def _asof(probes, table, keys, pos, payload, width, sign):
    keys = list(keys)
    place = (F.col(pos).cast("double") * sign).alias("at")
    rows = table.where(F.col(pos).isNotNull()).select(*keys, place, payload.alias("hit"))
    want = probes.where(F.col(pos).isNotNull()).select(*keys, place).distinct()
    none = F.lit(None).cast(rows.schema["hit"].dataType)
    both = rows.select("*", F.lit(1).alias("is_row")).unionByName(want.select("*", none.alias("hit"), F.lit(0).alias("is_row")))
    both = both.withColumn("band", band_of(F.col("at"), width))

    order = Window.partitionBy(*keys, "band").orderBy(F.desc("at"), F.desc("is_row"))
    both = both.withColumn(
        "local_hit", F.last("hit", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("is_end", F.lead(F.lit(1)).over(order).isNull())
    later = Window.partitionBy(*keys).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = both.where("is_end").select(*keys, "band", F.last("local_hit", ignorenulls=True).over(later).alias("next_hit"))
    return both.where("is_row = 0").join(bands, [*keys, "band"]).select(
        *keys, (F.col("at") * sign).alias(pos), F.coalesce("local_hit", "next_hit").alias("hit")
    )


def running_start(points: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str], amount: str, width: float) -> DataFrame:
    """Add ``start``: the sum of ``amount`` over all points of the key before this one by (pos, order)."""
    keys = list(keys)
    points = points.withColumn("band", band_of(F.col(pos), width))
    inside = Window.partitionBy(*keys, "band").orderBy(pos, *order)
    points = points.withColumn(
        "in_band", F.coalesce(F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("is_end", F.lead(F.lit(1)).over(inside).isNull())
    before = Window.partitionBy(*keys).orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = points.where("is_end").select(
        *keys, "band", F.coalesce(F.sum(F.col("in_band") + F.col(amount)).over(before), F.lit(0)).alias("band_start")
    )
    return points.join(bands, [*keys, "band"]).withColumn("start", F.col("band_start") + F.col("in_band")).drop(
        "band", "in_band", "is_end", "band_start"
    )


def with_next(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str], width: float) -> DataFrame:
    """Add ``next``: struct of the columns of the row with the next larger pos in the key, null at the end."""
    keys = list(keys)
    item = F.struct(*columns)
    inside = Window.partitionBy(*keys, "band").orderBy(pos)
    df = df.withColumn("band", band_of(F.col(pos), width)).withColumn("local_next", F.lead(item).over(inside))
    df = df.withColumn("is_first", F.lag(F.lit(1)).over(inside).isNull())
    later = Window.partitionBy(*keys).orderBy(F.desc("band"))
    bands = df.where("is_first").select(*keys, "band", F.lag(item).over(later).alias("band_next"))
    return df.join(bands, [*keys, "band"]).withColumn("next", F.coalesce("local_next", "band_next")).drop(
        "band", "local_next", "is_first", "band_next"
    )


def running_max_above(df: DataFrame, keys: Sequence[str], pos: str, value: str, width: float) -> DataFrame:
    """Add ``above``: the largest value of the rows of the key with a larger pos, null at the top."""
    keys = list(keys)
    inside = Window.partitionBy(*keys, "band").orderBy(F.desc(pos)).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("band", band_of(F.col(pos), width)).withColumn("in_band", F.max(value).over(inside))
    higher = Window.partitionBy(*keys).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = df.groupBy(*keys, "band").agg(F.max(value).alias("top")).select(*keys, "band", F.max("top").over(higher).alias("carried"))
    return df.join(bands, [*keys, "band"]).withColumn("above", F.greatest("in_band", "carried")).drop("band", "in_band", "carried")


def numbered(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Add ``name``: the place of the row in the whole order, from 0; rows that tie come in any order.

    The rows are cut into ranges and numbered inside; only one row per range is carried on. The result is written.
    """
    parts = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over the ranges, not the rows
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return written(parts.withColumn(name, place).join(starts, "_part").withColumn(name, (F.col(name) + F.col("_start")).cast("long")).drop("_part", "_start"))
