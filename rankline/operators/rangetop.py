"""Top rows of a value range for a whole table of requests, without pairing requests and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .ordered import running_start

LIMIT_DEFAULT = 50
LIMIT_MAX = 200


def range_top(
    requests: DataFrame, rows: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str],
    *, descending: bool, width: float, carry: Sequence[str],
) -> DataFrame:
    """First ``limit`` rows of every request with ``lo <= value <= hi``, with place and total.

    Every row has a position in its key: the number of rows before its value plus its number among
    equal values. One running sum over the distinct values and the ends of the distinct ranges gives
    both the first position of each value and the span of each range; an equality join on the
    positions start + 1 .. start + limit then fetches the rows. No request meets a row it does not
    return. Only the first LIMIT_MAX rows of equal value can ever be returned, because a range
    starts at the first row of a value; the group limit keeps those per map task.
    """
    keys = list(keys)
    sign = -1.0 if descending else 1.0
    rows = rows.where(F.col(value).isNotNull()).withColumn("pos", F.col(value).cast("double") * sign)
    low, high = ("hi", "lo") if descending else ("lo", "hi")
    # Requests are written once with a number each, which all later steps carry instead of their bounds.
    requests = written(requests.withColumn("_request", F.monotonically_increasing_id()))
    ranges = requests.select("_request", *keys, (F.col(low).cast("double") * sign).alias("_from"), (F.col(high).cast("double") * sign).alias("_to"), F.col("limit").cast("long").alias("_most")).where("_from <= _to")

    # kind orders equal positions: start of a range, then the rows of the value, then end of a range.
    points = rows.groupBy(*keys, "pos").agg(F.count("*").alias("n")).withColumn("kind", F.lit(1))
    end = lambda kind, pos: F.struct(F.lit(kind).alias("kind"), F.col(pos).alias("pos"))
    ends = ranges.select("_request", "_most", *keys, F.inline(F.array(end(0, "_from"), end(2, "_to")))).withColumn("n", F.lit(0).cast("long"))
    points = written(running_start(points.unionByName(ends, allowMissingColumns=True), keys, "pos", ["kind"], "n", width))
    spans = points.where("kind <> 1").groupBy("_request", "_most", *keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("start"))).alias("first"), F.max(F.when(F.col("kind") == 2, F.col("start"))).alias("last")
    )
    spans = spans.withColumn("total", F.col("last") - F.col("first")).where("total > 0")

    # Only rows in a band that some range reaches are sorted; their first places come from the running sum over all values.
    reached = ranges.select(*keys, F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor(F.col("_to") / width))).alias("_band")).distinct()
    wanted = rows.select(*keys, "pos", F.floor(F.col("pos") / width).alias("_band"), *[c for c in carry if c not in keys]).join(reached, [*keys, "_band"], "left_semi").drop("_band")
    number = F.row_number().over(Window.partitionBy(*keys, "pos").orderBy(*[F.asc_nulls_first(t) for t in ties]))
    placed = wanted.withColumn("rn", number).where(F.col("rn") <= LIMIT_MAX)
    starts = points.where("kind = 1").select(*keys, "pos", "start")
    placed = placed.join(starts, [*keys, "pos"]).withColumn("position", F.col("start") + F.col("rn")).drop("pos", "start", "rn")

    spots = spans.withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("_most"), F.col("total")))))
    spots = spots.withColumn("position", F.col("first") + F.col("place")).drop("first", "last", "_most")
    found = spots.join(placed, [*keys, "position"]).drop("position", *keys)
    return requests.join(found, "_request").drop("_request")
