"""Hard-negative mining by exact integer inner products of Kronecker-packed vectors.

Components become integers. Those of many candidates are biased to be non-negative and laid side by side, one field
each, in one wide integer per dimension; a field is wide enough for the whole sum, so nothing carries over. One
multiplication of that integer with an anchor's component multiplies it with the component of every candidate, and the sum
over the dimensions holds all their scores, exact, one per field. Anchors and candidates are dealt to a grid of
groups and parts by hashes; what a cell of the grid finds is cut to what can still count, and merged by a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
PART, GROUP = 32768, 2048  # candidates of a part, anchors of a group, or so
CHUNK = 4096  # fields of one wide integer
_LONG = 2**63 - 1


class Packed:
    """Candidates (a row each, whole numbers) as one wide integer per dimension; ``scores`` gives an anchor's inner products with all."""

    def __init__(self, rows: np.ndarray):
        self.count, self.size = rows.shape
        self.bias = max(0, -int(rows.min())) if rows.size else 0
        self.top = int(rows.max()) + self.bias if rows.size else 0
        self.rows, self.sums = rows, None
        self.width = 0  # bytes of a field

    def _pack(self, width: int) -> None:
        self.width = width
        biased = self.rows + self.bias if self.top <= _LONG else self.rows.astype(object) + self.bias
        if width <= 8:
            fields = biased.astype(f"<u{width}")
            self.wide = [int.from_bytes(fields[:, j].tobytes(), "little") for j in range(self.size)]
        else:  # components so large that a score leaves 64 bits
            self.wide = [int.from_bytes(b"".join(int(x).to_bytes(width, "little") for x in biased[:, j]), "little") for j in range(self.size)]
        one = int.from_bytes((b"\1" + bytes(width - 1)) * self.count, "little")
        self.ones, self.sums = one, sum(self.wide)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products; whole numbers of any size (as objects) where 64 bits could be too few."""
        low = max(0, -min(anchor, default=0))
        highest = self.size * (max(anchor, default=0) + low) * self.top
        # sum (a + low)(c + bias) = score + bias * sum a + low * sum (c + bias); all of it but the score is taken off after unpacking.
        width = 4 if highest < 2**32 else 8 if highest < 2**63 else -(-highest.bit_length() // 8)
        if width > self.width:
            self._pack(width)
        total = 0
        for a, wide in zip(anchor, self.wide, strict=True):
            if a + low:
                total += wide * (a + low)
        held = self._fields(total)
        return held - low * self._fields(self.sums) - self.bias * sum(anchor)

    def _fields(self, total: int) -> np.ndarray:
        data = total.to_bytes(self.count * self.width, "little")
        if self.width <= 8:
            return np.frombuffer(data, dtype=f"<u{self.width}").astype(np.int64)
        return np.array([int.from_bytes(data[i:i + self.width], "little") for i in range(0, len(data), self.width)], dtype=object)


def first(places: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """The places of the ``count`` highest scores, ties by the earlier place; places are sorted."""
    if len(places) > count:
        own = scores[places]
        places = places[own >= np.partition(own, len(own) - count)[len(own) - count]]
    return places[np.argsort(-scores[places], kind="stable")][:count]


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _blocks(rows: pa.Table):
    """Candidates of one grid cell, sorted by id, in chunks: (ids, labels, packed)."""
    rows = rows.sort_by("vec_id")
    for at in range(0, rows.num_rows, CHUNK):
        part = rows.slice(at, CHUNK).combine_chunks()
        lists = part["vector"].combine_chunks()
        values = np.asarray(lists.flatten(), dtype=np.int64).reshape(part.num_rows, -1)
        yield part["vec_id"].to_numpy(), part["label"].to_numpy(), Packed(values)


def _long(score) -> int:
    if not -_LONG <= score <= _LONG:
        raise OverflowError(f"score {score} does not fit a long")
    return int(score)


def _near(anchors: pa.Table, candidates: pa.Table, count: int):
    """anchor row, vec_id and score of each anchor's best candidates; an anchor itself is left out."""
    out = [[], [], []]
    own = list(zip(anchors["anchor"].to_pylist(), anchors["vec_id"].to_pylist(), anchors["vector"].to_pylist(), strict=True))
    for ids, _, packed in _blocks(candidates):
        places = np.arange(len(ids))
        for anchor, vec_id, vector in own:
            scores = packed.scores(vector)
            mine = np.flatnonzero(ids == vec_id)
            here = [i for i in mine if packed.rows[i].tolist() == vector]
            others = np.delete(places, here) if here else places
            best = first(others, scores, count)
            out[0] += [anchor] * len(best)
            out[1] += ids[best].tolist()
            out[2] += [_long(s) for s in scores[best]]
    return pa.table(dict(zip(("anchor", "positive_id", "positive_score"), (pa.array(c, pa.int64()) for c in out), strict=True)))


def _between(anchors: pa.Table, candidates: pa.Table, count: int, low: int, high: int):
    """anchor row, positive's place, negative_id and score of the best candidates of other labels whose scores suit the positive."""
    out = [[], [], [], []]
    own = [anchors[c].to_pylist() for c in ("anchor", "label", "vector", "wanted")]
    for ids, labels, packed in _blocks(candidates):
        for anchor, label, vector, wanted in zip(*own, strict=True):
            scores = packed.scores(vector)
            hundred = scores.astype(object) * 100 if scores.dtype != object and len(scores) and np.abs(scores).max() > _LONG // 100 else scores * 100
            other = labels != label
            for place, score in enumerate(wanted):
                best = first(np.flatnonzero(other & (hundred >= low * score) & (hundred <= high * score)), scores, count)
                out[0] += [anchor] * len(best)
                out[1] += [place] * len(best)
                out[2] += ids[best].tolist()
                out[3] += [_long(s) for s in scores[best]]
    return pa.table(dict(zip(("anchor", "place", "negative_id", "negative_score"), (pa.array(c, pa.int64()) for c in out), strict=True)))


def _grid(anchors: DataFrame, rows: DataFrame, parts: Column, groups: Column, keys: list[str], work, schema: str) -> DataFrame:
    """Every anchor with every row that is equal in ``keys``: anchors by groups, rows by parts, a task per cell of that grid."""
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "vector"), n.cast("long")).cast("int")
    anew = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])  # noqa: E731  (both sides come from one table)
    left = anew(anchors.withColumn("g", own(1, groups)).withColumn("p", each(parts)))
    right = anew(rows.withColumn("p", own(2, parts)).withColumn("g", each(groups)))
    cell = [*keys, "g", "p"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(work, schema)


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchor`` holds.

    rows: vec_id, label, embedding. Components become ``floor(scale * x)``; a score is the inner product of two rows. An anchor's positives are its
    first ``positives`` other rows of its label, highest score first, ties by smaller id. For each, the first ``negatives`` rows of
    other labels whose score lies from ``low`` to ``high`` percent of the positive's. A negative positive's score leaves nothing between.

    Rows without id, label or vector, or with a null or non-finite component, take no part; vectors of different length do not meet, nor
    do empty ones. Rows equal in id, label and numbers are one row; rows that share only an id are separate. Copies with other ids are
    rows like any other, in order of their ids. Other columns are left out, so their names cannot clash. An empty table gives an empty result.
    A score beyond a long raises.
    """
    spark = rows.sparkSession
    # The anchor test is made on the caller's columns, the rest on a fixed set.
    work = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("chosen")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")) & (F.size("vector") > 0))
    work = work.withColumn("vector", whole_numbers(F.col("vector"), scale)).groupBy("vec_id", "label", "vector").agg(F.max("chosen").alias("chosen"))
    work = stored(work.withColumn("size", F.size("vector")))
    anchors = work.where("chosen").select(F.xxhash64("vec_id", "label", "vector").alias("anchor"), "vec_id", "label", "size", "vector")

    # Positives: a label's anchors meet its rows. A hot label is cut into parts like the whole table.
    cells = lambda n, most: F.greatest(F.lit(1), F.ceil(n / most)).cast("int")
    least = max(1, spark.sparkContext.defaultParallelism)
    dealt = lambda n: F.greatest(cells(n, PART), F.least(F.lit(least), cells(n, CHUNK // 4)))
    sizes = stored(work.groupBy("label", "size").agg(F.count("*").alias("n"), F.count_if("chosen").alias("a")).where("a > 0"))
    sizes = sizes.select("label", "size", dealt(F.col("n")).alias("parts"), cells(F.col("a"), GROUP).alias("groups"))
    near = _grid(
        anchors.join(sizes, ["label", "size"]).select("anchor", "vec_id", "label", "size", "vector", "parts", "groups"),
        work.join(sizes, ["label", "size"]).select("vec_id", "label", "size", "vector", "parts", "groups"),
        F.col("parts"), F.col("groups"), ["label", "size"], lambda a, b: _near(a, b, positives), "anchor long, positive_id long, positive_score long",
    )
    best = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives)
    near = stored(near)

    # Negatives: all anchors that have positives meet all rows of their length.
    wanted = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).getField("positive_score").alias("wanted"))
    sizes = stored(work.groupBy("size").agg(F.count("*").alias("n"), F.count_if("chosen").alias("a")).where("a > 0"))
    sizes = sizes.select("size", dealt(F.col("n")).alias("parts"), cells(F.col("a"), GROUP).alias("groups"))
    found = _grid(
        anchors.join(wanted, "anchor").join(sizes, "size").select("anchor", "vec_id", "label", "size", "vector", "wanted", "parts", "groups"),
        work.join(sizes, "size").select("vec_id", "label", "size", "vector", "parts", "groups"),
        F.col("parts"), F.col("groups"), ["size"], lambda a, b: _between(a, b, negatives, low, high), "anchor long, place long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = near.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    out = found.join(names, ["anchor", "place"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13(spark, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s WHERE same) WHERE k <= {POSITIVES}
), n AS (
  SELECT p.a, p.b AS pb, p.score AS ps, s.b AS nb, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS k
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
)
SELECT a AS anchor_id, pb AS positive_id, CAST(k AS INTEGER) AS rank, nb AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE k <= {NEGATIVES}"""
