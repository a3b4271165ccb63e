"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2t) of each other, and so do their projections on any
orthonormal directions. Vectors are sorted by grid cells of side eps on the leading principal directions and cut into
blocks of the sequence. Intervals of the sequence are joined recursively, from large ones down to blocks and halves of blocks, only if
their bounding boxes are within eps; what is left is compared in double precision. Links are counted and contracted where they are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .components import components

THRESHOLD = 0.98
DIRECTIONS = 8
SAMPLE = 4096
BLOCK = 512
INTERVAL = 16  # blocks, or intervals of the level below
TOP = 256  # intervals of a label on the highest level
LEAF = 128


def usable() -> F.Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)


def directions(vectors: DataFrame, sample: int, count: int) -> dict[int, np.ndarray]:
    """Leading principal directions for each vector length, from ``sample`` distinct vectors or so (a stated bound; any directions give right results).

    vectors: a stored table of distinct (label, vector). Their hashes cut the sample out where the rows lie.
    """
    total = vectors.count()
    rows = vectors.select("vector", F.xxhash64("label", "vector").alias("r"))
    found = (rows if total <= sample else rows.where(F.col("r") < int(-(2**63) + 2**64 * (sample / total)))).select("vector").collect()
    out = {}
    for size in {len(r["vector"]) for r in found}:
        units = np.array([_unit(r["vector"]) for r in found if len(r["vector"]) == size])
        out[size] = np.linalg.eigh(np.cov(units.T, bias=True).reshape(size, size))[1][:, ::-1][:, :count]
    return out


def project(units: np.ndarray, axes: dict[int, np.ndarray], count: int) -> np.ndarray:
    """Projections, with zeros where there are fewer directions than asked for. A length not in the sample uses its first coordinates."""
    size = units.shape[1]
    axis = axes.get(size, np.eye(size)[:, :count])
    out = np.zeros((len(units), count))
    out[:, :axis.shape[1]] = units @ axis
    return out


def _unit(vector) -> np.ndarray:
    """Scaled by the largest component first, so that no square leaves the range of a double."""
    v = np.asarray(vector, dtype=np.float64)
    v = v / np.abs(v).max()
    return v / np.linalg.norm(v)


def _units(batch_vectors: pa.Array) -> list[np.ndarray]:
    return [_unit(v) for v in batch_vectors.to_pylist()]


def with_cells(vectors: DataFrame, axes, eps: float, count: int) -> DataFrame:
    """Add ``cells``: grid cells of the projections, as one array in order of the directions."""

    def add(batches):
        for batch in batches:
            cells = [np.floor(project(u[None, :], axes, count)[0] / eps).astype(np.int32).tolist() for u in _units(batch["vector"])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])

    return vectors.mapInArrow(add, "node long, copies long, label long, size int, vector array<double>, cells array<int>")


_BLOCK = "label long, size int, part long, number long, lo array<double>, hi array<double>, nodes array<long>, copies array<long>, units binary"


def blocks(ordered: DataFrame, axes, count: int, per_block: int) -> DataFrame:
    """Runs of the sorted sequence with one label and size, with bounding box and unit vectors."""

    def cut(batches):
        part, number, held, key = TaskContext.get().partitionId(), 0, [], None

        def flush():
            nonlocal number, held
            units = np.array([u for _, _, u in held])
            at = project(units, axes, count)
            row = {
                "label": [key[0]], "size": [key[1]], "part": [part], "number": [number], "lo": [at.min(0).tolist()], "hi": [at.max(0).tolist()],
                "nodes": [[n for n, _, _ in held]], "copies": [[c for _, c, _ in held]], "units": [units.tobytes()],
            }
            number, held = number + 1, []
            return pa.RecordBatch.from_pydict(row, schema=shape)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("node", "copies", "label", "size")]
            for node, copies, label, size, unit in zip(*columns, _units(batch["vector"]), strict=True):
                if held and ((label, size) != key or len(held) == per_block):
                    yield flush()
                key = (label, size)
                held.append((node, copies, unit))
        if held:
            yield flush()

    double = pa.list_(pa.float64())
    longs = pa.list_(pa.int64())
    shape = pa.schema([("label", pa.int64()), ("size", pa.int32()), ("part", pa.int64()), ("number", pa.int64()), ("lo", double), ("hi", double), ("nodes", longs), ("copies", longs), ("units", pa.binary())])
    return ordered.select("node", "copies", "label", "size", "vector").mapInArrow(cut, _BLOCK)


def _near(eps: float) -> F.Column:
    """The boxes of a and b are within eps."""
    gaps = F.zip_with(F.arrays_zip("a_lo", "a_hi"), F.arrays_zip("b_lo", "b_hi"), lambda a, b: F.greatest(F.lit(0.0), b["b_lo"] - a["a_hi"], a["a_lo"] - b["b_hi"]))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x) <= eps * eps


def intervals(boxes: DataFrame, count: int) -> list[DataFrame]:
    """The blocks, intervals of up to 16 blocks, intervals of up to 16 of these, and so on, until a label has at most ``TOP`` of them.

    Each level has label, size, part, number, the box, and up_part and up_number, which name its interval on the next level.
    """
    ends = [F.min(F.col("lo")[i]).alias(f"lo{i}") for i in range(count)] + [F.max(F.col("hi")[i]).alias(f"hi{i}") for i in range(count)]
    box = [F.array(*[f"{s}{i}" for i in range(count)]).alias(s) for s in ("lo", "hi")]
    levels, now = [], boxes
    while True:
        most, number, part = now.groupBy("label", "size").agg(F.count("*").alias("n"), F.max("number").alias("number"), F.max("part").alias("part")).agg(F.max("n"), F.max("number"), F.max("part")).first()
        if most is None or most <= TOP or not number and not part:
            return [*levels, now]
        # Numbers within a partition of the sequence are gathered first, partitions next to each other after that.
        up = [F.col("part"), F.floor(F.col("number") / INTERVAL)] if number else [F.floor(F.col("part") / INTERVAL), F.col("number")]
        now = now.withColumns({"up_part": up[0].cast("long"), "up_number": up[1].cast("long")})
        levels.append(now)
        wide = now.groupBy("label", "size", F.col("up_part").alias("part"), F.col("up_number").alias("number")).agg(*ends)
        now = stored(wide.select("label", "size", "part", "number", *box))


def near_blocks(boxes: DataFrame, eps: float, count: int) -> DataFrame:
    """Pairs of blocks (a_part, a_number, b_part, b_number; a not after b) whose boxes are within eps.

    Recursion over the sequence: the few intervals of the top level meet within their label; below, only the members of near intervals
    meet, by equality with the interval. An interval has 16 members at most, so no key of these joins is hot.
    """
    levels = intervals(boxes, count)
    order = (F.col("a_part") < F.col("b_part")) | (F.col("a_part") == F.col("b_part")) & (F.col("a_number") <= F.col("b_number"))

    def side(level, s):
        return level.select(*[F.col(c).alias(c if c in ("label", "size") else f"{s}_{c}") for c in level.columns])

    names = ["label", "size", "a_part", "a_number", "b_part", "b_number"]
    top = levels[-1].select("label", "size", "part", "number", "lo", "hi")
    pairs = side(top, "a").join(side(top, "b"), ["label", "size"]).where(order).where(_near(eps)).select(*names)
    for level in reversed(levels[:-1]):
        above = stored(pairs).select("label", "size", *[F.col(f"{s}_{c}").alias(f"{s}_up_{c}") for s in "ab" for c in ("part", "number")])
        pairs = above.join(side(level, "a"), ["label", "size", "a_up_part", "a_up_number"]).join(side(level, "b"), ["label", "size", "b_up_part", "b_up_number"])
        pairs = pairs.where(order).where(_near(eps)).select(*names)
    return pairs


def join_halves(left, right, eps: float, same: bool):
    """Index pairs of near halves: recursion over the two intervals of the sequence, down to leaves that are compared whole.

    left, right: (projections, first index). Yields slices (i0, i1, j0, j1)."""
    (p, i), (q, j) = left, right
    gap = np.maximum(0, np.maximum(q.min(0) - p.max(0), p.min(0) - q.max(0)))
    if gap @ gap > eps * eps:
        return
    if len(p) <= LEAF and len(q) <= LEAF:
        yield i, i + len(p), j, j + len(q)
        return
    if same:
        half = len(p) // 2
        parts = (p[:half], i), (p[half:], i + half)
        yield from join_halves(parts[0], parts[0], eps, True)
        yield from join_halves(*parts, eps, False)
        yield from join_halves(parts[1], parts[1], eps, True)
    elif len(p) >= len(q):
        half = len(p) // 2
        yield from join_halves((p[:half], i), right, eps, False)
        yield from join_halves((p[half:], i + half), right, eps, False)
    else:
        half = len(q) // 2
        yield from join_halves(left, (q[:half], j), eps, False)
        yield from join_halves(left, (q[half:], j + half), eps, False)


class Forest:
    """Components of the vectors of two blocks, as an array of labels."""

    def __init__(self, size: int):
        self.labels, self.edges = np.arange(size), []

    def join(self, i: int, others: np.ndarray) -> None:
        """i is linked with the others; an edge is kept for each component that i joins."""
        labels, places = np.unique(self.labels[others], return_index=True)
        for label, j in zip(labels.tolist(), others[places].tolist()):
            if label != self.labels[i]:
                self.edges.append((i, j))
                self.labels[self.labels == label] = self.labels[i]


def links(found: DataFrame, pairs: DataFrame, axes, eps: float, threshold: float, count: int) -> DataFrame:
    """What the cosines >= threshold of near blocks come to: rows (a, others), the copies of all vectors that a links to in one pair of
    blocks, and rows (a, b), the edges of a spanning forest of its links. A pair of blocks gives no more rows than it has vectors, twice.
    """
    load = found.select("part", "number", "size", "nodes", "copies", "units")
    rows = pairs.select("a_part", "a_number", "b_part", "b_number")
    for s in "ab":
        rows = rows.join(load.select(*[F.col(c).alias(f"{s}_{c}") for c in load.columns]), [f"{s}_part", f"{s}_number"])

    def compare(batches):
        for batch in batches:
            out = [[], [], []]
            for k in range(batch.num_rows):
                value = lambda c, k=k: batch[c][k].as_py()
                size = value("a_size")
                same = (value("a_part"), value("a_number")) == (value("b_part"), value("b_number"))
                u = np.frombuffer(batch["a_units"][k].as_buffer(), dtype=np.float64).reshape(-1, size)
                v = u if same else np.frombuffer(batch["b_units"][k].as_buffer(), dtype=np.float64).reshape(-1, size)
                nodes, copies = value("a_nodes"), value("a_copies")
                shift = 0 if same else len(nodes)
                nodes, copies = (nodes, copies) if same else (nodes + value("b_nodes"), copies + value("b_copies"))
                copies, others, forest = np.array(copies), np.zeros(len(nodes), dtype=np.int64), Forest(len(nodes))
                p = project(u, axes, count)
                q = p if same else project(v, axes, count)
                for i0, i1, j0, j1 in join_halves((p, 0), (q, 0), eps, same):
                    near = u[i0:i1] @ v[j0:j1].T >= threshold
                    if same and i0 == j0:
                        near = np.triu(near, 1)
                    if not near.any():
                        continue
                    i, j = np.arange(i0, i1), np.arange(j0, j1) + shift
                    others[i] += near @ copies[j]
                    others[j] += near.T @ copies[i]
                    for x in np.flatnonzero(near.any(1)).tolist():
                        forest.join(i0 + x, j[near[x]])
                linked = np.flatnonzero(others).tolist()
                out[0] += [nodes[x] for x in linked] + [nodes[x] for x, _ in forest.edges]
                out[1] += [None] * len(linked) + [nodes[y] for _, y in forest.edges]
                out[2] += others[linked].tolist() + [None] * len(forest.edges)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "others"])

    return rows.mapInArrow(compare, "a long, b long, others long")


def link_embeddings(df: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, count: int = DIRECTIONS, per_block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels (not null) and equal length link if their cosine is at least ``threshold``. Equal vectors of a label are joined once:
    copies are counted, not paired. Null, zero, or partly null or non-finite vectors, and rows without label or vec_id, link with
    nothing: 0 links, their own id as component (null where the id is null, and then not kept). vec_id names a vector: rows
    that share one are one vertex of the components. Repeated rows count as separate vectors. Other columns are left out. An empty table gives an empty result.
    """
    eps = float(np.sqrt(2 - 2 * threshold)) * (1 + 1e-9) + 1e-9
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"))
    valid = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keys = [F.xxhash64(F.lit(s), "label", "vector").alias(f"g{s}") for s in (1, 2)]
    groups = stored(rows.where(valid).groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    axes = directions(groups, sample, count)
    # Written with their cells, so that sampling the sort order does not project them again.
    groups = stored(with_cells(groups.select("node", "copies", "label", F.size("vector").alias("size"), "vector"), axes, eps, count))
    order = ["label", "size", "cells", "node"]
    found = stored(blocks(groups.repartitionByRange(*order).sortWithinPartitions(*order), axes, count, per_block))
    pairs = near_blocks(found.select("label", "size", "part", "number", "lo", "hi"), eps, count)
    near = stored(links(found, pairs, axes, eps, threshold, count))

    others = near.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("others"))
    known = groups.select("node", "copies", *keys).join(others, "node", "left").join(components(near.where("b IS NOT NULL").select("a", "b")), "node", "left")
    known = known.groupBy("g1", "g2").agg(F.max(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.min(F.coalesce("component", "node")).alias("component"))
    # A vector with very many copies: its one row is repeated over salts that spread the copies.
    known = stored(known).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    out = rows.select("vec_id", *[F.when(valid, k).alias(n) for k, n in zip(keys, ("g1", "g2"), strict=True)], F.pmod(F.xxhash64("vec_id"), F.lit(16)).cast("int").alias("salt"))
    out = out.join(known, ["g1", "g2", "salt"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op4(spark, folder: str) -> DataFrame:
    return link_embeddings(table(spark, folder, "embeddings"))


OP4_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), unit AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM good WHERE label IS NOT NULL AND v IS NOT NULL
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id"""
