"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


LOCAL_EDGES = 500_000


def contracted(edges: DataFrame) -> DataFrame:
    """The edges of each partition as stars around their smallest node: the same components with fewer edges.

    A partition's nodes are held in one dictionary; partitions are made of ``LOCAL_EDGES`` edges or so.
    """

    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node on an edge (columns a, b; longs, no nulls).

    Edges are contracted where they lie; then steps of joins and aggregations over edges run until every node points at its
    component. The table never holds more edges than it began with, and the driver sees two yes-or-no answers per step.
    """
    edges = stored(edges.where("a <> b").select("a", "b"))
    now = stored(contracted(edges.coalesce(max(1, -(-edges.count() // LOCAL_EDGES)))).distinct())
    while True:
        several = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        inner = now.join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if several.isEmpty() and inner.isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: neighbours above a node point at the smallest of its neighbourhood.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its neighbours below point at the smallest of these.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        now = stored(small)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
