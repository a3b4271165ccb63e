"""Sharding by histogram sort: exact bytes below candidate boundaries are counted in rounds, then rows move once.

Rows are ordered by (hash of the text, doc_id): equal texts lie side by side, and a group too large for
one shard is cut between documents. Each round counts, for every probe, the bytes and rows below it,
and takes its next probes from keys drawn inside the intervals that still need them. The driver sees
one row per probe, a number set by the parameters alone.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

LEAST = -(2**63)
DRAWS = 8
PIECE_BYTES = 1 << 30


def keyed(df: DataFrame, id_column: str, text_column: str, carry=()) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LEAST)).alias("d"),
        *([F.struct(*carry).alias("row")] if carry else []),
    )


def positions(h: np.ndarray, d: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """Number of probes at or before each key (h, d)."""
    heads = np.array([p[0] for p in probes], dtype=np.int64)
    tails = np.array([p[1] for p in probes], dtype=np.int64)
    low, high = np.searchsorted(heads, h, "left"), np.searchsorted(heads, h, "right")
    out = high.astype(np.int32)
    tied = low < high
    for value in np.unique(h[tied]):
        rows = h == value
        a, b = np.searchsorted(heads, value, "left"), np.searchsorted(heads, value, "right")
        out[rows] = a + np.searchsorted(tails[a:b], d[rows], "right")
    return out


def with_bucket(rows: DataFrame, probes: list[tuple[int, int]], shard=None, base=None) -> DataFrame:
    """Add ``bucket`` (interval between probes), and its shard and first slot where given."""
    extra = [("bucket", pa.int32(), T.IntegerType())]
    if shard is not None:
        extra += [("shard", pa.int32(), T.IntegerType()), ("base", pa.int64(), T.LongType())]

    def add(batches):
        for batch in batches:
            at = positions(batch["h"].to_numpy(), batch["d"].to_numpy(), probes)
            values = [at] if shard is None else [at, np.asarray(shard, dtype=np.int32)[at], np.asarray(base, dtype=np.int64)[at]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, kind) for v, (_, kind, _) in zip(values, extra, strict=True))],
                names=[*batch.schema.names, *(name for name, _, _ in extra)],
            )

    return rows.mapInArrow(add, T.StructType([*rows.schema.fields, *(T.StructField(n, t) for n, _, t in extra)]))


def histogram(rows: DataFrame, probes: list[tuple[int, int]], turn: int) -> list:
    """Per interval: bytes, rows, end keys and a few drawn keys; one row per non-empty interval."""
    key = F.struct("h", "d")
    draws = [F.min(F.struct(F.xxhash64(F.lit(turn * DRAWS + i), "h", "d").alias("r"), key.alias("key"))).alias(f"draw{i}") for i in range(DRAWS)]
    counted = with_bucket(rows.select("h", "d", "size"), probes).groupBy("bucket").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"), *draws
    )
    return counted.collect()


def splitters(rows: DataFrame, shards: int, pieces: int, tolerance: float):
    """Probes with, for each interval, its shard and the slot of its first row there."""
    steps = shards * pieces
    probes = [(LEAST + i * 2**64 // steps, LEAST) for i in range(1, steps)]
    turn = 0
    while True:
        size, count, inside = np.zeros(len(probes) + 1), np.zeros(len(probes) + 1, dtype=np.int64), {}
        size = size.astype(np.int64)
        for r in histogram(rows, probes, turn):
            size[r["bucket"]], count[r["bucket"]], inside[r["bucket"]] = r["bytes"], r["rows"], r
        below = np.concatenate([[0], np.cumsum(size)])
        total = int(below[-1])
        targets = [total * j / shards for j in range(1, shards)]
        wanted = set()
        for b, r in inside.items():
            if tuple(r["lo"]) == tuple(r["hi"]):
                continue
            here = [t for t in targets if below[b] < t < below[b + 1]]
            if size[b] * steps > 2 * total or any(min(t - below[b], below[b + 1] - t) > tolerance * total / shards for t in here):
                wanted |= {tuple(r[f"draw{i}"]["key"]) for i in range(DRAWS)} | {tuple(r["hi"])}
                wanted.discard(tuple(r["lo"]))
        turn += 1
        wanted -= set(probes)
        if not wanted:
            break
        probes = sorted({*probes, *wanted})
    ends = below[1:-1]  # bytes before each probe
    cuts = []
    for t in targets:
        i = bisect_left(ends, t)
        near = [j for j in (i - 1, i) if 0 <= j < len(ends)]
        cuts.append(min(near, key=lambda j: abs(ends[j] - t)) + 1)  # the first interval after the cut
    cuts = np.maximum.accumulate(np.array(cuts, dtype=np.int64))
    shard = np.searchsorted(cuts, np.arange(len(probes) + 1), "right")
    before = np.concatenate([[0], np.cumsum(count)])
    first = np.concatenate([[0], cuts])
    return probes, shard, before[:-1] - before[first[shard]]


def shard_documents(
    df: DataFrame, shards: int = 24, pieces: int | None = None, tolerance: float = 0.002, id_column: str = "doc_id", text_column: str = "text", carry=()
) -> DataFrame:
    """Shard and slot of every document, with near equal bytes in the shards.

    A shard's bytes differ from an equal share by ``tolerance`` of it at most, or by one document where a
    document is larger than that. ``pieces``: sorted intervals per shard, so that no task orders a whole shard (16, or as many as
    hold a gigabyte each);
    intervals larger than twice that are cut further, inside groups of equal texts too.
    Columns in ``carry`` come along as struct ``row`` in the one exchange; others, also those with names used here, are left out.
    A null text counts as empty; null ids come first among equal texts. Repeated rows (same id and text) share a key,
    stay together and get successive slots. An empty table gives an empty result.
    """
    rows = stored(keyed(df, id_column, text_column))
    if pieces is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        pieces = max(16, -(-total // (shards * PIECE_BYTES)))
    probes, shard, base = splitters(rows, shards, pieces, tolerance)
    rows = keyed(df, id_column, text_column, carry) if carry else rows
    placed = with_bucket(rows, probes, shard, base)
    order = Window.partitionBy("bucket").orderBy("h", "d")
    placed = placed.withColumn("slot", F.col("base") + F.row_number().over(order) - 1)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["row"] if carry else []),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """The carried rows as one folder per shard, each in slot order within its files."""
    sharded.select("shard", "slot", "row.*").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def op9(spark, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))
