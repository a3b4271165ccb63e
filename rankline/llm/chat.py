"""Chat formatting after cumulative snapshots are collapsed. DataFrame functions only.

A logger that stores a conversation after every turn leaves many conversations that are a prefix of a
longer one. Every turn is hashed with its position; the running exclusive-or of these hashes names each
prefix. Conversations whose whole hash is a proper prefix of another one are removed by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table

SEGMENT = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KEY = ["cid", "known"]  # known is false for the one conversation without an id


def _hash(seed: int, *columns: str) -> Column:
    """Position and values; nulls differ from any value."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with its position in the conversation, the conversation's length and the hash of the prefix it ends (p1, p2).

    A conversation may hold a third of all rows, all of one turn number even: the rows are cut into ranges of even size over the whole order,
    windows work inside a conversation's part of a range (its band), and only one row per band is carried on.
    """
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("cid"), F.col("conv_id").isNotNull().alias("known"),
        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).distinct()
    order = [F.asc_nulls_last("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    rows = stored(rows.repartitionByRange(*KEY, *order).withColumn("band", F.spark_partition_id()))
    inside = Window.partitionBy(*KEY, "band").orderBy(*order)
    rows = rows.withColumn("pos", F.row_number().over(inside) - 1)

    whole = Window.partitionBy(*KEY)
    earlier = whole.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*KEY, "band").agg(F.count("*").alias("size"))
    sizes = sizes.select(*KEY, "band", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("n"))
    rows = rows.join(sizes, [*KEY, "band"]).withColumn("pos", (F.col("pos") + F.col("before")).cast("long")).drop("before")

    rows = rows.withColumns({"h1": _hash(1, "pos", "role", "text"), "h2": _hash(2, "pos", "role", "text")})
    running = Window.partitionBy(*KEY, "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy(*KEY, "band").agg(F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    sums = sums.select(*KEY, "band", *[F.coalesce(F.bit_xor(b).over(earlier), F.lit(0)).alias(b) for b in ("b1", "b2")])
    rows = rows.withColumns({p: F.bit_xor(h).over(running) for p, h in (("p1", "h1"), ("p2", "h2"))}).join(sums, [*KEY, "band"])
    return rows.select(*KEY, "pos", "n", "role", "text", F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("b2")).alias("p2"))


def maximal(rows: DataFrame) -> DataFrame:
    """Keys of the conversations that are no proper prefix of another; of equal ones the smallest id."""
    ends = rows.where("pos = n - 1").groupBy("n", "p1", "p2").agg(F.min(F.struct((~F.col("known")).alias("late"), "cid", "known")).alias("first"), F.count("*").alias("copies"))
    shorter = rows.where("pos < n - 1").select((F.col("pos") + 1).alias("n"), "p1", "p2").distinct()
    return ends.join(shorter, ["n", "p1", "p2"], "left_anti").select("first.cid", "first.known", "copies")


def format_chats(turns: DataFrame) -> DataFrame:
    """The maximal conversations, rendered: conv_id, segment, n_turns, n_copies, rendered.

    Turns are ordered by (turn, role, text), null turns last. Repeated rows are one turn. A null role is written as ``unknown``,
    a null text as empty; chat markers inside a text are broken by a space. Rows without conv_id form one conversation, whose
    id stays null. ``n_copies``: conversations with exactly these turns. A conversation of more than 256 turns gives several rows, one per
    segment of 256, so that no row gathers an unbounded group. Columns other than conv_id, turn, role and text are ignored.
    An empty table gives an empty result.
    """
    rows = stored(prefixes(turns))
    kept = rows.join(maximal(rows), KEY).withColumn("segment", F.floor(F.col("pos") / SEGMENT))
    said = F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    piece = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), said, F.lit(CLOSE + "\n"))
    grouped = kept.groupBy(*KEY, "n", "copies", "segment").agg(F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece")))).alias("pieces"))
    return grouped.select(
        F.when(F.col("known"), F.col("cid")).alias("conv_id"), "segment", F.col("n").alias("n_turns"), F.col("copies").alias("n_copies"),
        F.array_join("pieces.piece", "").alias("rendered"),
    )


def op5(spark, folder: str) -> DataFrame:
    return format_chats(table(spark, folder, "conversations"))


OP5_SQL = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos FROM turns),
whole AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY pos) AS l FROM placed GROUP BY conv_id),
firsts AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, l FROM whole GROUP BY l),
shorter AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM firsts)),
kept AS (SELECT * FROM firsts WHERE NOT EXISTS (SELECT 1 FROM shorter WHERE shorter.l = firsts.l)),
back AS (SELECT conv_id, n_copies, len(l) AS n_turns, unnest(l) AS t, generate_subscripts(l, 1) - 1 AS pos FROM kept)
SELECT conv_id, CAST(pos // {SEGMENT} AS BIGINT) AS segment, CAST(n_turns AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       string_agg('{OPEN}' || coalesce(t.r, 'unknown') || chr(10) || replace(coalesce(t.x, ''), '<|im_', '<| im_') || '{CLOSE}' || chr(10), '' ORDER BY pos) AS rendered
FROM back GROUP BY conv_id, n_copies, n_turns, pos // {SEGMENT}"""
