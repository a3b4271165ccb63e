"""Rules worked out once per distinct text instead of once per row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

SALTS = 4


@dataclass(frozen=True)
class Group:
    """Columns whose combinations are few, and the rules over them: a table of the inputs (as text) in, the same with the results out."""

    inputs: tuple[str, ...]
    evaluate: Callable[[DataFrame], DataFrame]


def by_distinct(df: DataFrame, groups: Sequence[Group], salts: int = SALTS) -> DataFrame:
    """``df`` with the columns that each group's rules make of the distinct combinations of its inputs; they replace columns of the same name.

    One pass over ``df`` writes the combinations of all groups, in partial aggregates. The size of that table decides between a
    broadcast and a shuffle join of the results; they are repeated over salts that the rows are spread by, so that a text on a
    third of all rows meets several tasks. Nulls are texts like any other.
    """
    widest = max(len(g.inputs) for g in groups)
    entry = [
        F.struct(F.lit(i).alias("kind"), *[(F.col(g.inputs[k]).cast("string") if k < len(g.inputs) else F.lit(None).cast("string")).alias(f"t{k}") for k in range(widest)])
        for i, g in enumerate(groups)
    ]
    known = written(df.select(F.inline(F.array(*entry))).distinct())
    out = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    for i, group in enumerate(groups):
        texts = known.where(F.col("kind") == i).select(*[F.col(f"t{k}").alias(c) for k, c in enumerate(group.inputs)])
        table = group.evaluate(texts)
        added = [c for c in table.columns if c not in group.inputs]
        table = table.select(
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_spread"), *[F.col(c).alias(f"_key{i}_{k}") for k, c in enumerate(group.inputs)], *[F.col(c).alias(f"_new{i}_{c}") for c in added]
        )
        match = F.col("_salt") == F.col("_spread")
        for k, c in enumerate(group.inputs):
            match = match & F.col(c).cast("string").eqNullSafe(F.col(f"_key{i}_{k}"))
        out = out.join(table, match, "left").drop("_spread", *[f"_key{i}_{k}" for k in range(len(group.inputs))])
    # Only now, as a result may replace the input of another group.
    new = {c[len(f"_new{i}_"):]: c for i in range(len(groups)) for c in out.columns if c.startswith(f"_new{i}_")}
    return out.select(*[c for c in df.columns if c not in new], *[F.col(c).alias(name) for name, c in new.items()])
