"""A stop for filter push-down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, columns=None, keep=()) -> DataFrame:
    """The columns as the output of a one-row generator.

    A later filter or join condition on derived columns would otherwise be pushed below the
    projection and carry a copy of every rule with each mention of a column. A generator stops
    that lazily, without a write.
    """
    columns = [c for c in df.columns if c not in keep] if columns is None else columns
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))
