"""Counts taken by the pass that writes: the rows written, and what the stages before let through, without a second scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import normalize, validate
from .tablelog import TableLog


class Counted:
    """Named counts on the way to a write. ``stage`` adds counts of the rows that pass there; ``values`` are known once the write has run."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def stage(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *[c.alias(name) for name, c in counts.items()])

    @property
    def values(self) -> dict[str, int]:
        return {name: value for seen in self._seen for name, value in seen.get.items()}

    def table(self, like: DataFrame) -> DataFrame:
        """The counts as one row."""
        values = self.values
        return like.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"{n} long" for n in values))


def school_rows_loaded(df: DataFrame, log: TableLog, batch: str, **options) -> DataFrame:
    """Normalise, validate and append school rows in one pass over ``df``; returns parsed, normalized, valid and failed as one row.

    A batch that the log has is not written again, and has no counts of its own: the result is empty.
    """
    counted = Counted()
    rows = counted.stage(df, parsed=F.count(F.lit(1)))
    rows = normalize.normalize_school(rows, **options)
    rows = counted.stage(rows, normalized=F.count(F.lit(1)))
    checked = counted.stage(validate.checked(rows, "school"), valid=F.count_if(F.col("error").isNull()), failed=F.count("error"))
    loaded = log.append(checked.where("error IS NULL").drop("error"), batch)
    return counted.table(df) if loaded else df.sparkSession.createDataFrame([], "parsed long, normalized long, valid long, failed long")
