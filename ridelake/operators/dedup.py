"""Duplicate removal and duplicate detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by `order`, then by every other column.

    `dropDuplicates` keeps whichever row arrives first, so a rerun may differ;
    this choice depends on the values only. A NULL key is a key like any other
    and NULLs sort first. The minimum is taken on the map side before the
    shuffle, so a hot key sends one row per task, not all its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = [c for c in (order or ()) if c in rest]
    ranked = lead + [c for c in rest if c not in lead]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("best"))
    return best.select(
        *(F.col(c) if c in keys else F.col("best")[c].alias(c) for c in df.columns)
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    )
