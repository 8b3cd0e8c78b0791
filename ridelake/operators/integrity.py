"""Referential integrity, null profile and range profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fk_violations(
    child: DataFrame, column: str, parent: DataFrame, key: str | None = None
) -> DataFrame:
    """Child key values without a parent row, with the number of child rows.

    A NULL child key has no parent. Child rows are counted per key before the
    join, so the join sees each key once however often it is referenced.
    """
    refs = child.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    parents = parent.select(F.col(key or column).alias(column))
    return refs.join(parents, column, "left_anti")


def orphan_rows(
    child: DataFrame, column: str, parent: DataFrame, key: str | None = None
) -> DataFrame:
    """Whole child rows without a parent row.

    Rows with a NULL key are orphans without looking, and are kept out of the
    join, where they would all meet in one task.
    """
    parents = parent.select(F.col(key or column).alias(column))
    keyed = child.filter(F.col(column).isNotNull())
    return keyed.join(parents, column, "left_anti").unionByName(
        child.filter(F.col(column).isNull())
    )


@dataclass(frozen=True)
class Relation:
    """Every `column` of `child` is a `key` of `parent`."""

    child: str
    column: str
    parent: str
    key: str


#: The foreign keys of the five entities.
RELATIONS = (
    Relation("ride", "passenger_id", "passenger", "passenger_id"),
    Relation("ride", "driver_id", "driver", "driver_id"),
    Relation("ride", "vehicle_id", "vehicle", "vehicle_id"),
    Relation("payment", "ride_id", "ride", "ride_id"),
    Relation("vehicle", "driver_id", "driver", "driver_id"),
)


def all_fk_violations(frames: Mapping[str, DataFrame], relations: Sequence[Relation] = RELATIONS) -> DataFrame:
    """(child, column_name, parent, key_value, row_count): `fk_violations` of several relations at once.

    Each frame is read once and gives, for every relation that it takes part in, a row of
    the parent's key space: the key, and a mark for what it is there. One aggregate of the
    marks, combined before its shuffle, knows of every key whether it has a parent row and how
    many rows of each child refer to it. Keys are compared as text. A NULL key has no parent.
    """
    spaces = list(dict.fromkeys((r.parent, r.key) for r in relations))

    def mark(space: tuple[str, str], column: str, relation: int) -> Column:
        return F.struct(
            F.lit(spaces.index(space)).alias("space"),
            F.col(column).cast("string").alias("key_value"),
            F.lit(relation).alias("relation"),
        )

    every = None
    for name, df in frames.items():
        marks = [mark(s, s[1], -1) for s in spaces if s[0] == name]
        marks += [mark((r.parent, r.key), r.column, i) for i, r in enumerate(relations) if r.child == name]
        if marks:
            part = df.select(F.explode(F.array(*marks)).alias("mark")).select("mark.*")
            every = part if every is None else every.unionByName(part)
    held = F.col("relation") == -1
    counts = [F.count_if(F.col("relation") == i).alias(f"n{i}") for i in range(len(relations))]
    keys = every.groupBy("space", "key_value").agg(F.max(held & F.col("key_value").isNotNull()).alias("held"), *counts)
    found = [
        F.struct(
            F.lit(r.child).alias("child"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.parent).alias("parent"),
            F.col("key_value"),
            F.col(f"n{i}").alias("row_count"),
        )
        for i, r in enumerate(relations)
    ]
    orphans = keys.filter(~F.col("held")).select(F.inline(F.array(*found)))
    return orphans.filter(F.col("row_count") > 0)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column_name, null_count, row_count), in a single pass over `df`."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)),
    )
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"n{i}").alias("null_count"),
                        F.col("row_count"),
                    )
                    for i, c in enumerate(names)
                )
            )
        )
    )


def range_profile(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows (column_name, below, above, missing), in a single pass over `df`.

    Bounds are inclusive. NaN counts as above.
    """
    names = list(bounds)
    counts = df.agg(
        *(F.count_if(F.col(c) < bounds[c][0]).alias(f"b{i}") for i, c in enumerate(names)),
        *(F.count_if(F.col(c) > bounds[c][1]).alias(f"a{i}") for i, c in enumerate(names)),
        *(F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(names)),
    )
    return counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"b{i}").alias("below"),
                        F.col(f"a{i}").alias("above"),
                        F.col(f"m{i}").alias("missing"),
                    )
                    for i, c in enumerate(names)
                )
            )
        )
    )
