"""Gold by landing days: a new day changes the groups that it has rows for, and no others.

What a landing day adds to each group (counts, and the parts of exact sums) is kept as a
state of that day, by month of the group's date. Sums of states are the sums of all rows, so
that a landing reads its own records, and of the states only the months that it touches.
Landing a day again replaces its state: nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.numbers import PARTS, merged_sums, partial_sums
from ridelake.operators import gold
from ridelake.session import setting
from ridelake.sources.scratch import remove_folder, subfolders


@dataclass(frozen=True)
class Running:
    """An aggregate that is kept by landing day.

    rows: the records' group keys (first a `date`), flags and measures; counts: flags
    counted, by result name (`*` counts rows); finish: the result columns of a merged state.
    """

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    counts: dict[str, str]
    measures: tuple[str, ...]
    columns: Callable[[dict[str, dict[str, Column]]], list[Column]]

    def state(self, records: DataFrame) -> DataFrame:
        """One row a group: what these records add to it."""
        counts = [
            (F.count(F.lit(1)) if flag == "*" else F.count_if(flag)).alias(name) for name, flag in self.counts.items()
        ]
        parts = [c.alias(f"{m}_{k}") for m in self.measures for k, c in partial_sums(F.col(m)).items()]
        return self.rows(records).groupBy(*self.keys).agg(*counts, *parts)

    def parts(self) -> dict[str, dict[str, Column]]:
        return {m: {k: F.col(f"{m}_{k}") for k in PARTS} for m in self.measures}

    def merged(self, states: DataFrame) -> DataFrame:
        counts = [F.sum(c).cast("bigint").alias(c) for c in self.counts]
        parts = [c.alias(f"{m}_{k}") for m, own in self.parts().items() for k, c in merged_sums(own).items()]
        return states.groupBy(*self.keys).agg(*counts, *parts)

    def result(self, state: DataFrame) -> DataFrame:
        return state.select(*self.keys, *self.counts, *self.columns(self.parts()))


RIDE_DAYS = Running(
    gold.ride_daily_rows,
    ("date", "city"),
    {"total_rides": "*", "completed_rides": "done"},
    gold.RIDE_MEASURES,
    gold.ride_daily_columns,
)
DRIVER_DAYS = Running(
    gold.driver_daily_rows,
    ("date", "driver_id"),
    {"completed_rides": "*"},
    gold.DRIVER_MEASURES,
    gold.driver_daily_columns,
)

MONTH = ("date_year", "date_month")


def _months(states: DataFrame) -> set[tuple[int, int]]:
    """The months that states have rows for, from their partitions."""
    return {tuple(r) for r in states.select(*MONTH).distinct().collect()}


def _of(months: set[tuple[int, int]]) -> Column:
    year, month = (F.col(c) for c in MONTH)
    picked = F.lit(False)
    for y in sorted({y for y, _ in months}):
        picked = picked | ((year == y) & month.isin(sorted(m for own, m in months if own == y)))
    return picked


def land(records: DataFrame, running: Running, folder: str, day: str) -> set[tuple[int, int]]:
    """Take the records landed on `day` into the result in <folder>/result; returns the months changed.

    <folder>/states/ingestion_date=<day> gets the day's state; then the result of the
    months that it touches, or did before, is made anew of all states of these months.
    """
    spark = records.sparkSession
    states, result = f"{folder}/states", f"{folder}/result"
    own = f"{states}/ingestion_date={day}"
    known = any(f.rstrip("/").endswith(f"ingestion_date={day}") for f in subfolders(spark, states))
    before = _months(spark.read.parquet(own)) if known and subfolders(spark, own) else set()
    dated = running.state(records).withColumns({"date_year": F.year("date"), "date_month": F.month("date")})
    schema = dated.schema
    dated.write.mode("overwrite").partitionBy(*MONTH).parquet(own)
    after = _months(spark.read.schema(schema).parquet(own))
    changed = before | after
    # A row a group and landing day, of the months changed alone.
    kept = changed_states(spark, schema, states, changed)
    made = running.result(running.merged(kept))
    made = made.withColumns({"date_year": F.year("date"), "date_month": F.month("date")})
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        made.hint("rebalance", *(F.col(c) for c in MONTH)).write.mode("overwrite").partitionBy(*MONTH).parquet(result)
    if gone := before - after:
        left = _months(changed_states(spark, schema, states, gone))
        for year, month in gone - left:
            remove_folder(spark, f"{result}/date_year={year}/date_month={month}")
    return changed


def changed_states(spark: SparkSession, schema, states: str, months: set[tuple[int, int]]) -> DataFrame:
    """The states of some months; other months' files are not read."""
    return spark.read.schema(schema).parquet(states).filter(_of(months))


def landed_result(spark: SparkSession, running: Running, folder: str) -> DataFrame:
    """The result over all landing days."""
    return spark.read.parquet(f"{folder}/result").drop(*MONTH)
