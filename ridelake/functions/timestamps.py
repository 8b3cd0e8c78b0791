"""ISO text timestamps, without exceptions and without the session time zone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Extended ISO form, date alone or date and time to the minute,
# second, millisecond or microsecond, with an optional zone offset. Spark's own
# cast is looser (it takes '2026', '10:00', ' 2026-05-01 '), hence the guard.
ISO = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?"
    r"(Z|[+-]\d{2}:\d{2})?)?\z"
)


def iso_timestamp(c: Column) -> Column:
    """Wall-clock timestamp of ISO text; NULL when the text is malformed."""
    return F.when(c.rlike(ISO), c.try_cast("timestamp_ntz"))


def has_zone(c: Column) -> Column:
    """Whether well-formed ISO text carries a zone offset.

    The shortest zoned form has 17 characters; it ends in Z or in +hh:mm.
    """
    ends = c.endswith("Z") | F.substring(c, -6, 1).isin("+", "-")
    return F.coalesce((F.length(c) > 16) & ends, F.lit(False))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column `name` as timestamp_ntz: text is parsed, typed columns are kept."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return iso_timestamp(F.col(name))
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    return F.col(name).cast("timestamp_ntz")


def as_date(df: DataFrame, name: str) -> Column:
    """Calendar day of column `name`; NULL when its text is malformed."""
    if isinstance(df.schema[name].dataType, T.DateType):
        return F.col(name)
    return F.to_date(as_timestamp(df, name))


def between_dates(df: DataFrame, name: str, low: str, high: str) -> DataFrame:
    """Rows with low <= `name` < high.

    Where the table was written with partition columns derived from `name`
    (`<name>_day`, `<name>_year`, `<name>_month`), the matching predicate on those is added, so
    that whole partitions are skipped.
    """
    lo, hi = F.lit(low).cast("date"), F.lit(high).cast("date")
    if isinstance(df.schema[name].dataType, T.StringType):
        when = as_timestamp(df, name)
    else:
        when = F.col(name)  # bare column: the comparison reaches the scan
    out = df.filter((when >= lo.cast("timestamp_ntz")) & (when < hi.cast("timestamp_ntz")))
    if f"{name}_day" in df.columns:
        out = out.filter(F.col(f"{name}_day").between(lo, F.date_sub(hi, 1)))
    first, last = date.fromisoformat(low), date.fromisoformat(high) - timedelta(days=1)
    if f"{name}_year" in df.columns:
        year = F.col(f"{name}_year")
        out = out.filter(year.between(first.year, last.year))
        if f"{name}_month" in df.columns:
            # Months are cut at the first and the last year; those between are whole.
            month = F.col(f"{name}_month")
            out = out.filter((year > first.year) | (month >= first.month))
            out = out.filter((year < last.year) | (month <= last.month))
    return out
