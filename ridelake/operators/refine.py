"""Silver by refinement: cast, filter and remove duplicates.

Filters come first so that they reach the scan; the duplicate choice is made
among the rows that pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import as_timestamp
from ridelake.operators.dedup import dedup

# Statuses that pass refinement.
DRIVER_STATUSES = ("active", "inactive")
RIDE_STATUSES = ("completed",)
WIDE_RIDE_STATUSES = ("completed", "cancelled")
PAID = "completed"


def positive(df: DataFrame, name: str) -> Column:
    """`name` > 0 and, for floating point, not NaN."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.FractionalType):
        return (c > 0) & ~F.isnan(c)
    return c > 0


def _timed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: as_timestamp(df, n) for n in names})


def refine_driver(df: DataFrame, statuses: Sequence[str] = DRIVER_STATUSES) -> DataFrame:
    kept = df.filter(F.col("status").isin(*statuses))
    return dedup(
        _timed(kept, "signup_timestamp").withColumn("rating", F.round("rating", 2)),
        ["driver_id"],
    )


def refine_passenger(df: DataFrame) -> DataFrame:
    kept = df.filter(F.col("email").isNotNull())
    return dedup(_timed(kept, "signup_timestamp"), ["passenger_id"])


def refine_vehicle(df: DataFrame) -> DataFrame:
    return dedup(df.filter(F.col("driver_id").isNotNull()), ["vehicle_id"])


def refine_payment(df: DataFrame) -> DataFrame:
    kept = df.filter((F.col("payment_status") == PAID) & positive(df, "amount"))
    return dedup(_timed(kept, "payment_timestamp"), ["payment_id"])


def refine_ride(df: DataFrame, statuses: Sequence[str] = RIDE_STATUSES) -> DataFrame:
    """`statuses=WIDE_RIDE_STATUSES` is the wider notebook filter."""
    kept = df.filter(
        F.col("ride_status").isin(*statuses)
        & positive(df, "fare_amount")
        & positive(df, "distance_km")
    )
    return dedup(
        _timed(kept, "request_timestamp", "pickup_timestamp", "dropoff_timestamp"), ["ride_id"]
    )


REFINE = {
    "driver": refine_driver,
    "passenger": refine_passenger,
    "vehicle": refine_vehicle,
    "payment": refine_payment,
    "ride": refine_ride,
}
