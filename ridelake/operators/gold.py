"""Gold aggregates.

Totals are exact sums (see `functions.numbers`), so they do not depend on row order;
they are rounded once, after the sum, in the daily metrics and not at all elsewhere.
Each aggregate is one partial and final hash aggregation: a hot group costs one row per
map task in the shuffle. Dimension joins come after the aggregation, where the keys are
unique; a join on one column of a two-column key shuffles the aggregated rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions import (
    as_date,
    exact_mean,
    exact_total,
    or_default,
    strip,
)
from ridelake.functions.numbers import partial_sums, rounded_mean_of, total_of

COMPLETED = "completed"


def ride_daily_metrics(
    rides: DataFrame,
    time: str = "request_timestamp",
    city: str = "pickup_city",
) -> DataFrame:
    """Per day and pickup city: ride counts, and totals and means of completed rides.

    Rides without a readable time are left out. Every ride that is not completed
    counts as cancelled, a no-show too. A completed ride with an unreadable fare
    adds to no measure, one with an unreadable distance to the fare only, and one
    with an unreadable duration to fare and distance only.
    """
    rows = ride_daily_rows(rides, time, city)
    sums = rows.groupBy("date", "city").agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.count_if("done").alias("completed_rides"),
        *ride_daily_columns({m: partial_sums(F.col(m)) for m in RIDE_MEASURES}),
    )
    return with_cancelled(sums)


#: Measures of `ride_daily_rows`.
RIDE_MEASURES = ("fare", "km", "minutes")


def ride_daily_rows(rides: DataFrame, time: str = "request_timestamp", city: str = "pickup_city") -> DataFrame:
    """(date, city, done, fare, km, minutes) of the rides that daily metrics count."""
    done = F.col("ride_status").eqNullSafe(COMPLETED)
    fare, km, minutes = (F.col(c) for c in ("fare_amount", "distance_km", "duration_minutes"))
    with_fare = done & F.col("fare_amount").isNotNull()
    with_km = with_fare & F.col("distance_km").isNotNull()
    with_minutes = with_km & F.col("duration_minutes").isNotNull()
    return rides.select(
        as_date(rides, time).alias("date"),
        strip(or_default(F.col(city), "Unknown")).alias("city"),
        done.alias("done"),
        F.when(with_fare, fare).alias("fare"),
        F.when(with_km, km).alias("km"),
        F.when(with_minutes, minutes).alias("minutes"),
    ).filter(F.col("date").isNotNull())


def ride_daily_columns(parts: dict[str, dict[str, Column]]) -> list[Column]:
    """Totals and means of the daily metrics, of what was added of each measure."""
    return [
        F.coalesce(total_of(parts["km"], 2), F.lit(0.0)).alias("total_distance_km"),
        F.coalesce(total_of(parts["fare"], 2), F.lit(0.0)).alias("total_revenue"),
        rounded_mean_of(parts["fare"], 2).alias("avg_fare"),
        rounded_mean_of(parts["km"], 2).alias("avg_distance_km"),
        rounded_mean_of(parts["minutes"], 2).alias("avg_duration_minutes"),
    ]


def with_cancelled(sums: DataFrame) -> DataFrame:
    cancelled = (F.col("total_rides") - F.col("completed_rides")).alias("cancelled_rides")
    return sums.select(*sums.columns[:4], cancelled, *sums.columns[4:])


def city_metrics(rides: DataFrame, **names) -> DataFrame:
    """The city columns of `ride_daily_metrics`; the unused ones are pruned."""
    return ride_daily_metrics(rides, **names).select(
        "date",
        "city",
        "total_rides",
        "completed_rides",
        "total_revenue",
        "avg_fare",
        "avg_distance_km",
    )


def rating_lookup(
    drivers: DataFrame, key: str = "driver_id", value: str = "rating", order: Sequence[str] = ()
) -> DataFrame:
    """One rating per driver: the last by `order`, the greatest among equals."""
    rank = F.struct(*order, value)
    return drivers.groupBy(key).agg(F.max(rank).alias("last")).select(
        key, F.col("last")[value].alias(value)
    )


def driver_daily_metrics(
    rides: DataFrame,
    drivers: DataFrame,
    time: str = "request_timestamp",
    order: Sequence[str] = (),
) -> DataFrame:
    """Per day and driver with a completed ride: count, totals and the rating.

    A ride with an unreadable distance counts but adds to no total, one with an
    unreadable fare adds its distance. Drivers without a rating get 0.
    """
    sums = driver_daily_rows(rides, time).groupBy("date", "driver_id").agg(
        F.count(F.lit(1)).alias("completed_rides"),
        *driver_daily_columns({m: partial_sums(F.col(m)) for m in DRIVER_MEASURES}),
    )
    return with_rating(sums, drivers, order)


#: Measures of `driver_daily_rows`.
DRIVER_MEASURES = ("km", "fare")


def driver_daily_rows(rides: DataFrame, time: str = "request_timestamp") -> DataFrame:
    """(date, driver_id, km, fare) of the completed rides."""
    return (
        rides.filter(F.col("ride_status") == COMPLETED)
        .select(
            as_date(rides, time).alias("date"),
            "driver_id",
            F.col("distance_km").alias("km"),
            F.when(F.col("distance_km").isNotNull(), F.col("fare_amount")).alias("fare"),
        )
        .filter(F.col("date").isNotNull())
    )


def driver_daily_columns(parts: dict[str, dict[str, Column]]) -> list[Column]:
    return [
        F.coalesce(total_of(parts["km"], 2), F.lit(0.0)).alias("total_distance_km"),
        F.coalesce(total_of(parts["fare"], 2), F.lit(0.0)).alias("total_revenue"),
    ]


def with_rating(sums: DataFrame, drivers: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Daily sums of drivers with the rating of each."""
    ratings = rating_lookup(drivers, order=order)
    return sums.join(ratings, "driver_id", "left").select(
        "date",
        "driver_id",
        "completed_rides",
        "total_distance_km",
        "total_revenue",
        F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("avg_rating"),
    )


def daily_rides(rides: DataFrame, time: str = "request_timestamp") -> DataFrame:
    """Per day: ride count and mean fare."""
    return rides.groupBy(as_date(rides, time).alias("request_date")).agg(
        F.count("ride_id").alias("total_rides"),
        exact_mean(F.col("fare_amount")).alias("avg_fare"),
    )


def daily_city_rides(
    rides: DataFrame,
    time: str = "request_timestamp",
    city: str = "pickup_city",
) -> DataFrame:
    """Per day and city: ride count, completed rides, mean fare, total distance."""
    return rides.groupBy(as_date(rides, time).alias("request_date"), city).agg(
        F.count("ride_id").alias("total_rides"),
        F.count_if(F.col("ride_status") == COMPLETED).alias("completed_rides"),
        exact_mean(F.col("fare_amount")).alias("avg_fare"),
        exact_total(F.col("distance_km")).alias("total_distance_km"),
    )


def driver_performance(rides: DataFrame, drivers: DataFrame | None = None) -> DataFrame:
    """Per driver: completed rides, revenue and mean fare; with `drivers`, the rating.

    `drivers` is expected to hold each driver once, as silver does.
    """
    out = (
        rides.filter(F.col("ride_status") == COMPLETED)
        .groupBy("driver_id")
        .agg(
            F.count("ride_id").alias("completed_rides"),
            exact_total(F.col("fare_amount")).alias("total_revenue"),
            exact_mean(F.col("fare_amount")).alias("avg_fare"),
        )
    )
    if drivers is None:
        return out
    return out.join(drivers.select("driver_id", "rating"), "driver_id", "left")


def passenger_activity(rides: DataFrame, passengers: DataFrame | None = None) -> DataFrame:
    """Per passenger: rides, spend and mean fare; with `passengers`, city and status."""
    out = rides.groupBy("passenger_id").agg(
        F.count("ride_id").alias("total_rides"),
        exact_total(F.col("fare_amount")).alias("total_spent"),
        exact_mean(F.col("fare_amount")).alias("avg_fare"),
    )
    if passengers is None:
        return out
    return out.join(passengers.select("passenger_id", "city", "status"), "passenger_id", "left")


def rides_by_city(daily: DataFrame) -> DataFrame:
    """Rides per city, from daily (date, city) metrics."""
    return daily.groupBy("city").agg(F.sum("total_rides").alias("rides"))


def rows_by_city(daily: DataFrame) -> DataFrame:
    """Number of daily rows per city, under the same column name `rides`."""
    return daily.groupBy("city").agg(F.count(F.lit(1)).alias("rides"))


def entity_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows (entity, record_count), sorted; an empty entity has no row."""
    names = [df.select(F.lit(e).alias("entity")) for e, df in frames.items()]
    every = names[0]
    for n in names[1:]:
        every = every.unionByName(n)
    return every.groupBy("entity").agg(F.count(F.lit(1)).alias("record_count")).orderBy("entity")


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(f"distinct_{column}"))
