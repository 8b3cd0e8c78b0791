"""Bronze projections: one output row per raw record, numbers made numeric.

A missing number becomes 0. Text that is not a number becomes NULL, never 0, so
that validation reports the row. `keep` names columns that go along as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import parse_double, parse_int


def field(df: DataFrame, name: str, kind: str = "string") -> Column:
    """Column `name`, or a typed NULL where the records never carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def number(df: DataFrame, name: str, kind: str, default) -> Column:
    """Column `name` as `kind`; missing gives `default`, unreadable gives NULL."""
    c = field(df, name)
    text = name not in df.columns or isinstance(df.schema[name].dataType, T.StringType)
    if kind == "int":
        value = parse_int(c)
    else:
        value = parse_double(c) if text else c.cast("double")
    return F.when(c.isNull(), F.lit(default).cast(kind)).otherwise(value).alias(name)


def _project(df: DataFrame, names: str, numbers: dict[str, str], keep: Sequence[str]) -> DataFrame:
    return df.select(
        *keep,
        *(
            number(df, n, numbers[n], 0) if n in numbers else field(df, n).alias(n)
            for n in names.split()
        )
    )


def bronze_passenger(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _project(
        df,
        "passenger_id first_name last_name email phone signup_timestamp city country status",
        {},
        keep,
    )


def bronze_driver(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _project(
        df,
        "driver_id first_name last_name signup_timestamp rating city country status",
        {"rating": "double"},
        keep,
    )


def bronze_vehicle(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _project(
        df,
        "vehicle_id driver_id make model year vehicle_type license_plate",
        {"year": "int"},
        keep,
    )


def bronze_ride(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _project(
        df,
        "ride_id passenger_id driver_id vehicle_id "
        "request_timestamp pickup_timestamp dropoff_timestamp "
        "pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude "
        "pickup_city dropoff_city distance_km duration_minutes fare_amount "
        "currency ride_status",
        {
            "pickup_latitude": "double",
            "pickup_longitude": "double",
            "dropoff_latitude": "double",
            "dropoff_longitude": "double",
            "distance_km": "double",
            "duration_minutes": "int",
            "fare_amount": "double",
        },
        keep,
    )


def bronze_payment(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _project(
        df,
        "payment_id ride_id payment_timestamp payment_method amount currency payment_status",
        {"amount": "double"},
        keep,
    )


BRONZE = {
    "passenger": bronze_passenger,
    "driver": bronze_driver,
    "vehicle": bronze_vehicle,
    "ride": bronze_ride,
    "payment": bronze_payment,
}
