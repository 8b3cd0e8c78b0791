"""Silver by normalisation: every row is kept, its text tidied, its numbers clamped.

Input is bronze-shaped, or raw text records. A NULL in a numeric column means
that the text could not be read, and it stays NULL; in a text column it means
that the value is missing, and the default applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import as_date, clamp, or_default, strip, tidy
from ridelake.operators.bronze import field, number
from ridelake.operators.validate import Rule, all_pass, check_map, judge


def _key(df: DataFrame, name: str) -> Column:
    c = field(df, name)
    if name in df.columns and not isinstance(df.schema[name].dataType, T.StringType):
        return c.alias(name)
    return F.coalesce(c, F.lit("")).alias(name)


def _tidy(df: DataFrame, *names: str) -> list[Column]:
    return [tidy(field(df, n)).alias(n) for n in names]


def _lower(df: DataFrame, name: str) -> Column:
    return strip(F.lower(F.coalesce(field(df, name), F.lit("")))).alias(name)


def _measure(df: DataFrame, name: str, kind: str, default, low, high=None) -> Column:
    if name in df.columns and isinstance(df.schema[name].dataType, T.NumericType):
        value = F.col(name).cast(kind)
    else:
        value = number(df, name, kind, default)
    return clamp(value, low, high).alias(name)


def _day(df: DataFrame, name: str) -> Column:
    return as_date(df, name) if name in df.columns else F.lit(None).cast("date")


def normalise_passenger(df: DataFrame) -> DataFrame:
    return df.select(
        _key(df, "passenger_id"),
        *_tidy(df, "first_name", "last_name"),
        _lower(df, "email"),
        *_tidy(df, "phone"),
        _day(df, "signup_timestamp").alias("signup_date"),
        *_tidy(df, "city", "country"),
        _lower(df, "status"),
    )


def normalise_driver(df: DataFrame) -> DataFrame:
    return df.select(
        _key(df, "driver_id"),
        *_tidy(df, "first_name", "last_name"),
        _day(df, "signup_timestamp").alias("signup_date"),
        _measure(df, "rating", "double", 0, 0.0, 5.0),
        *_tidy(df, "city", "country"),
        _lower(df, "status"),
    )


def normalise_vehicle(df: DataFrame) -> DataFrame:
    return df.select(
        _key(df, "vehicle_id"),
        _key(df, "driver_id"),
        *_tidy(df, "make", "model"),
        _measure(df, "year", "int", 2000, 1900, 2050),
        _lower(df, "vehicle_type"),
        strip(F.upper(F.coalesce(field(df, "license_plate"), F.lit("")))).alias("license_plate"),
    )


def _place(df: DataFrame, end: str) -> Column:
    return F.struct(
        number(df, f"{end}_latitude", "double", 0).alias("latitude"),
        number(df, f"{end}_longitude", "double", 0).alias("longitude"),
        tidy(field(df, f"{end}_city")).alias("city"),
    ).alias(f"{end}_location")


def _currency(df: DataFrame) -> Column:
    # Upper-cased but not stripped.
    return F.upper(or_default(field(df, "currency"), "USD")).alias("currency")


def normalise_ride(df: DataFrame, checks: bool = False) -> DataFrame:
    """Rides with structured places. `checks` adds the rule outcome columns."""
    df, rules = judge(df, "ride") if checks else (df, [])
    return df.select(
        *(_key(df, n) for n in ("ride_id", "passenger_id", "driver_id", "vehicle_id")),
        _day(df, "request_timestamp").alias("request_date"),
        *(_key(df, f"{n}_timestamp").alias(f"{n}_time") for n in ("request", "pickup", "dropoff")),
        _place(df, "pickup"),
        _place(df, "dropoff"),
        _measure(df, "distance_km", "double", 0, 0.0),
        _measure(df, "duration_minutes", "int", 0, 0),
        _measure(df, "fare_amount", "double", 0, 0.0),
        _currency(df),
        F.lower(F.coalesce(field(df, "ride_status"), F.lit(""))).alias("ride_status"),
        *_outcome(rules, with_map=True),
    )


def normalise_payment(df: DataFrame, checks: bool = False) -> DataFrame:
    df, rules = judge(df, "payment") if checks else (df, [])
    return df.select(
        _key(df, "payment_id"),
        _key(df, "ride_id"),
        _day(df, "payment_timestamp").alias("payment_date"),
        _key(df, "payment_timestamp").alias("payment_time"),
        _lower(df, "payment_method"),
        _measure(df, "amount", "double", 0, 0.0),
        _currency(df),
        _lower(df, "payment_status"),
        *_outcome(rules, with_map=False),
    )


def _outcome(rules: list[Rule], with_map: bool) -> list[Column]:
    """valid_record and, for rides, one entry per rule; judged on the input row."""
    if not rules:
        return []
    out = [all_pass(rules).alias("valid_record")]
    if with_map:
        out.append(check_map(rules).alias("data_quality_checks"))
    return out


NORMALISE = {
    "passenger": normalise_passenger,
    "driver": normalise_driver,
    "vehicle": normalise_vehicle,
    "ride": normalise_ride,
    "payment": normalise_payment,
}
