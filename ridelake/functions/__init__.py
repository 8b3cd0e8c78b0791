"""Column -> Column functions; everything here stays on the JVM side."""

from ridelake.functions.geo import haversine_km, ride_fare
from ridelake.functions.numbers import (
    clamp,
    exact_mean,
    exact_total,
    measure,
    parse_double,
    parse_int,
    rounded_mean,
)
from ridelake.functions.text import (
    is_email,
    is_phone,
    is_present,
    or_default,
    strip,
    tidy,
)
from ridelake.functions.timestamps import (
    as_date,
    as_timestamp,
    between_dates,
    has_zone,
    iso_timestamp,
)

__all__ = [
    "as_date",
    "as_timestamp",
    "between_dates",
    "clamp",
    "exact_mean",
    "exact_total",
    "has_zone",
    "haversine_km",
    "is_email",
    "is_phone",
    "is_present",
    "iso_timestamp",
    "measure",
    "or_default",
    "parse_double",
    "parse_int",
    "ride_fare",
    "rounded_mean",
    "strip",
    "tidy",
]
