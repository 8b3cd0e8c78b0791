"""Great-circle distance and the fare formula."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in km; base fare, price per km and per minute.
EARTH_RADIUS_KM = 6371.0
BASE_FARE = 2.50
PER_KM = 1.25
PER_MINUTE = 0.25


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1))
        * F.cos(F.radians(lat2))
        * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    # Rounding may push the sum past 1 for antipodes; sqrt would give NaN.
    h = F.least(half_chord, F.lit(1.0))
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def ride_fare(distance_km: Column, minutes: Column) -> Column:
    """Fare of a ride, rounded to two decimals."""
    return F.round(BASE_FARE + PER_KM * distance_km + PER_MINUTE * minutes, 2)
