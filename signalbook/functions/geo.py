"""Great-circle distance and travel speed as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Degrees of arc -> nautical miles -> statute miles -> kilometres,
# and the speed at which a journey counts as impossible (0.25 km/s = 900 km/h).
MINUTES_PER_DEGREE = 60.0
STATUTE_PER_NAUTICAL = 1.1515
KM_PER_MILE = 1.609344
SPEED_LIMIT = 0.25


def to_radians(deg: Column) -> Column:
    return deg * F.pi() / F.lit(180.0)


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres by the spherical law of cosines.

    Rounding can push the cosine of equal points past 1, whose arc cosine is
    NaN, so it is clamped (not by ``least``, which would skip a null).
    """
    a, b = to_radians(lat1), to_radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(to_radians(lon1 - lon2))
    clamped = F.when(cosine > 1, F.lit(1.0)).when(cosine < -1, F.lit(-1.0)).otherwise(cosine)
    degrees = F.acos(clamped) * F.lit(180.0) / F.pi()
    return degrees * MINUTES_PER_DEGREE * STATUTE_PER_NAUTICAL * KM_PER_MILE


def truncate2(x: Column) -> Column:
    """Cut a non-negative double to two decimals of its printed form.

    The cast to decimal goes through the shortest text of the double, so 1.13
    stays 1.13; ``floor(x * 100) / 100`` would give 1.12.
    """
    return F.floor(x.cast("decimal(38,20)"), F.lit(2)).cast("double")


def too_fast(km: Column, secs: Column, limit: float = SPEED_LIMIT) -> Column:
    """True where the journey is impossible; no time at all is impossible
    unless the place is the same."""
    return F.when(secs == 0, km > 0).otherwise(F.try_divide(km, secs) >= F.lit(limit))
