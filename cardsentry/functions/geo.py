"""Great-circle geometry as Spark column expressions (JVM side, codegen'd).

All functions take and return ``Column``s; plain numbers are wrapped with
``lit``.  Degrees in, kilometres / degrees out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (EARTH_RADIUS_KM, MAX_AIRPLANE_VELOCITY_KMH, MAX_CAR_VELOCITY_KMH,
                      MIN_AIRPLANE_DISTANCE_KM)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance, R = 6371 km, ``2·atan2(√a, √(1−a))``.

    ``a`` is clamped to 1: for (near-)antipodal points rounding gives
    1.0000000000000002 and the unclamped formula returns NaN.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    a = F.least(a, F.lit(1.0))
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def initial_bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial great-circle bearing from point 1 to point 2, degrees in [0, 360)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lon2 - lon1)
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + F.lit(360.0), F.lit(360.0))


def destination_point(lat, lon, bearing_deg, distance_km) -> Column:
    """Point reached from (lat, lon) after ``distance_km`` on ``bearing_deg``.

    Returns ``struct(latitude, longitude)``; longitude is not wrapped into
    [-180, 180] (the transaction generator doesn't wrap it either).
    """
    lat, lon, bearing_deg, distance_km = map(_c, (lat, lon, bearing_deg, distance_km))
    d = distance_km / F.lit(EARTH_RADIUS_KM)
    b = F.radians(bearing_deg)
    p = F.radians(lat)
    lam = F.radians(lon)
    p2 = F.asin(F.sin(p) * F.cos(d) + F.cos(p) * F.sin(d) * F.cos(b))
    lam2 = lam + F.atan2(F.sin(b) * F.sin(d) * F.cos(p), F.cos(d) - F.sin(p) * F.sin(p2))
    return F.struct(F.degrees(p2).alias("latitude"), F.degrees(lam2).alias("longitude"))


def velocity_kmh(distance_km, hours) -> Column:
    """``distance / hours`` with IEEE semantics instead of ANSI errors:
    x/0 = +Infinity for x > 0 and 0/0 = NaN."""
    distance_km, hours = _c(distance_km), _c(hours)
    return (F.when(hours != 0, distance_km / hours)
            .when(distance_km > 0, F.lit(math.inf))
            .when(distance_km < 0, F.lit(-math.inf))
            .otherwise(F.lit(math.nan)))


def too_fast(distance_km, velocity) -> Column:
    """Two-regime rule: under 300 km the limit is a car's 150 km/h, from
    300 km on an airplane's 900 km/h.  NaN velocity is never too fast
    (Spark orders NaN above every number, so it is excluded explicitly)."""
    distance_km, velocity = _c(distance_km), _c(velocity)
    limit = F.when(distance_km < MIN_AIRPLANE_DISTANCE_KM, F.lit(MAX_CAR_VELOCITY_KMH)) \
        .otherwise(F.lit(MAX_AIRPLANE_VELOCITY_KMH))
    return ~F.isnan(velocity) & ~F.isnan(distance_km) & (velocity > limit)
