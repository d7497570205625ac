"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean Earth radius in km used by the travel feature.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance; NULL when a coordinate is NULL.

    Rounding can push the haversine a hair above 1 for antipodal points, which
    would make ``asin`` return NaN, so it is clamped.
    """
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = (F.pow(F.sin(half_dlat), F.lit(2))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), F.lit(2)))
    clamped = F.when(h > 1.0, F.lit(1.0)).otherwise(h)
    return F.lit(2 * radius) * F.asin(F.sqrt(clamped))


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` moved into [low, high]; NULL stays NULL."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)
