"""Coordinates and speeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from omnibus import params


def in_box(lat: Column, lon: Column, lat_range=params.BOX_LAT, lon_range=params.BOX_LON) -> Column:
    """True inside the city box; NULL coordinates are not inside."""
    return lat.between(*lat_range) & lon.between(*lon_range)


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = params.EARTH_RADIUS_KM) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * F.lit(2.0 * radius_km)


def speed_kmh(distance_km: Column, seconds: Column) -> Column:
    """NULL when no time has passed."""
    return F.when(seconds > 0, distance_km * 3600.0 / seconds)


def clamp_speed(speed: Column, limit: float = params.MAX_SPEED_KMH) -> Column:
    """Impossible speeds become NULL; the row itself stays."""
    return F.when(speed <= limit, speed)
