"""Distances on the sphere."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    chord = F.pow(F.sin(half_lat), 2) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lng), 2)
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))
