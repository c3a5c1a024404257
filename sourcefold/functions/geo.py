"""Points on the globe."""

from pyspark.sql import Column, functions as F

RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def in_range(latitude: Column, longitude: Column) -> Column:
    return F.coalesce(latitude.between(-90, 90) & longitude.between(-180, 180), F.lit(False))


def coord_key(latitude: Column, longitude: Column, digits: int = 4) -> Column:
    return F.when(in_range(latitude, longitude), F.concat(F.format_string(f"%.{digits}f", latitude), F.lit(","), F.format_string(f"%.{digits}f", longitude)))
