"""Points in texts."""

from pyspark.sql import Column, functions as F

NUMBER = r"([-+]?\d{1,3}\.\d+)\s*°?\s*([NSEWnsew](?![a-z]))?"
DMS = r"(-?\d{1,3})\s*[°º]\s*(\d{1,2})\s*['′]\s*(?:(\d{1,2}(?:\.\d+)?)\s*[\"″])?"


def decimal_point(text: Column) -> Column:
    """(lat, lon) of a text with two decimal numbers: hemisphere letters sign them, POINT( is longitude first; null out of range."""
    numbers = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(1))
    letters = F.regexp_extract_all(text, F.lit(NUMBER), F.lit(2))
    signed = F.zip_with(numbers, letters, lambda n, h: F.when(F.upper(h).isin("S", "W"), -F.abs(n.cast("double"))).otherwise(n.cast("double")))
    swapped = F.upper(text).startswith("POINT") | F.upper(F.get(letters, 0)).isin("E", "W")
    lat = F.when(swapped, F.get(signed, 1)).otherwise(F.get(signed, 0))
    lon = F.when(swapped, F.get(signed, 0)).otherwise(F.get(signed, 1))
    fine = (F.size(signed) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(fine, F.struct(lat.alias("lat"), lon.alias("lon")))


def single_coordinate(text: Column) -> Column:
    """One coordinate in degrees: decimal, or degrees, minutes and seconds; southern and western ones are negative."""
    degrees, minutes, seconds = (F.nullif(F.regexp_extract(text, DMS, k), F.lit("")).cast("double") for k in (1, 2, 3))
    parts = F.abs(degrees) + minutes / 60 + F.coalesce(seconds, F.lit(0.0)) / 3600
    parts = F.when((minutes < 60) & (F.coalesce(seconds, F.lit(0.0)) < 60), F.when(F.trim(text).startswith("-"), -parts).otherwise(parts))
    value = F.when(degrees.isNotNull(), parts).otherwise(F.nullif(F.regexp_extract(text, r"([-+]?\d*\.?\d+)", 1), F.lit("")).cast("double"))
    return F.when(F.lower(text).rlike(r"\b(s|south|w|west)\b"), -F.abs(value)).otherwise(value)
