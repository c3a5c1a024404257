"""Answers of address services as points with a precision: rooftop, street, major road, or "" for what isn't used."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null

ROOFTOP, STREET, MAJOR = "rooftop", "street", "major road"
# The fields of two services' answers, and the words in them that decide.
GEOMETRY = "struct<coordinates: array<double>>"
FEATURE = f"struct<geometry: {GEOMETRY}, properties: struct<type: string, confidence: string, matchCodes: array<string>, geocodePoints: array<struct<geometry: {GEOMETRY}, calculationMethod: string, usageTypes: array<string>>>>>"
PARTS = "municipality city town village county state province region state_district".split()
RESULT = f"struct<lat: string, lon: string, category: string, class: string, type: string, osm_type: string, place_rank: string, address: struct<{', '.join(f'{p}: string' for p in PARTS)}>>"
EXACT = ["Rooftop", "Parcel"]
ON_STREET = ["Address", "RoadBlock", "RoadIntersection"]
BROADENED = ["UpHierarchy", "Ambiguous"]
MAJOR_ROADS = ["motorway", "trunk", "primary", "secondary"]


def _or(value: Column, other: str) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(other))


def feature_answer(answer: Column) -> Column:
    """(lat, lon, precision, described) of a feature in JSON; null without a point or if it can't be read.

    The point for display counts, else the first, else the feature's own. Address points on a roof or parcel are rooftop;
    other addresses, blocks and crossings street. Low confidence, several candidates and broadened matches aren't used.
    """
    read = F.from_json(answer, FEATURE)
    props = read["properties"]
    points = F.coalesce(props["geocodePoints"], F.array().cast(f"array<struct<geometry: {GEOMETRY}, calculationMethod: string, usageTypes: array<string>>>"))
    point = F.coalesce(F.get(F.filter(points, lambda p: F.coalesce(F.array_contains(p["usageTypes"], "Display"), F.lit(False))), 0), F.get(points, 0))
    place = F.coalesce(point["geometry"]["coordinates"], read["geometry"]["coordinates"])
    codes = F.coalesce(props["matchCodes"], F.array().cast("array<string>"))
    told = F.concat_ws(", ", _or(props["type"], "?"), _or(point["calculationMethod"], "no method"), _or(props["confidence"], "no confidence"), F.when(F.size(codes) > 0, F.array_join(codes, "/")).otherwise("no match code"))
    usable = (_or(props["confidence"], "") != "Low") & ~F.arrays_overlap(codes, F.array(*map(F.lit, BROADENED)))
    kind = _or(props["type"], "")
    precision = F.when(usable & (kind == "Address") & _or(point["calculationMethod"], "").isin(EXACT), ROOFTOP).when(usable & kind.isin(ON_STREET), STREET).otherwise("")
    both = F.get(place, 0).isNotNull() & F.get(place, 1).isNotNull()
    return F.when(both, F.struct(F.get(place, 1).alias("lat"), F.get(place, 0).alias("lon"), precision.alias("precision"), told.alias("described")))


def place_fields(address: Column) -> Column:
    """(municipality, admin1, admin2) of an answer's address parts: the smallest local government, the state or its like; null without either."""
    first = lambda names: F.coalesce(*[blank_to_null(address[n]) for n in names], F.lit(""))
    town, state = first(PARTS[:5]), first(PARTS[5:8])
    return F.when((town != "") | (state != ""), F.struct(town.alias("municipality"), state.alias("admin1"), first(PARTS[8:]).alias("admin2")))


def result_answer(answer: Column) -> Column:
    """(lat, lon, precision, described, state, place) of a map's search result in JSON; null without a point.

    Buildings and houses are rooftop, houses on a line along a street street, as are roads but the major ones. Towns,
    postcodes and mapped features aren't used.
    """
    read = F.from_json(answer, RESULT)
    number = lambda x: F.regexp_replace(F.trim(x), ",", "").try_cast("double")
    group, kind, drawn = F.coalesce(blank_to_null(read["category"]), _or(read["class"], "")), _or(read["type"], ""), F.lower(_or(read["osm_type"], ""))
    road = F.when(F.regexp_replace(kind, "_link$", "").isin(MAJOR_ROADS), MAJOR).otherwise(STREET)
    house = F.when(drawn.isin("way", "w"), STREET).otherwise(ROOFTOP)
    precision = F.when(group == "building", ROOFTOP).when((group == "place") & kind.isin("house", "building"), house).when(group == "highway", road).otherwise("")
    told = F.concat(_or(group, "?"), F.lit("="), _or(kind, "?"), F.when(drawn != "", F.concat(F.lit(" on "), drawn)).otherwise(""), F.lit(", rank "), _or(read["place_rank"], "?"))
    place = place_fields(read["address"])
    lat, lon = number(read["lat"]), number(read["lon"])
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"), precision.alias("precision"), told.alias("described"), F.coalesce(place["admin1"], F.lit("")).alias("state"), place.alias("place")))
