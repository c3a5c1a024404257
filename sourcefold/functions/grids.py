"""Grid references of Great Britain and Ireland as WGS84 points, in column expressions."""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .coordinates import LABELS


@dataclasses.dataclass(frozen=True)
class Grid:
    """A transverse Mercator grid: ellipsoid, scale, true origin in degrees and metres, and seven parameters (m, arc seconds, ppm) to WGS84."""

    major: float
    minor: float
    scale: float
    latitude: float
    longitude: float
    easting: float
    northing: float
    shift: tuple[float, float, float] = (0.0, 0.0, 0.0)
    turn: tuple[float, float, float] = (0.0, 0.0, 0.0)
    stretch: float = 0.0


# The published parameters of the three grids and of WGS84.
BRITISH = Grid(6377563.396, 6356256.909, 0.9996012717, 49.0, -2.0, 400000.0, -100000.0, (446.448, -125.157, 542.06), (0.15, 0.247, 0.842), -20.489)
IRISH = Grid(6377340.189, 6356034.447938534, 1.000035, 53.5, -8.0, 200000.0, 250000.0, (482.5, -130.6, 564.6), (-1.042, -0.214, -0.631), 8.15)
ITM = Grid(6378137.0, 6356752.314140356, 0.99982, 53.5, -8.0, 600000.0, 750000.0)
WGS84 = (6378137.0, 6356752.314245179)

# Digits of each side from which a reference is a location (100 m), and how references and labelled metres are written.
FINE_DIGITS = 3
REFERENCE = r"(?<![A-Za-z])([A-HJ-Z]{1,2}) ?(\d{2,10})(?: (\d{1,5}))?(?![\w.])"
EAST = r"(?<![A-Za-z])(?:(?i:eastings?)|[EX]) ?[:=]? ?(\d{5,7}(?:\.\d+)?)(?![\d.])"
NORTH = r"(?<![A-Za-z])(?:(?i:northings?)|[NY]) ?[:=]? ?(\d{5,7}(?:\.\d+)?)(?![\d.])"
SIX_DIGITS = r"(?<![\d.])(\d{6}(?:\.\d+)?)(?!\d)"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value written and worked out once however often use names it."""
    return F.get(F.transform(F.array(value), use), 0)


def to_wgs84(easting: Column, northing: Column, grid: Grid) -> Column:
    """(lat, lon) of metres in a grid: Krueger's series to the third order, then the seven parameters at height 0."""
    n = (grid.major - grid.minor) / (grid.major + grid.minor)
    radius = grid.scale * grid.major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    backward = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    geodetic = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    e2 = 1 - (grid.minor / grid.major) ** 2
    e, sine = math.sqrt(e2), math.sin(math.radians(grid.latitude))
    conformal = math.asin(math.tanh(math.atanh(sine) - e * math.atanh(e * sine)))
    origin = conformal + sum(x * math.sin(2 * k * conformal) for k, x in enumerate(forward, 1))

    def conformal_point(p: Column) -> Column:
        xi, eta = p["xi"], p["eta"]
        return F.struct(
            (xi - sum(x * F.sin(2 * k * xi) * F.cosh(2 * k * eta) for k, x in enumerate(backward, 1))).alias("xi"),
            (eta - sum(x * F.cos(2 * k * xi) * F.sinh(2 * k * eta) for k, x in enumerate(backward, 1))).alias("eta"),
        )

    def angles(p: Column) -> Column:
        return F.struct(F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])).alias("chi"), (F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])) + math.radians(grid.longitude)).alias("lam"))

    def geographic(p: Column) -> Column:
        return F.struct((p["chi"] + sum(x * F.sin(2 * k * p["chi"]) for k, x in enumerate(geodetic, 1))).alias("phi"), p["lam"].alias("lam"))

    plane = F.struct(((northing - grid.northing) / radius + origin).alias("xi"), ((easting - grid.easting) / radius).alias("eta"))
    own = _bound(_bound(_bound(plane, conformal_point), angles), geographic)
    if grid.stretch == 0.0 and not any(grid.shift) and not any(grid.turn):
        return _bound(own, lambda p: F.struct(F.degrees(p["phi"]).alias("lat"), F.degrees(p["lam"]).alias("lon")))

    rx, ry, rz = (math.radians(t / 3600) for t in grid.turn)
    more = 1 + grid.stretch * 1e-6
    major, minor = WGS84

    def in_space(p: Column) -> Column:
        normal = grid.major / F.sqrt(1 - e2 * F.pow(F.sin(p["phi"]), 2))
        return F.struct((normal * F.cos(p["phi"]) * F.cos(p["lam"])).alias("x"), (normal * F.cos(p["phi"]) * F.sin(p["lam"])).alias("y"), (normal * (1 - e2) * F.sin(p["phi"])).alias("z"))

    def shifted(p: Column) -> Column:
        return F.struct(
            (grid.shift[0] + more * p["x"] - rz * p["y"] + ry * p["z"]).alias("x"),
            (grid.shift[1] + rz * p["x"] + more * p["y"] - rx * p["z"]).alias("y"),
            (grid.shift[2] - ry * p["x"] + rx * p["y"] + more * p["z"]).alias("z"),
        )

    def on_globe(p: Column) -> Column:
        flat = F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])
        theta = F.atan2(p["z"] * major, flat * minor)
        lat = F.atan2(p["z"] + (major**2 / minor**2 - 1) * minor * F.pow(F.sin(theta), 3), flat - (1 - minor**2 / major**2) * major * F.pow(F.cos(theta), 3))
        return F.struct(F.degrees(lat).alias("lat"), F.degrees(F.atan2(p["y"], p["x"])).alias("lon"))

    return _bound(_bound(_bound(own, in_space), shifted), on_globe)


def _letter(said: Column, place: int) -> Column:
    """A is 0; the grids leave I out."""
    code = F.ascii(F.substring(said, place, 1)) - 65
    return F.when(code > 8, code - 1).otherwise(code)


def _metres(east: Column, north: Column, grid: str, digits: Column) -> Column:
    return F.struct(F.lit(grid).alias("grid"), east.cast("double").alias("east"), north.cast("double").alias("north"), digits.cast("int").alias("digits"))


def _square(match: Column, grid: str) -> Column:
    """The middle of the square that letters and digits name; null where there is no such square."""
    letters, first, second = match["letters"], match["first"], match["second"]
    half = (F.length(first) / 2).cast("int")
    east = F.when(second != "", first).otherwise(F.substring(first, F.lit(1), half))
    north = F.when(second != "", second).otherwise(F.substring(first, half + 1, half))
    fits = F.when(second != "", (F.length(first) == F.length(second)) & (F.length(first) <= 5)).otherwise(F.length(first) % 2 == 0)
    one = _letter(letters, 1)
    if grid == "british":
        two = _letter(letters, 2)
        column, row = (one + 3) % 5 * 5 + two % 5, 19 - F.floor(one / 5) * 5 - F.floor(two / 5)
        fits = fits & (F.length(letters) == 2) & column.between(0, 6) & row.between(0, 12)
    else:
        column, row = one % 5, 4 - F.floor(one / 5)
        fits = fits & (F.length(letters) == 1)
    size = F.pow(F.lit(10.0), 5 - F.length(east))
    return F.when(fits, _metres(column * 100000 + east.cast("int") * size + size / 2, row * 100000 + north.cast("int") * size + size / 2, grid, F.length(east)))


def _labelled(said: Column, country: Column) -> Column:
    """Metres with labels, in the grid of the country; Irish and ITM metres never overlap."""
    east, north = (F.nullif(F.regexp_extract(said, p, 1), F.lit("")).cast("double") for p in (EAST, NORTH))
    british = (country == "GBR") & ~said.rlike(r"(?i)\birish\b")
    whole = F.lit(5)
    return (
        F.when(british, F.when(east.between(0, 700000) & north.between(0, 1300000), _metres(east, north, "british", whole)))
        .when(~country.isin("GBR", "IRL"), None)
        .when((east >= 400000) & (north >= 500000), F.when((east <= 900000) & (north <= 1000000), _metres(east, north, "itm", whole)))
        .when((east < 400000) & (north < 500000), _metres(east, north, "irish", whole))
    )


def _itm(said: Column) -> Column:
    """The first two six-digit numbers of a text that says ITM; the northing first where only it is labelled before them."""
    numbers = F.regexp_extract_all(said, F.lit(SIX_DIGITS), F.lit(1))
    before = F.regexp_extract(said, r"^(.*?)(?<![\d.])\d{6}", 1)
    swapped = before.rlike(r"(?i)\bn(orthing)?\b") & ~before.rlike(r"(?i)\be(asting)?\b")
    one, two = F.get(numbers, 0).cast("double"), F.get(numbers, 1).cast("double")
    east, north = F.when(swapped, two).otherwise(one), F.when(swapped, one).otherwise(two)
    fits = said.rlike(r"(?i)\bITM\b|irish transverse mercator") & east.between(300000, 900000) & north.between(400000, 1000000)
    return F.when(fits, _metres(east, north, "itm", F.lit(5)))


def grid_reference(text: Column, country: Column, strict: bool = False) -> Column:
    """(lat, lon, basis, uncertainty_km) of a text's grid reference; null without one, for a null text too.

    Metres of ITM come first, then labelled metres, then references by letters: the first of 100 m or finer, else the
    first. Coarser ones are a hint with half the square's diagonal as uncertainty. Irish letters are read for Ireland,
    the United Kingdom and where the country (ISO 3) isn't known. strict: beside labelled metres or one reference the
    text may hold words that label coordinates, nothing else; metres of ITM say themselves what they are.
    """
    said = F.trim(F.regexp_replace(text, r"\s+", " "))
    where = F.upper(F.trim(F.coalesce(country, F.lit(""))))
    labelled = said.rlike(EAST) & said.rlike(NORTH)
    rest = F.when(labelled, F.regexp_replace(F.regexp_replace(said, EAST, ";"), NORTH, ";")).otherwise(said)
    groups = [F.regexp_extract_all(rest, F.lit(REFERENCE), F.lit(k)) for k in (1, 2, 3)]
    matches = F.arrays_zip(*(g.alias(name) for g, name in zip(groups, ("letters", "first", "second"))))

    def squares(found: Column) -> Column:
        british = F.transform(found, lambda m: _square(m, "british"))
        irish = F.transform(F.when(where.isin("IRL", "GBR", ""), found).otherwise(F.slice(found, 1, 0)), lambda m: _square(m, "irish"))
        return F.filter(F.concat(british, irish), lambda s: s.isNotNull())

    by_letters = _bound(_bound(matches, squares), lambda every: F.coalesce(F.get(F.filter(every, lambda s: s["digits"] >= FINE_DIGITS), 0), F.get(every, 0)))
    if strict:
        left = F.split(F.lower(F.regexp_replace(rest, REFERENCE, " ")), r"[^\p{L}\p{N}]+")
        alone = (F.size(groups[0]) + labelled.cast("int") == 1) & F.forall(left, lambda w: w.isin("", *LABELS))
    else:
        alone = F.lit(True)
    found = F.coalesce(_itm(said), F.when(labelled & alone, _labelled(said, where)), F.when(alone, by_letters))

    def place(p: Column) -> Column:
        grids = {"british": BRITISH, "irish": IRISH, "itm": ITM}
        at = F.coalesce(*[F.when(p["grid"] == name, to_wgs84(p["east"], p["north"], grid)) for name, grid in grids.items()])
        hint = p["digits"] < FINE_DIGITS
        side = F.pow(F.lit(10.0), 5 - p["digits"])
        return F.struct(at["lat"].alias("lat"), at["lon"].alias("lon"), F.when(hint, "hint").otherwise("grid reference").alias("basis"), F.when(hint, side * math.sqrt(2) / 2000).alias("uncertainty_km"))

    return F.get(F.transform(F.filter(F.array(found), lambda p: p.isNotNull()), place), 0)
