"""Where sources place a facility: stated coordinates and looked-up addresses, with guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import addresses, coordinates, grids, links, names
from ..functions.geo import haversine_km
from ..sources.tables import kept

COPIED_KM, APART_KM = 0.01, 2.0
# Sites whose coordinates are those of postcodes, and words that state no place.
CENTROID_SITES = ["wastebook.co.uk"]
NO_PLACE = ["", "none", "n/a", "na", "not stated", "not given", "unknown", "-", "blank"]


def locate(sources: DataFrame, cache: DataFrame) -> DataFrame:
    """sources (country, address, lat, lon, prompt_lat, prompt_lon, state) with found_lat, found_lon, basis and guard.

    Coordinates copied from what the search was told don't count; an answer in another state doesn't either; stated
    coordinates win, unless the address lies over 2 km away: then the place is doubtful. cache: (country, address,
    a_lat, a_lon, a_state), one row for each country and address.
    """
    out = sources.join(cache, ["country", "address"], "left")
    copied = haversine_km(F.col("lat"), F.col("lon"), F.col("prompt_lat"), F.col("prompt_lon")) <= COPIED_KM
    elsewhere = F.col("a_state").isNotNull() & F.col("state").isNotNull() & (F.lower("a_state") != F.lower("state"))
    point = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.coalesce(copied, F.lit(False))
    address = F.col("a_lat").isNotNull() & ~elsewhere
    apart = haversine_km(F.col("lat"), F.col("lon"), F.col("a_lat"), F.col("a_lon")) > APART_KM
    basis = F.when(point & address & apart, "doubtful").when(point, "coordinates").when(address, "address").otherwise("none")
    guard = F.when(F.coalesce(copied, F.lit(False)), "copied").when(elsewhere, "other state")
    out = out.withColumns({"basis": basis, "guard": guard})
    for axis in ("lat", "lon"):
        out = out.withColumn(f"found_{axis}", F.when(F.col("basis").isin("coordinates", "doubtful"), F.col(axis)).when(F.col("basis") == "address", F.col(f"a_{axis}")))
    return out


def _parts(column: str):
    said = F.transform(F.split(F.coalesce(column, F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.filter(said, lambda x: ~F.lower(x).isin(NO_PLACE))


def locate_stated(sources: DataFrame, cache: DataFrame) -> DataFrame:
    """(key, latitude, longitude, basis, reason, rough) of every source
    (key, url, iso3, address, coordinates, names, town, state, latitude, longitude, earlier); names: the facility's, an array.

    Parts of a stated field are set apart by |; the first that gives a point counts, an address that is nothing but
    coordinates or a grid reference among the coordinates. Another address is looked up as prepared, then in its plainer form, in
    cache (country, address, lat, lon, basis, state), one row for each country and address; an answer in another state
    isn't used. Coordinates of sites that give postcode centroids, and those copied from what the search was told (our
    point to two decimals; within 10 m of it in `earlier` responses), don't count. Coordinates win unless the address
    lies more than 2 km and a hint's uncertainty away: then the place is doubtful, without a point, and `rough` holds
    both points with their uncertainty; a hint that an address agrees with gives way to it. basis is coordinates, grid
    reference, hint, rooftop, street or none. key is unique.
    """
    rows = kept(sources)
    own = ["key", "iso3", "names", "town", "state"]
    said = rows.select(*own, F.explode(F.concat(
        F.transform(_parts("coordinates"), lambda x, i: F.struct(F.lit(0).alias("field"), i.alias("place"), x.alias("said"))),
        F.transform(_parts("address"), lambda x, i: F.struct(F.lit(1).alias("field"), i.alias("place"), x.alias("said"))),
    )).alias("p")).select(*own, "p.*")
    said = said.withColumns({"_loose": coordinates.stated_point(F.col("said"), F.col("iso3")), "_strict": coordinates.stated_point(F.col("said"), F.col("iso3"), strict=True), "_grid": F.when(F.col("field") == 0, grids.grid_reference(F.col("said"), F.col("iso3"))).otherwise(grids.grid_reference(F.col("said"), F.col("iso3"), strict=True))})
    grid = F.col("_grid")
    stated = lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), p["basis"].alias("basis"), p["reason"].alias("reason"), p["uncertainty_km"].alias("km"))
    by_grid = F.when(grid["basis"].isNotNull(), F.struct(grid["lat"].alias("lat"), grid["lon"].alias("lon"), grid["basis"].alias("basis"), F.lit(None).cast("string").alias("reason"), grid["uncertainty_km"].alias("km")))
    unread = F.struct(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit("none").alias("basis"), F.lit("could not read the stated coordinates").alias("reason"), F.lit(0.0).alias("km"))
    point = F.when(F.col("field") == 0, F.coalesce(F.when(F.col("_loose").isNotNull(), stated(F.col("_loose"))), by_grid, unread)).otherwise(F.coalesce(F.when(F.col("_strict").isNotNull(), stated(F.col("_strict"))), by_grid))
    said = kept(said.withColumn("point", point).drop("_loose", "_strict", "_grid"))
    first = lambda column: F.min_by(column, F.struct(F.col(column)["lat"].isNull(), "field", "place"))
    points = said.where("point IS NOT NULL").groupBy("key").agg(first("point").alias("point"))

    sent = said.where("point IS NULL").select(*own, "field", "place", addresses.prepared(F.col("said"), F.col("names"), F.col("town"), F.col("state")).alias("a"))
    tries = sent.select("key", "field", "place", F.col("iso3"), "state", F.col("a.refused").alias("refused"), F.posexplode_outer(F.filter(F.array("a.sent", "a.plainer"), lambda x: x.isNotNull())).alias("try", "address"))
    known = cache.select(F.upper("country").alias("iso3"), "address", F.struct("lat", "lon", "basis", F.col("state").alias("in_state")).alias("c"))
    asked = tries.withColumn("iso3", F.upper("iso3")).join(known, ["iso3", "address"], "left")
    usable = F.col("c.basis").isin("rooftop", "street")
    other_state = usable & (F.coalesce(F.trim("c.in_state"), F.lit("")) != "") & (F.coalesce(F.trim("state"), F.lit("")) != "") & (names.plain(F.col("c.in_state")) != names.plain(F.col("state")))
    reason = F.when(F.col("refused").isNotNull(), F.col("refused")).when(other_state, F.concat(F.lit("the answer lies in "), "c.in_state", F.lit(", not "), "state")).when(F.col("c").isNull(), "not looked up").when(~usable, "answered only coarser than a street")
    good = usable & ~F.coalesce(other_state, F.lit(False))
    told = F.struct(F.when(good, F.col("c.lat")).alias("lat"), F.when(good, F.col("c.lon")).alias("lon"), F.when(good, F.col("c.basis")).otherwise("none").alias("basis"), reason.alias("reason"), F.lit(0.0).alias("km"))
    found = asked.withColumn("answer", told).groupBy("key").agg(F.min_by("answer", F.struct(F.col("answer.lat").isNull(), "place", F.coalesce("try", F.lit(0)))).alias("addressed"))

    out = rows.join(points, "key", "left").join(found, "key", "left")
    at, by = F.col("point"), F.col("addressed")
    centroid = links.of_site(F.col("url"), CENTROID_SITES).isNotNull() & at["basis"].isin("coordinates", "grid reference", "hint")
    rounded = (F.abs(at["lat"] - F.round("latitude", 2)) < 1e-9) & (F.abs(at["lon"] - F.round("longitude", 2)) < 1e-9)
    near = F.col("earlier") & (haversine_km(F.col("latitude"), F.col("longitude"), at["lat"], at["lon"]) <= COPIED_KM)
    copied = at["basis"].isin("coordinates", "hint") & (F.coalesce(rounded, F.lit(False)) | F.coalesce(near, F.lit(False)))
    nowhere = lambda why: F.struct(F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit("none").alias("basis"), why.alias("reason"), F.lit(0.0).alias("km"))
    guarded = F.when(at["lat"].isNull(), at).when(F.coalesce(centroid, F.lit(False)), nowhere(F.lit("the site's coordinates are postcode centroids"))).when(F.coalesce(copied, F.lit(False)), nowhere(F.lit("copied from the prompt"))).otherwise(at)
    out = kept(out.select("key", guarded.alias("point"), by.alias("addressed")))
    slack = F.when(F.col("point.basis") == "hint", F.col("point.km")).otherwise(0.0)
    apart = haversine_km(F.col("point.lat"), F.col("point.lon"), F.col("addressed.lat"), F.col("addressed.lon"))
    both = F.col("point.lat").isNotNull() & F.col("addressed.lat").isNotNull()
    doubtful = both & (apart > APART_KM + slack)
    rough = F.when(doubtful, F.array(F.struct(F.col("point.lat").alias("lat"), F.col("point.lon").alias("lon"), slack.alias("km")), F.struct(F.col("addressed.lat").alias("lat"), F.col("addressed.lon").alias("lon"), F.lit(0.0).alias("km"))))
    chosen = F.when(doubtful, nowhere(F.format_string("doubtful: its address lies %.1f km from its coordinates", apart))).when(both & (F.col("point.basis") == "hint"), F.col("addressed")).when(F.col("point.lat").isNotNull(), F.col("point")).when(F.col("addressed.lat").isNotNull() | F.col("point").isNull(), F.col("addressed")).otherwise(F.col("point"))
    return out.select("key", F.coalesce(chosen, nowhere(F.lit("no location stated"))).alias("w"), rough.alias("rough")).select("key", F.col("w.lat").alias("latitude"), F.col("w.lon").alias("longitude"), F.coalesce("w.basis", F.lit("none")).alias("basis"), F.coalesce("w.reason", F.lit("")).alias("reason"), "rough")
