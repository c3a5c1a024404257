"""Places that page texts state: found once per page, then joined with what is said of the page.

Points, grid references, addresses and postcodes become rows with their position. They meet sites and stated places by
equal page and cell, never pair by pair, and the strongest kind of a page is a minimum over structs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import coordinates, grids, phrases
from ..sources.tables import kept
from . import spatial
from .pages import fold_pages, quote_results

#: Kinds of places, the strongest first; the first three are what a reader could have stated.
KINDS = ["coordinates", "grid reference", "street address", "another facility's point", "postcode"]
#: A point is a site's within the first distance, and none of this region beyond the last.
STEPS_KM = (5.0, 50.0, 300.0)
#: A point stated in another form counts as the same within this distance.
SAME_KM = 0.25


def found_places(pages: DataFrame, key: str) -> DataFrame:
    """(key, kind, start, lat, lon, fine, said, country) of all places on pages (key, text, countries).

    countries: the ISO 3 codes to read a page by, an array; the first one tells which side O is.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for page, text, countries in zip(frame[key], frame["text"], frame["countries"]):
                countries = [c for c in (countries if countries is not None else []) if c]
                text, one = text or "", countries[0] if countries else ""
                rows = [("coordinates", start, lat, lon, fine, phrases.shown(text, start)) for start, _, lat, lon, fine in coordinates.on_page(text, one)]
                rows += [("grid reference", a, None, None, True, text[a:b]) for a, b in phrases.grid_texts(text, countries)]
                for kind, span in (("street address", phrases.address(text)), ("postcode", phrases.postcode(text, countries))):
                    if span:
                        rows.append((kind, span[0], None, None, True, phrases.shown(text, span[0])))
                if rows:
                    out = pd.DataFrame(rows, columns=["kind", "start", "lat", "lon", "fine", "said"])
                    out.insert(0, key, page)
                    yield out.assign(country=one)

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(key, "text", "countries").mapInPandas(run, f"{key} {kind}, kind string, start int, lat double, lon double, fine boolean, said string, country string")
    grid = F.when(F.col("kind") == "grid reference", grids.grid_reference(F.col("said"), F.col("country")))
    rows = rows.withColumn("_grid", grid).where("kind <> 'grid reference' OR _grid.basis = 'grid reference'")
    return rows.withColumns({axis: F.coalesce(F.col(axis), F.col("_grid")[axis]) for axis in ("lat", "lon")}).drop("_grid")


def missed_locations(citations: DataFrame, sites: DataFrame, pages: DataFrame) -> DataFrame:
    """(source_id, stated, found_kind, found_text, lat, lon, km, missed) of every cited page with a text.

    citations: (source_id, site_id, stated: whether a place was stated); sites: (site_id, latitude, longitude, iso3);
    pages: (source_id, text). found_kind is the strongest kind that the page states: a point within 5 km of a site that
    cites it, an address, the nearest other point within 300 km, a postcode of a citing site's country. missed: nothing
    was stated though the page states one of the first three kinds.
    """
    cited = citations.join(sites, "site_id", "left").select("source_id", "stated", "latitude", "longitude", F.upper("iso3").alias("iso3"))
    facts = cited.groupBy("source_id").agg(F.array_sort(F.collect_set("iso3")).alias("countries"), F.coalesce(F.max("stated"), F.lit(False)).alias("stated"))
    texts = pages.where("text <> ''").join(facts, "source_id")
    found = kept(found_places(texts, "source_id"))
    points = found.where("lat IS NOT NULL AND fine").select("source_id", "kind", "start", "said", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    places = cited.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(F.col("source_id").alias("_by"), F.col("latitude").alias("other_latitude"), F.col("longitude").alias("other_longitude")).distinct()
    best, left = None, points
    for km in STEPS_KM:
        pairs = spatial.near(left, places, km, on=[("source_id", "_by")], degrees=max(0.1, km / 60))
        step = kept(pairs.groupBy("source_id").agg(F.min(F.struct("km", "start", "kind", "said", "latitude", "longitude")).alias("w")).select("source_id", "w.*"))
        best = step if best is None else best.unionByName(step)
        left = left.join(step.select("source_id"), "source_id", "left_anti")
    rank = F.when(F.col("km") > STEPS_KM[0], F.lit(KINDS[3])).otherwise(F.col("kind"))
    offered = best.withColumn("kind", rank).unionByName(found.where(F.col("kind").isin(KINDS[2], KINDS[4])).select("source_id", F.lit(None).cast("double").alias("km"), "start", "kind", "said", F.col("lat").alias("latitude"), F.col("lon").alias("longitude")))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    # near points go by distance before kind
    order = F.when(order <= 2, F.lit(1)).otherwise(order)
    strongest = offered.groupBy("source_id").agg(F.min_by(F.struct("kind", "said", "latitude", "longitude", "km"), F.struct(order, "km", "start")).alias("w"))
    out = texts.select("source_id", "stated").join(strongest, "source_id", "left")
    missed = ~F.col("stated") & F.coalesce(F.col("w.kind").isin(KINDS[:3]), F.lit(False))
    return out.select("source_id", "stated", F.col("w.kind").alias("found_kind"), F.col("w.said").alias("found_text"), F.col("w.latitude").alias("lat"), F.col("w.longitude").alias("lon"), F.col("w.km").alias("km"), missed.alias("missed"))


def missed_summary(measured: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_type, found_kind, pages, silent, missed): pages by type and strongest kind; silent: nothing was stated."""
    typed = measured.join(sources.select("source_id", "source_type"), "source_id", "left")
    return typed.groupBy("source_type", "found_kind").agg(F.count("*").alias("pages"), F.count_if(~F.col("stated")).alias("silent"), F.count_if("missed").alias("missed"))


def stated_places_on_pages(stated: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """stated (key, address, coordinates, basis, lat, lon) with `place_on_page`.

    Parts of an address or of coordinates are set apart by |. Each number of stated coordinates must stand on the page to
    the decimals stated, zeros at the end aside; a grid reference without its spaces; an address as a quote. A point
    that was read from coordinates is also there if the page gives one within 250 m in any form. Where both are stated,
    the part that the point came from decides (basis: coordinates, grid reference, rooftop or street), else the better
    one. Null where nothing is stated; pages: (key, text), a page without text is no row.
    """
    rows = kept(stated.withColumn("_row", F.monotonically_increasing_id()))

    def parts(column: str, kind: str):
        said = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
        return F.transform(said, lambda x: F.struct(F.lit(kind).alias("field"), x.alias("said")))

    own = rows.select(key, "_row", "basis", "lat", "lon", F.explode(F.concat(parts("coordinates", "point"), parts("address", "address"))).alias("p")).select(key, "_row", "basis", "lat", "lon", "p.*")
    loose, strict = coordinates.stated_point(F.col("said")), coordinates.stated_point(F.col("said"), strict=True)
    own = own.withColumns({"_loose": loose, "_strict": strict})
    point = F.when(F.col("field") == "point", F.col("_loose").isNotNull()).otherwise(F.col("_strict").isNotNull())
    own = kept(own.withColumn("kind", F.when(point, "coordinates").when(F.col("field") == "point", "grid reference").otherwise("address")).drop("_loose", "_strict"))

    # numbers and grid references against the page's plain text, phrases as quotes are
    asked = pages.where("text <> ''").join(own.select(key).distinct(), key, "left_semi")
    folded = kept(fold_pages(asked))
    numbers = F.regexp_extract_all("said", F.lit(r"(\d{1,3}[.,]\d{2,})"), F.lit(1))
    squares = F.filter(F.transform(F.regexp_extract_all("said", F.lit(r"([A-Za-z]{1,2}\s*\d[\d\s]*)"), F.lit(1)), lambda x: F.lower(F.regexp_replace(x, r"\s", ""))), lambda x: x != "")
    exact = own.withColumns({"_numbers": F.when(F.col("kind") == "coordinates", numbers), "_squares": F.when(F.col("kind") == "grid reference", squares)})
    measured = exact.where(F.coalesce(F.size("_numbers") > 0, F.size("_squares") > 0, F.lit(False))).join(folded.select(key, "_plain", "_compact"), key)
    pattern = lambda n: F.concat(F.lit("(?<![0-9])"), F.regexp_replace(n, "[.,].*$", ""), F.lit(" "), F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(n, "^.*[.,]", ""), "0+$", ""), F.lit("")), F.lit("0")), F.lit("[0-9]*(?![0-9])"))
    there = F.size(F.filter("_numbers", lambda n: F.regexp_like(F.col("_plain"), pattern(n))))
    by_number = F.when(there == F.size("_numbers"), "found").when(there > 0, "partly").otherwise("not found")
    by_square = F.when(F.forall("_squares", lambda s: F.contains(F.col("_compact"), s)), "found").otherwise("not found")
    measured = measured.select("_row", "kind", F.when(F.col("kind") == "coordinates", by_number).otherwise(by_square).alias("result"))
    phrases_of = exact.where(~F.coalesce(F.size("_numbers") > 0, F.size("_squares") > 0, F.lit(False)))
    quoted = quote_results(phrases_of.select(key, "_row", "kind", F.col("said").alias("quote")), asked, key, least_words=1).select("_row", "kind", "result")

    # points of the page near the one that was read: equal page and cell
    sought = rows.where("basis = 'coordinates' AND lat IS NOT NULL AND lon IS NOT NULL").select(key, "_row", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    near_pages = asked.join(sought.select(key).distinct(), key, "left_semi").withColumn("countries", F.array().cast("array<string>"))
    held = found_places(near_pages, key).where("kind = 'coordinates'").select(F.col(key).alias("_by"), F.col("lat").alias("other_latitude"), F.col("lon").alias("other_longitude")).distinct()
    close = spatial.near(sought, held, SAME_KM, on=[(key, "_by")], degrees=0.01).select("_row").distinct().withColumn("_near", F.lit(True))

    results = measured.unionByName(quoted).join(close, "_row", "left").where("result IS NOT NULL")
    results = results.withColumn("result", F.when((F.col("kind") == "coordinates") & F.col("_near"), "found").otherwise(F.col("result")))
    used = F.when(F.col("basis").isin("coordinates", "grid reference"), F.col("basis")).when(F.col("basis").isin("rooftop", "street"), "address")
    rank = F.array_position(F.array(F.lit("found"), F.lit("partly"), F.lit("not found"), F.lit("no page text")), F.col("result"))
    judged = results.join(rows.select("_row", used.alias("_used")), "_row").groupBy("_row").agg(F.min(F.when(F.col("kind") == F.col("_used"), rank)).alias("own"), F.min(rank).alias("any"))
    words = F.element_at(F.array(F.lit("found"), F.lit("partly"), F.lit("not found"), F.lit("no page text")), F.coalesce("own", "any").cast("int"))
    texts = asked.select(key).distinct().withColumn("_text", F.lit(True))
    said = own.select("_row").distinct().withColumn("_said", F.lit(True))
    out = rows.join(judged.select("_row", words.alias("_result")), "_row", "left").join(said, "_row", "left").join(texts, key, "left")
    return out.withColumn("place_on_page", F.when(F.col("_said") & F.col("_text").isNull(), "no page text").otherwise(F.col("_result"))).select(*stated.columns, "place_on_page")
