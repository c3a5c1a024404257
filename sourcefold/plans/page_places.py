"""Places that sources and page texts state."""

from pyspark.sql import functions as F

from ..functions import addresses, coordinates, phrases
from ..operators import page_places
from . import views  # noqa: F401
from .registry import VIEWS, query, table

c = F.col

#: Every document is the text of a page that a site cites; what its end says of the place goes by the document's number.
VIEWS["fx_page_places"] = """
SELECT doc_id AS source_id, site_id, k, latitude, longitude, CASE site_id % 4 WHEN 0 THEN 'GBR' WHEN 1 THEN 'CAN' WHEN 2 THEN 'AUS' ELSE 'IRL' END AS iso3, CASE doc_id % 3 WHEN 0 THEN 'Regulator' WHEN 1 THEN 'News report' ELSE NULL END AS source_type, doc_id % 5 = 0 AS stated, text
FROM (SELECT doc_id, coalesce(text, '') AS text, 1 + doc_id % 150 AS site_of, doc_id % 10 AS k FROM {documents}) d JOIN {fx_sites} ON site_of = site_id
"""

#: What the ends of pages say; %1 and %2 are the site's latitude and longitude with four decimals, %3 a latitude half a degree and %4 one ten degrees off.
ENDS = [
    "\nSite at %1, %2", "\nLatitude: %3, Longitude: %2.", "\nVisit 12 Old Mill Road today", "\nOficina: Calle Mayor 15", "\nPost to {code}", "\nNothing more", "\nlot 12, concession 4", "\nSeen near %4, %2",
    "\nOffice: 4800-2 Old Highway; seen at %3, %2", "\n(lon %2, lat %1), Hauptstraße 7b, {code}"]
CODES = {"GBR": "SW1A 1AA", "CAN": "K1A 0B1", "AUS": "NSW 2000", "IRL": "D02 X285"}


def ends(spark, sf):
    """The view's rows with the whole page text; pages write a longitude beyond the date line as a western one."""
    said = F.element_at(F.array(*[F.lit(e) for e in ENDS]), (c("k") + 1).cast("int"))
    for mark, value in (("%1", c("latitude")), ("%2", c("longitude")), ("%3", c("latitude") + 0.5), ("%4", c("latitude") + 10)):
        said = F.replace(said, F.lit(mark), F.format_string("%.4f", value))
    said = F.replace(said, F.lit("{code}"), F.element_at(F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair]), c("iso3")))
    rows = table(spark, sf, "fx_page_places").withColumn("longitude", F.when(c("longitude") > 180, c("longitude") - 360).otherwise(c("longitude")))
    return rows.withColumn("text", F.concat("text", said))


@query("pj09_address_phrases", """SELECT source_id, CASE k WHEN 2 THEN '12 Old Mill Road' WHEN 3 THEN 'Calle Mayor 15' WHEN 6 THEN 'lot 12, concession 4' WHEN 8 THEN '4800-2 Old Highway' WHEN 9 THEN 'Hauptstraße 7b' END AS address,
  CASE WHEN k IN (4, 9) THEN CASE iso3 WHEN 'GBR' THEN 'SW1A 1AA' WHEN 'CAN' THEN 'K1A 0B1' WHEN 'AUS' THEN 'NSW 2000' ELSE 'D02 X285' END END AS postcode FROM {fx_page_places}""")
def pj09(spark, sf):
    from collections.abc import Iterator

    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = lambda t, span: t[slice(*span)] if span else None
        for f in frames:
            yield pd.DataFrame({"source_id": f["source_id"], "address": [cut(t, phrases.address(t)) for t in f["text"]], "postcode": [cut(t, phrases.postcode(t, [k])) for t, k in zip(f["text"], f["iso3"])]})

    return ends(spark, sf).select("source_id", "text", "iso3").mapInPandas(run, "source_id long, address string, postcode string")


@query("ag18_missed_locations", """SELECT *, NOT stated AND coalesce(found_kind, '') IN ('coordinates', 'street address') AS missed FROM (
  SELECT source_id, stated, CASE k WHEN 0 THEN 'coordinates' WHEN 9 THEN 'coordinates' WHEN 1 THEN 'another facility''s point' WHEN 4 THEN 'postcode' WHEN 5 THEN NULL WHEN 7 THEN NULL ELSE 'street address' END AS found_kind,
    CASE WHEN k IN (0, 9) THEN 0.0 WHEN k = 1 THEN round(6371.0088 * radians(0.5), 2) END AS km FROM {fx_page_places})""")
def ag18(spark, sf):
    rows = ends(spark, sf)
    sites = rows.select("site_id", "latitude", "longitude", "iso3").distinct()
    found = page_places.missed_locations(rows.select("source_id", "site_id", "stated"), sites, rows.select("source_id", "text"))
    return found.select("source_id", "stated", "found_kind", F.round("km", 2).alias("km"), "missed")


@query("ag18_missed_summary", """SELECT source_type, found_kind, count(*) AS pages, count(*) FILTER (WHERE NOT stated) AS silent, count(*) FILTER (WHERE NOT stated AND coalesce(found_kind, '') IN ('coordinates', 'street address')) AS missed FROM (
  SELECT source_type, stated, CASE k WHEN 0 THEN 'coordinates' WHEN 9 THEN 'coordinates' WHEN 1 THEN 'another facility''s point' WHEN 4 THEN 'postcode' WHEN 5 THEN NULL WHEN 7 THEN NULL ELSE 'street address' END AS found_kind FROM {fx_page_places}) GROUP BY ALL""")
def ag18_summary(spark, sf):
    rows = ends(spark, sf)
    sites = rows.select("site_id", "latitude", "longitude", "iso3").distinct()
    found = page_places.missed_locations(rows.select("source_id", "site_id", "stated"), sites, rows.select("source_id", "text"))
    return page_places.missed_summary(found, rows)


@query("pj01_coordinates", """SELECT c_custkey, CASE WHEN k = 11 THEN NULL ELSE round(CASE WHEN k IN (4, 8) THEN -a WHEN k = 9 THEN 10 + c_custkey * 37 % 60000 // 10 / 100.0 ELSE a END, 3) END AS lat, CASE WHEN k = 11 THEN NULL ELSE round(CASE WHEN k IN (1, 4, 6, 8) THEN -o WHEN k = 9 THEN 95 + c_custkey * 91 % 80000 // 10 / 100.0 ELSE o END, 3) END AS lon,
  CASE WHEN k = 9 THEN 'hint' WHEN k <> 11 THEN 'coordinates' END AS basis, k = 11 AS beyond FROM (SELECT c_custkey, c_custkey % 12 AS k, 10 + c_custkey * 37 % 60000 / 1000.0 AS a, 95 + c_custkey * 91 % 80000 / 1000.0 AS o FROM customer)""")
def pj01(spark, sf):
    a, o = F.lit(10) + c("c_custkey") * 37 % 60000 / 1000.0, F.lit(95) + c("c_custkey") * 91 % 80000 / 1000.0

    def dms(x, mark):
        minutes = F.floor((x % 1) * 60)
        return F.format_string(f"%d° %d′ %.1f″ {mark}", F.floor(x).cast("int"), minutes.cast("int"), ((x % 1) * 60 - minutes) * 60)

    spelled = [
        F.format_string("%.3f, %.3f", a, o),
        F.format_string("%.3f°N %.3f°W", a, o),
        F.concat(F.lit("The gate (1.5 km south, 12.345 ha) is at "), dms(a, "N"), F.lit(", "), dms(o, "E")),
        F.translate(F.format_string("%.3f; %.3f", a, o), ".", ","),
        F.format_string("latitud sur %.3f, longitud oeste %.3f", a, o),
        F.format_string("POINT(%.3f %.3f)", o, a),
        F.format_string("lon -%.3f, lat %.3f", o, a),
        F.format_string("%.3f N %.3f O", a, o),
        F.format_string("Latitude S: %.3f Longitude W: %.3f", a, o),
        F.format_string("%.2f, %.2f", F.lit(10) + F.floor(c("c_custkey") * 37 % 60000 / 10) / 100, F.lit(95) + F.floor(c("c_custkey") * 91 % 80000 / 10) / 100),
        F.format_string("%.3f (long), %.3f (lat)", o, a),
        F.format_string("%.3f, %.3f", a + 90, o + 90),
    ]
    k = c("c_custkey") % len(spelled)
    said = F.coalesce(*[F.when(k == i, s) for i, s in enumerate(spelled)])
    rows = table(spark, sf, "customer").select("c_custkey", coordinates.stated_point(said, F.lit("DEU")).alias("p"))
    return rows.select("c_custkey", F.round("p.lat", 3).alias("lat"), F.round("p.lon", 3).alias("lon"), "p.basis", F.coalesce(c("p.reason").startswith("coordinates out"), F.lit(False)).alias("beyond"))


def stated(rows):
    """What sources state of the pages' places, by k."""
    k = c("k")
    point = lambda lat: F.format_string("%.4f, %.4f", lat, c("longitude"))
    said = F.when(k == 0, point(c("latitude") - 0.001)).when(k == 1, point(c("latitude"))).when(k == 5, "TQ 310 806").when(k == 8, point(c("latitude") + 0.5))
    address = F.when(k == 2, "12 old Mill RD.").when(k == 3, "Calle Mayor 98765").when(k == 6, "Lot 12 Concession 4, Canada").when(k == 7, "somewhere").when(k == 8, "Elsewhere Avenue 98765").when(k == 9, point(c("latitude")))
    basis = F.when(k.isin(0, 1, 8), "coordinates").when(k == 5, "grid reference").otherwise("rooftop")
    lat = F.when(k == 0, c("latitude") - 0.001).when(k == 8, c("latitude") + 0.5).otherwise(c("latitude"))
    return rows.select("source_id", address.alias("address"), said.alias("coordinates"), basis.alias("basis"), lat.alias("lat"), c("longitude").alias("lon"))


@query("pj08_stated_places", """SELECT source_id, CASE k WHEN 0 THEN 'found' WHEN 1 THEN 'partly' WHEN 2 THEN 'found' WHEN 3 THEN 'not found' WHEN 5 THEN 'not found' WHEN 6 THEN 'partly' WHEN 7 THEN 'no page text' WHEN 8 THEN 'found' WHEN 9 THEN 'found' END AS place_on_page FROM {fx_page_places}""")
def pj08_places(spark, sf):
    rows = ends(spark, sf)
    return page_places.stated_places_on_pages(stated(rows), rows.where("k <> 7").select("source_id", "text"), "source_id").select("source_id", "place_on_page")


#: Addresses as sources write them ({n}: the supplier's name, {k}: its number), what is sent, what is sent again, and why nothing is.
WRITTEN = [
    ("{n}, {k} Mill Road, Springfield", "{k} Mill Road, Springfield, North", None, None),
    ("P.O. Box {k}, Mill Road {k}", "Mill Road {k}, Springfield, North", None, None),
    ("Km {k}", None, None, "kilometre marker"),
    ("PO Box {k}", None, None, "post box alone"),
    ("{n}", None, None, "a name alone"),
    ("{k} High Street on NW 1/4 17-10-18 WPM in Springfield", "{k} High Street on NW 1/4 17-10-18 WPM in Springfield, Springfield, North", "{k} High Street, Springfield, North", None),
    ("Lots A & B, {k} Dam Road (gate {k}), off Highway 11, Town of Springfield", "Lots A & B, {k} Dam Road (gate {k}), off Highway 11, Town of Springfield, North", "{k} Dam Road, Springfield, North", None),
    ("", None, None, "no address"),
    ("over there", None, None, "no street and no place"),
]
SENT = "CASE s_suppkey % {size} {whens} END"


def _written(column: int) -> str:
    told = lambda x: "NULL" if x is None else "replace('" + x.replace("'", "''").replace("{k}", "#") + "', '#', s_suppkey::VARCHAR)"
    return SENT.format(size=len(WRITTEN), whens=" ".join(f"WHEN {k} THEN {told(w[column])}" for k, w in enumerate(WRITTEN)))


@query("pj03_prepared_addresses", f"SELECT s_suppkey, {_written(1)} AS sent, {_written(2)} AS plainer, {_written(3)} AS refused FROM supplier")
def pj03_prepared(spark, sf):
    said = F.element_at(F.array(*[F.lit(w[0]) for w in WRITTEN]), (c("s_suppkey") % len(WRITTEN) + 1).cast("int"))
    said = F.replace(F.replace(said, F.lit("{n}"), F.upper("s_name")), F.lit("{k}"), c("s_suppkey").cast("string"))
    rows = table(spark, sf, "supplier").select("s_suppkey", addresses.prepared(said, F.array(c("s_name"), F.lit("Supplier")), F.lit("Springfield"), F.lit("North")).alias("p"))
    return rows.select("s_suppkey", "p.sent", "p.plainer", "p.refused")
