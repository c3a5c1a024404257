"""Evidence of responses, its pages and places, and answers of address services."""

from pyspark.sql import functions as F

from ..functions import geocoding, grids
from ..operators import evidence, locate, nested, page_check
from . import page_places as places, responses  # noqa: F401
from .registry import VIEWS, query, table

c = F.col

VIEWS["fx_cited"] = """
SELECT site_id, pass, source, CASE source % 7 WHEN 0 THEN 'https://www.mapcarta.com/' || CAST(source AS STRING) WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE url END AS url, source_type, publication_date, facility_name, place,
       CASE place % 8 WHEN 0 THEN ' found_site_name' WHEN 1 THEN 'area_square_meters' WHEN 2 THEN 'found_latitude' ELSE attribute_name END AS attribute_name, value, CASE WHEN place % 5 = 0 THEN 'furlongs' ELSE 'ha' END AS unit, value_date
FROM {fx_flat}
"""
VIEWS["fx_cited_links"] = """
SELECT DISTINCT url, CASE source % 5 WHEN 0 THEN '200' WHEN 1 THEN '404' WHEN 2 THEN '403' ELSE 'redirect loop' END AS status, CASE WHEN source % 4 = 0 THEN url || '/moved' ELSE NULL END AS resolved_url FROM {fx_cited} WHERE source % 7 > 2 AND source % 5 < 4
"""
SUPPORTED = ["area_square_meters", "facility_status", "owner"]
READ = """x AS (SELECT *, CASE trim(attribute_name) WHEN 'area' THEN 'area_square_meters' WHEN 'found_site_name' THEN 'found_facility_name' ELSE trim(attribute_name) END AS attribute, dense_rank() OVER (PARTITION BY site_id ORDER BY pass, source) - 1 AS source_index,
    row_number() OVER (PARTITION BY site_id, pass, source ORDER BY place, attribute_name, value, unit, value_date) - 1 AS value_index FROM {fx_cited}),
  l AS (SELECT x.* EXCLUDE (url), coalesce(resolved_url, trim(x.url)) AS url, CASE WHEN status IS NULL THEN '' WHEN status = '200' THEN 'OK' WHEN status = '403' THEN 'Unverified' ELSE 'Broken' END AS link_status, status FROM x LEFT JOIN {fx_cited_links} k ON trim(x.url) = k.url WHERE source % 7 <> 0)"""


def cited(spark, sf):
    # dealt by site once: what follows groups by site and more
    read = nested.merged_passes(nested.read_sources(nested.responses(table(spark, sf, "fx_cited").repartition("site_id"))))
    return read.drop("source_index").withColumnRenamed("merged_index", "source_index")


@query("nr05_evidence", f"""WITH {READ}, v AS (SELECT *, CASE WHEN value = '' THEN 'empty' WHEN attribute = 'area_square_meters' AND unit = 'furlongs' THEN 'unit' END AS reason, lpad((source_index + 1)::VARCHAR, 3, '0') || '-' || lpad((value_index + 1)::VARCHAR, 3, '0') AS place_id
    FROM l WHERE attribute IN ('area_square_meters', 'facility_status', 'owner')), e AS (SELECT *, CASE WHEN url = '' THEN 'no link' WHEN link_status = 'Broken' THEN 'dead link' WHEN reason IS NOT NULL THEN 'unusable' END AS excluded FROM v)
  SELECT 'ev-' || site_id || '-S' || place_id AS evidence_id, 'src-' || CASE WHEN url = '' THEN site_id || '-S' || place_id ELSE substr(sha256(url), 1, 12) END AS source_id, site_id, source_index, url, link_status, attribute, value,
    CASE WHEN reason IS NULL THEN CASE WHEN attribute = 'area_square_meters' THEN (value::BIGINT * 10000)::VARCHAR ELSE value END END AS normalized, CASE WHEN source_type = '' THEN 5 WHEN publication_date IS NULL THEN 3 ELSE 1 END AS tier, excluded,
    CASE excluded WHEN 'no link' THEN 'No clickable link.' WHEN 'dead link' THEN 'Link broken (' || status || ').' WHEN 'unusable' THEN CASE reason WHEN 'empty' THEN 'Value empty after normalization.' ELSE 'Value can''t be used: unit.' END ELSE '' END AS exclusion FROM e""")
def nr05(spark, sf):
    return evidence.extracted(cited(spark, sf), table(spark, sf, "fx_cited_links"), SUPPORTED).drop("unit", "value_date")


@query("nr05_listed_sources", f"WITH {READ} SELECT site_id, source_index, url, facility_name, count(*) FILTER (WHERE attribute IN ('area_square_meters', 'facility_status', 'owner')) AS n_values FROM l GROUP BY ALL")
def nr05_sources(spark, sf):
    return evidence.listed_sources(cited(spark, sf), table(spark, sf, "fx_cited_links"), SUPPORTED)


@query("nr05_warnings", f"""WITH {READ}, k AS (SELECT site_id, attribute, bool_or(source % 7 <> 0) AS kept FROM x GROUP BY ALL)
  SELECT site_id, 'Unsupported attribute_name ''' || attribute || ''' dropped.' AS warning FROM k WHERE kept AND attribute = 'colour'
  UNION ALL SELECT site_id, attribute || ': every source was a dropped map site; not used.' FROM k WHERE NOT kept AND attribute IN ('area_square_meters', 'facility_status', 'owner')
  UNION ALL SELECT site_id, 'Dropped ' || count(*) || ' citation(s) of mapcarta.com: map sites that copy others are not used as sources.' FROM x WHERE source % 7 = 0 GROUP BY site_id""")
def nr05_warnings(spark, sf):
    return evidence.warnings(cited(spark, sf), SUPPORTED)


@query("jn12_page_check", """WITH e AS (SELECT source_id, k, source_id % 7 AS m, CASE WHEN source_id % 3 = 0 AND k <> 5 THEN 'found' WHEN source_id % 3 = 1 THEN 'not found' END AS q,
    CASE k WHEN 0 THEN 'found' WHEN 1 THEN 'partly' WHEN 2 THEN 'found' WHEN 3 THEN 'not found' WHEN 5 THEN 'not found' WHEN 6 THEN 'partly' WHEN 7 THEN 'not found' WHEN 8 THEN 'found' WHEN 9 THEN 'found' END AS p FROM {fx_page_places})
  SELECT source_id, CASE WHEN q IS NULL THEN NULL WHEN m = 1 THEN 'no page text' WHEN q = 'found' THEN q WHEN m = 0 THEN 'not in the part read' WHEN m = 2 THEN 'no page text' ELSE q END AS quote_on_page,
    CASE WHEN p IS NULL THEN NULL WHEN m = 1 THEN 'no page text' WHEN p = 'found' THEN p WHEN m = 0 THEN 'not in the part read' WHEN m = 2 THEN 'no page text' ELSE p END AS place_on_page FROM e""")
def jn12(spark, sf):
    m, whole = c("source_id") % 7, places.ends(spark, sf)
    end = F.expr("substr(text, length(page_text) + 1)")
    rows = whole.join(table(spark, sf, "fx_page_places").select("source_id", c("text").alias("page_text")), "source_id").withColumn("end", end)
    pages = rows.select("source_id", F.when(m.isin(2, 3), c("end")).when(m == 4, F.concat("text", F.lit("\n"), F.repeat(F.lit("prose "), 20))).otherwise(c("text")).alias("text"), F.when(m.isin(2, 4), "html").otherwise("text").alias("kind"), F.when(m == 0, "read in part").when(m == 1, "little text").alias("note"))
    said = places.stated(rows)
    quote = F.when(c("source_id") % 3 == 0, F.trim("end")).when(c("source_id") % 3 == 1, "zzqx qqzv xxyyzz wwvvq")
    return page_check.checked_evidence(said.join(rows.select("source_id", quote.alias("quote")), "source_id"), pages).select("source_id", "quote_on_page", "place_on_page")


@query("jn11_located", """WITH s AS (SELECT site_id AS key, site_id % 13 AS k, round(latitude, 3) AS la, round(CASE WHEN longitude > 180 THEN longitude - 360 ELSE longitude END, 3) AS lo, site_id % 10 = 0 AS even FROM {fx_sites})
  SELECT key, CASE WHEN k IN (0, 6, 11) OR (k = 3 AND NOT even) THEN 'coordinates' WHEN k IN (4, 8, 12) THEN 'rooftop' ELSE 'none' END AS basis,
    round(CASE WHEN k IN (0, 6, 11) THEN la + 0.01 WHEN k = 8 THEN la + 0.5 WHEN k IN (4, 12) OR (k = 3 AND NOT even) THEN la END, 4) AS latitude, round(CASE WHEN k IN (0, 4, 6, 8, 11, 12) OR (k = 3 AND NOT even) THEN lo END, 4) AS longitude,
    CASE WHEN k IN (1, 2) OR (k = 3 AND even) THEN 'copied from the prompt' WHEN k = 5 THEN 'the answer lies in South, not North' WHEN k = 7 THEN 'doubtful: its address lies 55.6 km from its coordinates' WHEN k = 9 THEN 'the site''s coordinates are postcode centroids' WHEN k = 10 THEN 'no location stated' ELSE '' END AS reason,
    CASE WHEN k = 7 THEN 2 ELSE 0 END AS rough FROM s""")
def jn11(spark, sf):
    k, la, lo, number = c("site_id") % 13, F.round("latitude", 3), F.round(F.when(c("longitude") > 180, c("longitude") - 360).otherwise(c("longitude")), 3), c("site_id").cast("string")
    point = lambda lat, digits=4: F.format_string(f"%.{digits}f, %.{digits}f", lat, lo)
    street = F.concat(number, F.lit(" Mill Road"))
    said = F.when(k.isin(0, 6, 9), point(la + 0.01)).when(k == 1, point(la, 2)).when(k.isin(2, 3), point(la)).when(k == 7, point(la + 0.5)).when(k == 8, point(la + 0.5, 1)).when(k == 10, " n/a | Unknown")
    address = F.when(k.isin(4, 5, 6, 7, 8), street).when(k == 10, "none").when(k == 11, point(la + 0.01)).when(k == 12, F.concat(F.lit("PO Box 7 | "), street))
    sites = table(spark, sf, "fx_sites")
    url = F.when(k == 9, "https://www.wastebook.co.uk/1").otherwise("https://a.example/1")
    rows = sites.select(c("site_id").alias("key"), url.alias("url"), F.lit("usa").alias("iso3"), address.alias("address"), said.alias("coordinates"), F.array("site_name").alias("names"), F.lit("Springfield").alias("town"), F.lit("North").alias("state"), la.alias("latitude"), lo.alias("longitude"), (k == 2).alias("earlier"))
    cache = sites.select(F.lit("USA").alias("country"), F.concat(street, F.lit(", Springfield, North")).alias("address"), F.when(k == 8, la + 0.5).otherwise(la).alias("lat"), lo.alias("lon"), F.lit("rooftop").alias("basis"), F.when(k == 5, "South").when(k == 4, "NORTH").alias("state"))
    found = locate.locate_stated(rows, cache)
    return found.select("key", "basis", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"), "reason", F.coalesce(F.size("rough"), F.lit(0)).alias("rough"))


@query("pj02_strict", """SELECT s_suppkey, s_suppkey % 8 IN (0, 1, 4, 6) AS alone FROM supplier""")
def pj02_strict(spark, sf):
    k, x, y = c("s_suppkey") % 8, c("s_suppkey") * 37 % 1000, c("s_suppkey") * 91 % 1000
    forms = ["Grid ref: TQ %03d %03d", "NGR TQ%03d%03d,", "Permit W0123, TQ %03d %03d", "12 Mill Road, TQ %03d %03d", "Easting: 4%03d00; Northing: 2%03d00", "Easting: 4%03d00, Northing: 2%03d00 at the gate", "ITM E 6%03d00, N 7%03d00 at the gate", "NGR TQ%03d%03d."]  # a full stop could begin a decimal
    said = F.coalesce(*[F.when(k == i, F.format_string(f, x, y)) for i, f in enumerate(forms)])
    rows = table(spark, sf, "supplier").select("s_suppkey", grids.grid_reference(said, F.lit("GBR"), strict=True).alias("p"))
    return rows.select("s_suppkey", c("p").isNotNull().alias("alone"))


POINTS = '[{"geometry":{"coordinates":[1,2]},"calculationMethod":"Interpolation","usageTypes":["Route"]},{"geometry":{"coordinates":[%o,%a]},"calculationMethod":"%m","usageTypes":["Route","Display"]}]'
#: Features as the service writes them (%a, %o: the point), their precision and what is said of them; none where there is no point.
FEATURES = [
    ('{"geometry":{"coordinates":[3,4]},"properties":{"type":"Address","confidence":"High","matchCodes":["Good"],"geocodePoints":' + POINTS.replace("%m", "Rooftop") + "}}", "rooftop", "Address, Rooftop, High, Good"),
    ('{"properties":{"type":"Address","confidence":"Medium","matchCodes":["Good"],"geocodePoints":' + POINTS.replace("%m", "Parcel") + "}}", "rooftop", "Address, Parcel, Medium, Good"),
    ('{"properties":{"type":"Address","confidence":"High","geocodePoints":' + POINTS.replace("%m", "InterpolationOffset") + "}}", "street", "Address, InterpolationOffset, High, no match code"),
    ('{"geometry":{"coordinates":[%o,%a]},"properties":{"type":"RoadBlock","confidence":"High","matchCodes":["Good"]}}', "street", "RoadBlock, no method, High, Good"),
    ('{"geometry":{"coordinates":[%o,%a]},"properties":{"type":"Address","confidence":"Low","matchCodes":["Good"]}}', "", "Address, no method, Low, Good"),
    ('{"geometry":{"coordinates":[%o,%a]},"properties":{"type":"RoadBlock","matchCodes":["Good","UpHierarchy"]}}', "", "RoadBlock, no method, no confidence, Good/UpHierarchy"),
    ('{"geometry":{"coordinates":[%o,%a]},"properties":{"type":"PopulatedPlace","confidence":"High","matchCodes":["Good"]}}', "", "PopulatedPlace, no method, High, Good"),
    ('{"geometry":{"coordinates":[%o]},"properties":{"type":"Address"}}', None, None),
    ('{"geometry":{"coordinates":[%o,%a]}}', "", "?, no method, no confidence, no match code"),
    ("not an answer", None, None),
]
RESULTS = [
    ('{"lat":"%a","lon":"%o","category":"building","type":"yes","osm_type":"way","place_rank":30,"address":{"city":"A","county":"B","state":"S","state_district":"D"}}', "rooftop", "building=yes on way, rank 30", "A", "S"),
    ('{"lat":"%a","lon":"%o","category":"place","type":"house","osm_type":"node","address":{"county":"B","province":"P"}}', "rooftop", "place=house on node, rank ?", "B", "P"),
    ('{"lat":"%a","lon":"%o","category":"place","type":"house","osm_type":"W","place_rank":"30","address":{"village":"V"}}', "street", "place=house on w, rank 30", "V", ""),
    ('{"lat":"%a","lon":"%o","class":"highway","type":"residential","address":{"region":"R"}}', "street", "highway=residential, rank ?", "", "R"),
    ('{"lat":"%a","lon":"%o","category":"highway","type":"trunk_link","osm_type":"way","place_rank":26}', "major road", "highway=trunk_link on way, rank 26", None, ""),
    ('{"lat":"%a","lon":"%o","category":"place","type":"town","place_rank":18,"address":{"town":" T ","municipality":""}}', "", "place=town, rank 18", "T", ""),
    ('{"lat":"","lon":"%o","category":"building"}', None, None, None, None),
    ('{"lat":"%a","lon":"%o","category":"landuse","type":"landfill","osm_type":"relation","address":{}}', "", "landuse=landfill on relation, rank ?", None, ""),
    ("[", None, None, None, None),
]


def by_case(cases: list, column: int, key: str) -> str:
    told = lambda x: "NULL" if x is None else f"'{x}'"
    return f"CASE {key} % {len(cases)} " + " ".join(f"WHEN {k} THEN {told(x[column])}" for k, x in enumerate(cases)) + " END"


def answers(spark, sf, cases: list):
    said = F.element_at(F.array(*[F.lit(x[0]) for x in cases]), (c("site_id") % len(cases) + 1).cast("int"))
    for mark, value in (("%a", "latitude"), ("%o", "longitude")):
        said = F.replace(said, F.lit(mark), F.format_string("%.3f", value))
    return table(spark, sf, "fx_sites").select("site_id", said.alias("answer"))


@query("pj04_geocoder_answers", f"SELECT site_id, CASE WHEN p IS NOT NULL THEN round(latitude, 3) END AS lat, CASE WHEN p IS NOT NULL THEN round(longitude, 3) END AS lon, p AS precision, described FROM (SELECT *, {by_case(FEATURES, 1, 'site_id')} AS p, {by_case(FEATURES, 2, 'site_id')} AS described FROM {{fx_sites}})")
def pj04(spark, sf):
    return answers(spark, sf, FEATURES).select("site_id", geocoding.feature_answer(c("answer")).alias("x")).select("site_id", F.round("x.lat", 3).alias("lat"), F.round("x.lon", 3).alias("lon"), "x.precision", "x.described")


@query("pj04_map_answers", f"SELECT site_id, CASE WHEN p IS NOT NULL THEN round(latitude, 3) END AS lat, CASE WHEN p IS NOT NULL THEN round(longitude, 3) END AS lon, p AS precision, described, town, state FROM (SELECT *, {by_case(RESULTS, 1, 'site_id')} AS p, {by_case(RESULTS, 2, 'site_id')} AS described, {by_case(RESULTS, 3, 'site_id')} AS town, {by_case(RESULTS, 4, 'site_id')} AS state FROM {{fx_sites}})")
def pj04_map(spark, sf):
    return answers(spark, sf, RESULTS).select("site_id", geocoding.result_answer(c("answer")).alias("x")).select("site_id", F.round("x.lat", 3).alias("lat"), F.round("x.lon", 3).alias("lon"), "x.precision", "x.described", c("x.place.municipality").alias("town"), "x.state")
