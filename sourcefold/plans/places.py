"""Places that sources state."""

from pyspark.sql import functions as F

from ..functions import addresses, grids
from ..operators import locate
from . import views  # noqa: F401
from .registry import query, table

c = F.col


@query("jn11_locate_sources", """SELECT ord, url, CASE WHEN k IN (0, 4) THEN 'coordinates' WHEN k IN (1, 2) THEN 'address' WHEN k = 3 THEN 'doubtful' ELSE 'none' END AS basis, CASE WHEN k = 1 THEN 'copied' WHEN k = 4 OR k = 5 THEN 'other state' END AS guard FROM (SELECT ord, url, ord % 6 AS k FROM {fx_citations})""")
def jn11(spark, sf):
    k = c("ord") % 6
    rows = table(spark, sf, "fx_citations").select("ord", "url", F.lit("c").alias("country"), F.when(k != 0, F.concat(F.lit("street "), (c("ord") % 60).cast("string"))).alias("address"), F.when(~k.isin(2, 5), F.lit(10.0)).alias("lat"), F.when(~k.isin(2, 5), F.lit(20.0)).alias("lon"), F.when(k == 1, 10.00001).otherwise(F.lit(50.0)).alias("prompt_lat"), F.lit(20.0).alias("prompt_lon"), F.lit("North").alias("state"))
    cache = table(spark, sf, "fx_citations").select(F.concat(F.lit("street "), (c("ord") % 60).cast("string")).alias("address"), (c("ord") % 6).alias("j")).distinct()
    cache = cache.select(F.lit("c").alias("country"), "address", F.when(c("j") == 3, 11.0).otherwise(F.lit(10.001)).alias("a_lat"), F.lit(20.0).alias("a_lon"), F.when(c("j").isin(4, 5), "South").otherwise(F.lit("north")).alias("a_state"))
    return locate.locate(rows, cache).select("ord", "url", "basis", "guard")


@query("pj03_address_to_send", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '12 Mill Road, Springfield, North' WHEN 1 THEN 'Mill Road, Springfield, North' END AS address, CASE s_suppkey % 4 WHEN 2 THEN 'kilometre marker' WHEN 3 THEN 'no address' END AS reason FROM supplier""")
def pj03(spark, sf):
    k = c("s_suppkey") % 4
    said = F.when(k == 0, F.concat("s_name", F.lit(", 12 Mill Road"))).when(k == 1, "P.O. Box 12, Mill Road, Springfield").when(k == 2, "Km 14").otherwise(F.lit("PO Box 7"))
    sent, reason = addresses.to_send(said, c("s_name"), F.lit("Springfield"), F.lit("North"))
    return table(spark, sf, "supplier").select("s_suppkey", sent.alias("address"), reason.alias("reason"))


@query("pj08_stated_numbers", "SELECT doc_id, contains(text, '12.5') AND contains(text, (doc_id % 100) || '.25') AS there FROM (SELECT doc_id, text || CASE WHEN doc_id % 2 = 0 THEN ' 12.5, ' || (doc_id % 100) || '.25' ELSE '' END AS text FROM documents)")
def pj08(spark, sf):
    place = F.concat(F.lit("12.5, "), (c("doc_id") % 100).cast("string"), F.lit(".25"))
    page = F.concat("text", F.when(c("doc_id") % 2 == 0, F.concat(F.lit(" "), place)).otherwise(F.lit("")))
    return table(spark, sf, "documents").select("doc_id", addresses.numbers_on_page(place, page).alias("there"))


#: Snyder's inverse series and fixed-point latitudes, where the column function has Krueger's and a closed form.
GRID_SQL = """WITH g(grid, a, b, k0, lat0, lon0, e0, n0, tx, ty, tz, rx, ry, rz, ppm) AS (VALUES
  (0, 6377563.396::DOUBLE, 6356256.909::DOUBLE, 0.9996012717::DOUBLE, 49.0::DOUBLE, -2.0::DOUBLE, 400000.0::DOUBLE, -100000.0::DOUBLE, 446.448::DOUBLE, -125.157::DOUBLE, 542.06::DOUBLE, 0.15::DOUBLE, 0.247::DOUBLE, 0.842::DOUBLE, -20.489::DOUBLE),
  (1, 6377340.189, 6356034.447938534, 1.000035, 53.5, -8.0, 200000.0, 250000.0, 482.5, -130.6, 564.6, -1.042, -0.214, -0.631, 8.15),
  (2, 6378137.0, 6356752.314140356, 0.99982, 53.5, -8.0, 600000.0, 750000.0, 0, 0, 0, 0, 0, 0, 0)),
p AS (SELECT s_suppkey, s_suppkey % 5 AS k, s_suppkey * 37 % 1000 AS x, s_suppkey * 91 % 1000 AS y, s_suppkey % 3 AS s FROM supplier),
q AS (SELECT s_suppkey, k, CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS grid,
  CASE k WHEN 0 THEN [500000, 400000, 200000][s + 1] + x * 100 + 50 WHEN 1 THEN 300000 + x * 100 + 50 WHEN 2 THEN 500000 + x * 100 WHEN 3 THEN 300000 + x * 100 ELSE 200000 + x // 100 * 10000 + 5000 END AS east,
  CASE k WHEN 0 THEN [100000, 500000, 300000][s + 1] + y * 100 + 50 WHEN 1 THEN 100000 + y * 100 + 50 WHEN 2 THEN 600000 + y * 100 WHEN 3 THEN 200000 + y * 100 ELSE 200000 + y // 100 * 10000 + 5000 END AS north FROM p),
r AS (SELECT *, 1 - b * b / (a * a) AS e2, (a - b) / (a + b) AS n, radians(lat0) AS f FROM q JOIN g USING (grid)),
m AS (SELECT *, e2 / (1 - e2) AS ep, (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) AS m1 FROM r),
u AS (SELECT *, (a * (m1 * f - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * f) + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * f) - 35 * e2 ** 3 / 3072 * sin(6 * f)) + (north - n0) / k0) / (a * m1) AS mu FROM m),
v AS (SELECT *, mu + (3 * n / 2 - 27 * n ** 3 / 32) * sin(2 * mu) + (21 * n ** 2 / 16 - 55 * n ** 4 / 32) * sin(4 * mu) + 151 * n ** 3 / 96 * sin(6 * mu) AS f1 FROM u),
w AS (SELECT *, a / sqrt(1 - e2 * sin(f1) ** 2) AS n1, tan(f1) ** 2 AS t, ep * cos(f1) ** 2 AS c, a * (1 - e2) / (1 - e2 * sin(f1) ** 2) ** 1.5 AS r1 FROM v),
d AS (SELECT *, (east - e0) / (n1 * k0) AS d FROM w),
h AS (SELECT *, f1 - n1 * tan(f1) / r1 * (d ** 2 / 2 - (5 + 3 * t + 10 * c - 4 * c ** 2 - 9 * ep) * d ** 4 / 24 + (61 + 90 * t + 298 * c + 45 * t ** 2 - 252 * ep - 3 * c ** 2) * d ** 6 / 720) AS la,
  radians(lon0) + (d - (1 + 2 * t + c) * d ** 3 / 6 + (5 - 2 * c + 28 * t - 3 * c ** 2 + 8 * ep + 24 * t ** 2) * d ** 5 / 120) / cos(f1) AS lo FROM d),
o AS (SELECT *, a / sqrt(1 - e2 * sin(la) ** 2) AS nu, radians(rx / 3600) AS qx, radians(ry / 3600) AS qy, radians(rz / 3600) AS qz, 1 + ppm * 1e-6 AS sc FROM h),
xyz AS (SELECT *, nu * cos(la) * cos(lo) AS x0, nu * cos(la) * sin(lo) AS y0, nu * (1 - e2) * sin(la) AS z0 FROM o),
wgs AS (SELECT s_suppkey, k, tx + sc * x0 - qz * y0 + qy * z0 AS x, ty + qz * x0 + sc * y0 - qx * z0 AS y, tz - qy * x0 + qx * y0 + sc * z0 AS z, 0.0066943799901413165::DOUBLE AS e FROM xyz),
l0 AS (SELECT *, sqrt(x * x + y * y) AS flat, atan2(z, sqrt(x * x + y * y) * (1 - e)) AS b0 FROM wgs),
l1 AS (SELECT *, atan2(z + e * 6378137 / sqrt(1 - e * sin(b0) ** 2) * sin(b0), flat) AS b1 FROM l0),
l2 AS (SELECT *, atan2(z + e * 6378137 / sqrt(1 - e * sin(b1) ** 2) * sin(b1), flat) AS b2 FROM l1)
SELECT s_suppkey, round(degrees(b2), 4) AS lat, round(degrees(atan2(y, x)), 4) AS lon, CASE WHEN k = 4 THEN 'hint' ELSE 'grid reference' END AS basis FROM l2"""


@query("pj02_grid_references", GRID_SQL)
def pj02(spark, sf):
    k, x, y = c("s_suppkey") % 5, c("s_suppkey") * 37 % 1000, c("s_suppkey") * 91 % 1000
    letters = F.element_at(F.array(F.lit("TQ"), F.lit("NZ"), F.lit("SH")), (c("s_suppkey") % 3 + 1).cast("int"))
    said = (
        F.when(k == 0, F.format_string("Permit W0123, grid ref. %s %03d %03d", letters, x, y))
        .when(k == 1, F.format_string("T%03d%03d, at the quay", x, y))
        .when(k == 2, F.format_string("ITM N %d, E %d", 600000 + y * 100, 500000 + x * 100))
        .when(k == 3, F.format_string("Easting:  %d\nNorthing: %d", 300000 + x * 100, 200000 + y * 100))
        .otherwise(F.format_string("square N%d%d", F.floor(x / 100), F.floor(y / 100)))
    )
    country = F.when(k.isin(0, 3), "GBR").when(k == 1, "irl").when(k == 2, "FRA").otherwise(F.lit(None).cast("string"))
    found = grids.grid_reference(said, country)
    rows = table(spark, sf, "supplier").select("s_suppkey", found.alias("p"))
    return rows.select("s_suppkey", F.round("p.lat", 4).alias("lat"), F.round("p.lon", 4).alias("lon"), "p.basis")
