"""Seed, joins, selection and resolution."""

from pyspark.sql import Window, functions as F

from ..functions import dates, geo, text
from ..operators import resolve, seed, spatial
from . import views  # noqa: F401
from .registry import query, table

c = F.col


@query("res1_pick_values", """WITH r AS (SELECT l_partkey, year(l_shipdate)::INT AS year, l_quantity, l_suppkey, 1 + l_suppkey % 5 AS tier, l_shipdate, l_orderkey * 10 + l_linenumber AS ord FROM lineitem),
  n AS (SELECT l_partkey, year, l_quantity, count(DISTINCT l_suppkey) AS n_sources FROM r GROUP BY ALL)
  SELECT l_partkey, year, l_quantity, tier, ord, n_sources FROM (SELECT r.*, n_sources, row_number() OVER (PARTITION BY r.l_partkey, r.year ORDER BY tier, l_shipdate DESC, n_sources DESC, ord, l_quantity) AS k FROM r JOIN n USING (l_partkey, year, l_quantity)) WHERE k = 1""")
def res1(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"), "l_quantity", "l_suppkey", (1 + c("l_suppkey") % 5).alias("tier"), "l_shipdate", (c("l_orderkey") * 10 + c("l_linenumber")).alias("ord"))
    return resolve.pick_values(rows, ["l_partkey", "year"], tier="tier", date="l_shipdate", value="l_quantity", source="l_suppkey", order=["ord"]).select("l_partkey", "year", "l_quantity", "tier", "ord", "n_sources")


RES2 = """WITH ev AS (SELECT l_partkey AS k, l_returnflag AS value, 1 + l_suppkey % 5 AS tier, l_shipdate AS date, year(l_shipdate) AS year, l_suppkey AS source, l_orderkey * 10 + l_linenumber AS ord FROM lineitem),
  held AS (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS held, (1 + p_partkey % 5) AS held_tier, 1992 + p_partkey % 4 AS held_year FROM (SELECT p_partkey FROM part UNION ALL SELECT -p_partkey FROM part)),
  j AS (SELECT ev.*, held FROM ev LEFT JOIN held USING (k) WHERE held IS NULL OR tier <= 3),
  n AS (SELECT k, value, count(DISTINCT source) AS agree FROM j GROUP BY ALL),
  w AS (SELECT * FROM (SELECT j.*, agree, row_number() OVER (PARTITION BY k ORDER BY tier, date DESC, agree DESC, ord, value) AS r FROM j JOIN n USING (k, value)) WHERE r = 1),
  late AS (SELECT * FROM (SELECT j.k, j.value, j.tier, j.year, w.value AS wv, row_number() OVER (PARTITION BY j.k ORDER BY j.date DESC, j.tier, n.agree DESC, j.ord, j.value) AS r FROM j JOIN w ON j.k = w.k JOIN n ON n.k = j.k AND n.value = j.value WHERE j.tier > w.tier AND j.tier <= 3 AND j.year >= w.year + 3) WHERE r = 1 AND value <> wv),
  f AS (SELECT w.k, coalesce(late.value, w.value) AS value, coalesce(late.tier, w.tier) AS tier, coalesce(late.year, w.year) AS year FROM w LEFT JOIN late USING (k)),
  t AS (SELECT k, sum(agree) AS total FROM n GROUP BY k), weak AS (SELECT k, min(tier) AS best FROM ev GROUP BY k)
  SELECT coalesce(weak.k, held.k) AS k, held, f.value, f.tier, coalesce(agree, 0)::BIGINT AS agree, coalesce(total - agree, 0)::BIGINT AS dissent, held_tier - f.tier AS margin,
    CASE WHEN weak.k IS NULL THEN 'Not found' WHEN held IS NULL THEN 'Filled empty baseline' WHEN f.value = held THEN 'Confirmed baseline' WHEN coalesce(f.tier, best) < held_tier AND coalesce(f.tier, best) <= 2 THEN 'Overrides baseline'
      WHEN coalesce(f.tier, best) <= held_tier THEN 'Conflict - needs review' WHEN f.year >= held_year + 3 AND f.tier <= 3 THEN 'Overrides baseline' ELSE 'Conflict - lower credibility' END AS outcome
  FROM weak FULL JOIN held ON weak.k = held.k LEFT JOIN f ON f.k = weak.k LEFT JOIN n ON n.k = f.k AND n.value = f.value LEFT JOIN t ON t.k = f.k"""


@query("res2_arbitrate", RES2)
def res2(spark, sf):
    li = table(spark, sf, "lineitem")
    ev = li.select(c("l_partkey").alias("k"), c("l_returnflag").alias("value"), (1 + c("l_suppkey") % 5).alias("tier"), c("l_shipdate").alias("date"), F.year("l_shipdate").alias("year"), c("l_suppkey").alias("source"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("ord"))
    # the negative keys have no lines: nothing is found for them
    keys = table(spark, sf, "part").select(F.explode(F.array("p_partkey", -c("p_partkey"))).alias("p_partkey"))
    part = keys.select(c("p_partkey").alias("k"), F.expr("CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END").alias("held"), (1 + c("p_partkey") % 5).alias("held_tier"), (1992 + c("p_partkey") % 4).alias("held_year"))
    return resolve.arbitrate(ev, part, ["k"], recent=True)


@query("res3_best_source", "SELECT response_id, tier, ord, url FROM (SELECT *, row_number() OVER (PARTITION BY response_id ORDER BY tier, ord, url) AS k FROM (SELECT *, 1 + source_index % 5 AS tier FROM {fx_citations} WHERE url IS NOT NULL)) WHERE k = 1")
def res3(spark, sf):
    return resolve.best_source(table(spark, sf, "fx_citations").withColumn("tier", 1 + c("source_index") % 5), ["response_id"], "tier", "ord", "url")


@query("ag01_fold_years", """WITH y AS (SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY year DESC, ord) AS k FROM {fx_facility_years}),
  top AS (SELECT facility_id, max(year) AS reference_year, min(year) AS first_year, count(*) AS n_rows FROM y GROUP BY facility_id),
  st AS (SELECT facility_id, status FROM y WHERE status IS NOT NULL AND trim(status) <> '' QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY k) = 1),
  pr AS (SELECT facility_id, priority, year FROM y WHERE priority IS NOT NULL QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY k) = 1),
  pc AS (SELECT facility_id, price, year FROM y WHERE price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY k) = 1)
  SELECT top.*, status, priority, price, concat_ws('; ', CASE WHEN pr.year < reference_year THEN 'priority@' || pr.year END, CASE WHEN pc.year < reference_year THEN 'price@' || pc.year END) AS backfilled_fields
  FROM top LEFT JOIN st USING (facility_id) LEFT JOIN pr USING (facility_id) LEFT JOIN pc USING (facility_id)""")
def ag01(spark, sf):
    return seed.fold_years(table(spark, sf, "fx_facility_years"), "facility_id", identity=["status"], varying={"priority": "string", "price": "double"})


@query("ag02_seed_projection", "SELECT facility_id AS site_id, max(year) AS reference_year, count(*) AS n_years, 'facility ' || facility_id AS site_name FROM {fx_facility_years} GROUP BY facility_id")
def ag02(spark, sf):
    folded = seed.fold_years(table(spark, sf, "fx_facility_years"), "facility_id", identity=[], varying={})
    return folded.select(c("facility_id").alias("site_id"), "reference_year", c("n_rows").alias("n_years"), F.concat(F.lit("facility "), c("facility_id").cast("string")).alias("site_name"))


@query("jn01_attribute_sources", """WITH s AS (SELECT DISTINCT facility_id FROM {fx_facility_years}), r AS (SELECT facility_id, max(year) AS y FROM {fx_facility_years} GROUP BY 1),
  d AS (SELECT facility_id, year, 'dated_' || (min(ord) % 5) AS dataset FROM {fx_facility_years} WHERE price IS NOT NULL GROUP BY 1, 2)
  SELECT s.facility_id, concat_ws('; ', CASE WHEN s.facility_id % 2 = 0 THEN 'status@static_' || (s.facility_id % 3) END, CASE WHEN s.facility_id % 4 = 0 THEN 'price@static_p' WHEN d.dataset IS NOT NULL THEN 'price@' || d.dataset END) AS attribute_sources
  FROM s JOIN r USING (facility_id) LEFT JOIN d ON d.facility_id = s.facility_id AND d.year = r.y""")
def jn01(spark, sf):
    rows = table(spark, sf, "fx_facility_years")
    sites = rows.groupBy("facility_id").agg(F.max("year").alias("y"))
    static = sites.where("facility_id % 2 = 0").select("facility_id", F.lit("status").alias("attribute"), F.concat(F.lit("static_"), (c("facility_id") % 3).cast("string")).alias("dataset"))
    static = static.unionByName(sites.where("facility_id % 4 = 0").select("facility_id", F.lit("price").alias("attribute"), F.lit("static_p").alias("dataset")))
    dated = rows.where("price IS NOT NULL").groupBy("facility_id", "year").agg(F.concat(F.lit("dated_"), (F.min("ord") % 5).cast("string")).alias("dataset")).withColumn("attribute", F.lit("price"))
    return seed.attribute_sources(sites, static, dated, "facility_id", ["status", "price"], {"status": c("y"), "price": c("y")})


@query("jn02_name_provenance", """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority = '1-URGENT' DESC, o_orderstatus, o_orderkey) AS k FROM orders) WHERE k = 1""")
def jn02(spark, sf):
    return seed.first_by(table(spark, sf, "orders"), ["o_custkey"], [(c("o_orderpriority") == "1-URGENT").desc(), c("o_orderstatus"), c("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("jn03_municipality_codes", "SELECT c_custkey, n_name AS municipality, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_custkey % 3 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey")
def jn03(spark, sf):
    codes = table(spark, sf, "nation").dropDuplicates(["n_nationkey"]).join(F.broadcast(table(spark, sf, "region").dropDuplicates(["r_regionkey"])), c("n_regionkey") == c("r_regionkey"))
    code = F.when(c("c_custkey") % 3 != 0, c("c_nationkey"))
    return table(spark, sf, "customer").join(codes, code == c("n_nationkey"), "left").select("c_custkey", c("n_name").alias("municipality"), c("r_name").alias("region"))


PLACES = """p AS (SELECT site_id, NULL::VARCHAR AS coord_key, 'town ' || site_id AS municipality, CASE WHEN site_id % 4 = 0 THEN ' ' ELSE 'state' END AS admin1 FROM {fx_sites} WHERE site_id % 2 = 0),
  q AS (SELECT k AS coord_key, 'near ' || min(site_id) AS municipality, '' AS admin1 FROM (SELECT site_id, CASE WHEN longitude BETWEEN -180 AND 180 THEN printf('%.3f', latitude) || ',' || printf('%.3f', longitude) END AS k FROM {fx_sites}) WHERE site_id % 3 = 0 AND k IS NOT NULL GROUP BY k),
  s AS (SELECT site_id, municipality, admin1, CASE WHEN longitude BETWEEN -180 AND 180 THEN printf('%.3f', latitude) || ',' || printf('%.3f', longitude) END AS coord_key FROM {fx_sites})"""


def place_cache(spark, sf):
    sites = table(spark, sf, "fx_sites").withColumn("coord_key", geo.coord_key(c("latitude"), c("longitude"), 3))
    by_site = sites.where("site_id % 2 = 0").select("site_id", F.lit(None).cast("string").alias("coord_key"), F.expr("'town ' || site_id").alias("municipality"), F.expr("CASE WHEN site_id % 4 = 0 THEN ' ' ELSE 'state' END").alias("admin1"))
    by_point = sites.where("site_id % 3 = 0").groupBy("coord_key").agg(F.expr("'near ' || min(site_id)").alias("municipality")).select(F.lit(None).cast("long").alias("site_id"), "coord_key", "municipality", F.lit("").alias("admin1"))
    return sites.select("site_id", "municipality", "admin1", "coord_key"), by_site.unionByName(by_point)


@query("jn04_place_lookup", f"WITH {PLACES} SELECT s.site_id, coalesce(nullif(trim(p.municipality), ''), q.municipality, s.municipality) AS municipality, coalesce(nullif(trim(p.admin1), ''), s.admin1) AS admin1, CASE WHEN p.site_id IS NULL AND q.coord_key IS NULL THEN 'miss' ELSE 'hit' END AS lookup FROM s LEFT JOIN p USING (site_id) LEFT JOIN q ON q.coord_key = s.coord_key")
def jn04(spark, sf):
    return seed.with_cached_places(*place_cache(spark, sf), ["municipality", "admin1"]).select("site_id", "municipality", "admin1", "lookup")


@query("jn06_places_to_look_up", f"WITH {PLACES} SELECT s.coord_key, min(s.site_id) AS site_id FROM s WHERE s.site_id % 2 <> 0 AND s.coord_key IS NOT NULL AND s.coord_key NOT IN (SELECT coord_key FROM q) GROUP BY s.coord_key")
def jn06(spark, sf):
    return seed.misses(*place_cache(spark, sf))


KM = "2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2), 1.0)))"


def others(sites):
    return sites.select(c("site_id").alias("other_id"), c("country_key").alias("other_country"), c("latitude").alias("other_latitude"), c("longitude").alias("other_longitude"), c("municipality").alias("other_municipality"), c("admin1").alias("other_admin1"), c("area_square_meters").alias("area"))


@query("jn07_other_sites", f"""WITH p AS (SELECT a.site_id, b.site_id AS o, {KM} AS km, coalesce(a.municipality = b.municipality AND a.admin1 = b.admin1, false) AS town FROM {{fx_sites}} a JOIN {{fx_sites}} b ON a.country_key = b.country_key AND a.site_id <> b.site_id),
  k AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY km, o) AS n FROM p WHERE km <= 15 OR (km <= 60 AND town))
  SELECT site_id, string_agg(o::VARCHAR, ',' ORDER BY n) FILTER (WHERE n <= 10) AS nearest, greatest(count(*) - 10, 0) AS more FROM k GROUP BY site_id""")
def jn07(spark, sf):
    return spatial.nearest_others(table(spark, sf, "fx_sites"), "site_id", "country_key", ["municipality", "admin1"], 15, 60, 10)


@query("jn08_within_edge", f"WITH p AS (SELECT a.site_id, b.site_id AS other_id, greatest({KM} - least(sqrt(b.area_square_meters / pi()) / 1000, 2.0), 0) AS km FROM {{fx_sites}} a JOIN {{fx_sites}} b ON a.site_id <> b.site_id) SELECT site_id, other_id, round(km, 6) AS km FROM p WHERE km <= 25")
def jn08(spark, sf):
    sites = table(spark, sf, "fx_sites")
    return spatial.all_near(sites, others(sites), "site_id", "other_id", 25, edge_area="area").select("site_id", "other_id", F.round("km", 6).alias("km"))


@query("jn09_nearest_site", f"""WITH a AS (SELECT s_suppkey AS k, -58.0 + (s_suppkey % 24) * 5 + (s_suppkey * 17 % 100) / 100.0 AS latitude, -170.0 + (s_suppkey % 23) * 15 + (s_suppkey * 29 % 100) / 100.0 AS longitude FROM supplier),
  p AS (SELECT a.k, b.site_id, greatest({KM} - least(sqrt(b.area_square_meters / pi()) / 1000, 2.0), 0) AS km FROM a, {{fx_sites}} b),
  w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY km, site_id) AS n FROM p WHERE km <= 1000) SELECT k, site_id, round(km, 6) AS km FROM w WHERE n = 1""")
def jn09(spark, sf):
    points = table(spark, sf, "supplier").select(c("s_suppkey").alias("k"), (F.lit(-58.0) + (c("s_suppkey") % 24) * 5 + (c("s_suppkey") * 17 % 100) / 100.0).alias("latitude"), (F.lit(-170.0) + (c("s_suppkey") % 23) * 15 + (c("s_suppkey") * 29 % 100) / 100.0).alias("longitude"))
    sites = others(table(spark, sf, "fx_sites")).withColumnRenamed("other_id", "site_id").select("site_id", "other_latitude", "other_longitude", "area")
    return spatial.nearest(points, sites, "k").select("k", "site_id", F.round("km", 6).alias("km"))


@query("jn14_held_for_year", """WITH s AS (SELECT site_id, waste_in_place AS v, reference_year AS r, nullif(regexp_extract(backfilled_fields, 'waste_in_place_metric_tonnes@(\\d+)', 1), '')::INT AS b, unnest([reference_year, reference_year - 5, 1985 + (site_id % 30)])::INT AS year FROM {fx_sites})
  SELECT site_id, year, CASE WHEN v IS NULL THEN 'as held' WHEN year = coalesce(b, r) THEN 'same year' WHEN year = r THEN 'nothing held' ELSE 'other year' END AS kind, CASE WHEN v IS NOT NULL AND year <> coalesce(b, r) AND year = r THEN NULL ELSE v END AS held FROM s""")
def jn14(spark, sf):
    back = dates.parse_year(F.try_element_at(text.provenance(c("backfilled_fields"), False), F.lit("waste_in_place_metric_tonnes")))
    rows = table(spark, sf, "fx_sites").withColumn("b", back).withColumn("year", F.explode(F.array(c("reference_year"), c("reference_year") - 5, (1985 + c("site_id") % 30).cast("int"))))
    held, kind = seed.held_for_year(c("waste_in_place"), c("reference_year"), c("b"), c("year"))
    return rows.select("site_id", "year", kind.alias("kind"), held.alias("held"))


@query("jn15_same_town", """SELECT a.site_id, string_agg(b.site_id::VARCHAR, ',' ORDER BY b.site_id) FILTER (WHERE b.k <= 3 OR (b.k = 4 AND a.k <= 3)) AS named FROM (SELECT *, row_number() OVER (PARTITION BY municipality, admin1 ORDER BY site_id) AS k FROM {fx_sites} WHERE municipality IS NOT NULL) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY municipality, admin1 ORDER BY site_id) AS k FROM {fx_sites} WHERE municipality IS NOT NULL) b ON a.municipality = b.municipality AND a.admin1 = b.admin1 AND a.site_id <> b.site_id GROUP BY a.site_id""")
def jn15(spark, sf):
    sites = table(spark, sf, "fx_sites").where("municipality IS NOT NULL")
    # only the first four of a town are ever named, so a large town stays small on the joined side
    first = sites.withColumn("k", F.row_number().over(Window.partitionBy("municipality", "admin1").orderBy("site_id"))).where("k <= 4")
    first = first.groupBy("municipality", "admin1").agg(F.array_sort(F.collect_list("site_id")).alias("ids"))
    named = F.slice(F.array_remove("ids", c("site_id")), 1, 3)
    return sites.join(first, ["municipality", "admin1"]).select("site_id", F.array_join(named.cast("array<string>"), ",").alias("named")).where("named <> ''")


@query("jn17_possible_duplicates", f"""WITH k AS (SELECT DISTINCT url, lower(facility_name) AS name, site_id FROM {{fx_citations}} WHERE facility_name <> ''),
  p AS (SELECT a.site_id AS a, b.site_id AS b, count(*) AS n, count(DISTINCT a.url) AS pages FROM k a JOIN k b ON a.url = b.url AND a.name = b.name AND a.site_id < b.site_id GROUP BY ALL HAVING count(*) > 1)
  SELECT p.a, p.b, n, pages, CASE WHEN {KM} <= 5 THEN 'one site twice' ELSE 'two sites, one source' END AS reading FROM p JOIN {{fx_sites}} a ON a.site_id = p.a JOIN {{fx_sites}} b ON b.site_id = p.b""")
def jn17(spark, sf):
    keys = table(spark, sf, "fx_citations").where("facility_name <> ''").select("url", F.lower("facility_name").alias("name"), "site_id").distinct()
    left, right = keys.withColumnRenamed("site_id", "a"), keys.withColumnRenamed("site_id", "b")
    pairs = left.join(right, ["url", "name"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"), F.count_distinct("url").alias("pages")).where("n > 1")
    place = table(spark, sf, "fx_sites").select("site_id", "latitude", "longitude")
    pairs = pairs.join(place.select(c("site_id").alias("a"), c("latitude").alias("la"), c("longitude").alias("lo")), "a").join(place.select(c("site_id").alias("b"), c("latitude").alias("lb"), c("longitude").alias("lp")), "b")
    return pairs.select("a", "b", "n", "pages", F.when(geo.haversine_km(c("la"), c("lo"), c("lb"), c("lp")) <= 5, "one site twice").otherwise("two sites, one source").alias("reading"))
