"""Citations, pairs, upserts, re-keying, selection and metrics."""

from pyspark.sql import Window, functions as F

from ..functions import links, text
from ..operators import metrics, pairs, selecting, upsert
from . import views  # noqa: F401
from .registry import query, table
from .scalars import URL_FROM, URL_KEY

c = F.col

CITED = f"""ct AS (SELECT site_id, ord, latitude, longitude, {URL_KEY} AS page, trim(regexp_replace(lower(facility_name), '[^a-z0-9]+', ' ', 'g')) AS name, 1 + source_index % 5 AS tier, latitude IS NOT NULL AND source_index % 2 = 0 AS placed, latitude IS NOT NULL AS rough FROM {URL_FROM.replace("{src}", "{fx_citations}")})"""


def cited(spark, sf):
    rows = table(spark, sf, "fx_citations")
    return rows.select("site_id", "ord", "latitude", "longitude", links.url_key(c("url")).alias("page"), pairs.plain(c("facility_name")).alias("name"), (1 + c("source_index") % 5).alias("tier"), (c("latitude").isNotNull() & (c("source_index") % 2 == 0)).alias("placed"), c("latitude").isNotNull().alias("rough"))


@query("ag03_sources_registry", f"WITH {CITED}, f AS (SELECT page, name AS title, tier FROM ct QUALIFY row_number() OVER (PARTITION BY page ORDER BY ord, name, tier) = 1) SELECT page AS source, title, tier, count(*) AS times_cited, count(DISTINCT site_id) AS sites FROM ct JOIN f USING (page) GROUP BY page, title, f.tier".replace("title, tier, count", "title, f.tier AS tier, count"))
def ag03(spark, sf):
    return pairs.sources_registry(cited(spark, sf).withColumnsRenamed({"page": "source", "name": "title"}))


@query("ag04_site_source_pairs", f"""WITH {CITED}, r AS (SELECT site_id, page, name, tier, ord FROM ct QUALIFY row_number() OVER (PARTITION BY site_id, page, name ORDER BY tier, ord) = 1),
  p AS (SELECT site_id, page, name, ord FROM ct QUALIFY row_number() OVER (PARTITION BY site_id, page, name ORDER BY NOT placed, NOT rough, ord) = 1)
  SELECT site_id, page, name, 'rev-' || site_id || '-' || substr(sha256(page || '|' || name), 1, 12) AS review_id, r.tier, r.ord AS rated_by, p.ord AS placed_by, (SELECT count(*) FROM ct WHERE ct.site_id = r.site_id AND ct.page = r.page AND ct.name = r.name) AS cited FROM r JOIN p USING (site_id, page, name)""")
def ag04(spark, sf):
    return pairs.site_source_pairs(cited(spark, sf)).drop("latitude", "longitude")


@query("ag05_shared_pages", f"WITH {CITED}, d AS (SELECT DISTINCT site_id, page, name FROM ct), g AS (SELECT page, name, count(*) AS n, min(site_id) AS a, max(site_id) AS z FROM d GROUP BY ALL HAVING count(*) > 1) SELECT site_id, page, name, n - 1 AS others, CASE WHEN a = site_id THEN z ELSE a END AS other_site FROM d JOIN g USING (page, name)")
def ag05(spark, sf):
    return pairs.shared_pages(cited(spark, sf).select("site_id", "page", "name").distinct())


@query("ag06_pair_distance", f"""WITH {CITED}, p AS (SELECT site_id, page, name, latitude AS la, longitude AS lo FROM ct QUALIFY row_number() OVER (PARTITION BY site_id, page, name ORDER BY NOT placed, NOT rough, ord, latitude, longitude) = 1),
  m AS (SELECT p.*, 2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(la - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(la)) * pow(sin(radians(lo - longitude) / 2), 2), 1.0))) AS km FROM p JOIN {{fx_sites}} s USING (site_id))
  SELECT site_id, page, name, round(km, 4) AS km, concat_ws(',', CASE WHEN km > 5 THEN 'far' END, CASE WHEN name = '' THEN 'no name' END, CASE WHEN la IS NULL THEN 'no place' END) AS flags FROM m""")
def ag06(spark, sf):
    return pairs.measured(pairs.site_source_pairs(cited(spark, sf)), table(spark, sf, "fx_sites")).select("site_id", "page", "name", F.round("km", 4).alias("km"), "flags")


@query("ag07_collapse", """WITH v AS (SELECT site_id, attribute, value, ord, tier > 3 AS weak, value_date, lower(value) AS cmp FROM {fx_values}),
  w AS (SELECT site_id, attribute, value, ord FROM v QUALIFY row_number() OVER (PARTITION BY site_id, attribute ORDER BY weak, -coalesce(split_part(value_date, '-', 1)::INT, 0), -coalesce(nullif(split_part(value_date, '-', 2), '')::INT, 0), -coalesce(nullif(split_part(value_date, '-', 3), '')::INT, 0), ord, value) = 1)
  SELECT site_id, attribute, w.value, w.ord, count(DISTINCT cmp) - 1 AS other_values FROM v JOIN w USING (site_id, attribute) GROUP BY site_id, attribute, w.value, w.ord""")
def ag07(spark, sf):
    from ..functions.dates import date_key

    key = date_key(c("value_date"))
    return pairs.collapsed(table(spark, sf, "fx_values"), ["site_id", "attribute"], [c("tier") > 3, -key["y"], -key["m"], -key["d"], c("ord"), c("value")], F.lower("value"))


@query("ag09_datasets_found", f"WITH {CITED} SELECT page, count(DISTINCT site_id) AS searches, count(DISTINCT nullif(name, '')) AS facilities, array_to_string(list_slice(list_sort(list_distinct(list(nullif(name, '')) FILTER (WHERE name <> ''))), 1, 12), '; ') AS names FROM ct GROUP BY page HAVING count(DISTINCT site_id) >= 3 OR count(DISTINCT nullif(name, '')) >= 2")
def ag09(spark, sf):
    return pairs.datasets_found(cited(spark, sf))


@query("ag13_run_cost", """WITH r AS (SELECT *, CASE WHEN starts_with(model, 'terra-2-mini') THEN 0.5 WHEN starts_with(model, 'terra-2') THEN 3.0 WHEN starts_with(model, 'terra') THEN 2.5 WHEN starts_with(model, 'luna') THEN 1.25 END AS price FROM {fx_runlog})
  SELECT pass_label, model, count(DISTINCT site_id) AS sites, sum(web_searches)::BIGINT AS searches, sum(input_tokens)::BIGINT AS input_tokens, CASE WHEN NOT bool_or(coalesce(input_tokens > 0, false) AND price IS NULL) THEN round(coalesce(sum(coalesce(input_tokens, 0) / 1e6 * price), 0) + sum(web_searches) * 14.0 / 1000, 6)::DOUBLE END AS dollars FROM r GROUP BY ALL""")
def ag13(spark, sf):
    return metrics.run_cost(table(spark, sf, "fx_runlog"), ["pass_label", "model"])


@query("ag14_one_row_per_site", "SELECT site_id, arg_min(pass_label, seq) AS pass_label, min(seq) AS seq, sum(web_searches)::BIGINT AS searches FROM {fx_runlog} GROUP BY site_id")
def ag14(spark, sf):
    return metrics.one_row_per_site(table(spark, sf, "fx_runlog"))


YIELD = "SELECT site_id, 'g' || (site_id % 3) AS grp, CASE WHEN site_id % 4 = 0 THEN 'named' WHEN site_id % 4 = 1 THEN 'generic' ELSE 'none' END AS cls, sum(web_searches)::BIGINT AS searches, count(*) FILTER (WHERE seq % 5 = 0 OR (site_id % 4 = 0 AND seq % 2 = 0)) AS found FROM {fx_runlog} GROUP BY site_id"


def yields(spark, sf):
    site = c("site_id")
    hit = (c("seq") % 5 == 0) | ((site % 4 == 0) & (c("seq") % 2 == 0))
    return table(spark, sf, "fx_runlog").groupBy("site_id").agg(F.sum("web_searches").alias("searches"), F.count_if(hit).alias("found")).withColumns({"grp": F.concat(F.lit("g"), (site % 3).cast("string")), "cls": F.when(site % 4 == 0, "named").when(site % 4 == 1, "generic").otherwise("none")})


@query("ag16_yield_summary", f"""WITH y AS ({YIELD}), e AS (SELECT grp, cls, count(*) AS sites, sum(found)::BIGINT AS found, sum(searches)::BIGINT AS searches, sum(found)::DOUBLE / nullif(sum(searches), 0) AS rate FROM y GROUP BY ALL)
  SELECT e.grp, e.cls, e.sites, e.found, e.searches, round(e.rate, 6) AS rate, round(e.rate / nullif(n.rate, 0), 6) AS ratio, CASE WHEN e.cls = 'named' THEN 'reference' WHEN e.sites < 30 THEN 'too few' WHEN e.rate < 0.5 * n.rate THEN 'skip' ELSE 'search' END AS verdict FROM e LEFT JOIN e n ON n.grp = e.grp AND n.cls = 'named'""")
def ag16(spark, sf):
    return metrics.yield_summary(yields(spark, sf), "named")


@query("ag17_forecast", f"""WITH y AS ({YIELD}), p AS (SELECT cls, sum(searches)::DOUBLE AS searches, count(*) AS sites FROM y WHERE cls <> 'none' GROUP BY cls), a AS (SELECT sum(searches) / sum(sites) AS every FROM p),
  b AS (SELECT country_key % 4 AS batch, CASE WHEN site_id % 4 = 0 THEN 'named' WHEN site_id % 4 = 1 THEN 'generic' ELSE 'none' END AS cls, count(*) AS sites FROM {{fx_sites}} GROUP BY ALL)
  SELECT batch, b.cls, b.sites, round(b.sites * coalesce(p.searches / p.sites, every), 6) AS searches, round(b.sites * coalesce(p.searches / p.sites, every) * 14.0 / 1000, 6) AS dollars FROM b LEFT JOIN p USING (cls), a""")
def ag17(spark, sf):
    per = yields(spark, sf).where("cls <> 'none'").groupBy("cls").agg(F.sum("searches").cast("double").alias("searches"), F.count("*").alias("sites"))
    site = c("site_id")
    counts = table(spark, sf, "fx_sites").groupBy((c("country_key") % 4).alias("batch"), F.when(site % 4 == 0, "named").when(site % 4 == 1, "generic").otherwise("none").alias("cls")).agg(F.count("*").alias("sites"))
    return metrics.forecast(counts, per)


@query("up03_run_log", "SELECT site_id, pass_label, max(seq) AS seq, sum(web_searches)::BIGINT AS web_searches, sum(input_tokens)::BIGINT AS input_tokens, arg_max(model, seq) FILTER (WHERE trim(model) <> '') AS model FROM {fx_runlog} GROUP BY ALL")
def up03(spark, sf):
    return upsert.run_log(table(spark, sf, "fx_runlog"), ["site_id", "pass_label"], ["web_searches", "input_tokens"])


@query("up04_link_upsert", """WITH p AS (SELECT url, status, 'old' AS t FROM {fx_links} WHERE hash_key % 3 <> 0), f AS (SELECT url, '200' AS status, 'new' AS t, hash_key % 2 = 0 AS text_only FROM {fx_links} WHERE hash_key % 3 <> 1)
  SELECT coalesce(p.url, f.url) AS url, CASE WHEN text_only AND p.status IS NOT NULL THEN p.status ELSE coalesce(f.status, p.status) END AS status, coalesce(f.t, p.t) AS text FROM p FULL JOIN f ON p.url = f.url""".replace("hash_key", "length(url)"))
def up04(spark, sf):
    rows = table(spark, sf, "fx_links").withColumn("k", F.length("url"))
    return upsert.links(rows.where("k % 3 <> 0").select("url", "status", F.lit("old").alias("text")), rows.where("k % 3 <> 1").select("url", F.lit("200").alias("status"), F.lit("new").alias("text"), (c("k") % 2 == 0).alias("text_only")))


@query("up05_location_cache", """WITH o AS (SELECT s_suppkey AS k, s_nationkey AS p, 1 AS d FROM supplier WHERE s_suppkey % 3 <> 0), n AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE s_nationkey + 1 END AS p, 2 AS d FROM supplier WHERE s_suppkey % 5 <> 0)
  SELECT coalesce(o.k, n.k) AS k, coalesce(n.p, o.p) AS p, CASE WHEN n.k IS NULL OR o.p IS NOT DISTINCT FROM n.p THEN o.d ELSE n.d END AS d FROM o FULL JOIN n ON o.k = n.k""")
def up05(spark, sf):
    s = table(spark, sf, "supplier")
    old = s.where("s_suppkey % 3 <> 0").select(c("s_suppkey").alias("k"), c("s_nationkey").alias("p"), F.lit(1).alias("d"))
    new = s.where("s_suppkey % 5 <> 0").select(c("s_suppkey").alias("k"), F.when(c("s_suppkey") % 2 == 0, c("s_nationkey")).otherwise(c("s_nationkey") + 1).alias("p"), F.lit(2).alias("d"))
    return upsert.keep_date_if_same(old, new, ["k"], ["p"], "d")


@query("up06_vocabulary_drift", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def up06(spark, sf):
    return upsert.unknown_words(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("up07_set_operations", "SELECT c_nationkey, 'left' AS side FROM (SELECT c_nationkey FROM customer WHERE c_custkey % 2 = 0 EXCEPT ALL SELECT c_nationkey FROM customer WHERE c_custkey % 3 = 0) UNION ALL SELECT c_nationkey, 'right' FROM (SELECT c_nationkey FROM customer WHERE c_custkey % 3 = 0 EXCEPT ALL SELECT c_nationkey FROM customer WHERE c_custkey % 2 = 0)")
def up07(spark, sf):
    rows = table(spark, sf, "customer")
    return upsert.different(rows.where("c_custkey % 2 = 0").select("c_nationkey"), rows.where("c_custkey % 3 = 0").select("c_nationkey"))


@query("up08_usable_response", "SELECT site_id, pass_label, seq, failed FROM (SELECT *, web_searches % 3 = 0 AS failed, row_number() OVER (PARTITION BY site_id, pass_label ORDER BY web_searches % 3 = 0, seq DESC) AS k FROM {fx_runlog}) WHERE k = 1")
def up08(spark, sf):
    return upsert.usable_response(table(spark, sf, "fx_runlog").withColumn("failed", c("web_searches") % 3 == 0), ["site_id", "pass_label"])


WINNERS = "win AS (SELECT site_id, attribute, value, tier FROM {fx_values} WHERE attribute IN ('facility_status', 'has_cover') QUALIFY row_number() OVER (PARTITION BY site_id, attribute ORDER BY tier, ord, value) = 1)"


@query("up02_refresh_seed", f"WITH {WINNERS} SELECT s.site_id, coalesce(a.value, s.facility_status) AS facility_status, b.value AS has_cover, concat_ws('; ', 'facility_status@Tier ' || a.tier, 'has_cover@Tier ' || b.tier) AS stamps FROM {{fx_sites}} s LEFT JOIN win a ON a.site_id = s.site_id AND a.attribute = 'facility_status' LEFT JOIN win b ON b.site_id = s.site_id AND b.attribute = 'has_cover'")
def up02(spark, sf):
    rows = table(spark, sf, "fx_values").where("attribute IN ('facility_status', 'has_cover')")
    winners = rows.groupBy("site_id", "attribute").agg(F.min(F.struct("tier", "ord", "value")).alias("w")).select("site_id", "attribute", "w.value", "w.tier")
    return upsert.refreshed(table(spark, sf, "fx_sites").select("site_id", "facility_status"), winners, ["facility_status", "has_cover"])


MAPPED = """m0 AS (SELECT old_id, count(*) AS n, count(new_id) AS linked, min(new_id) AS lo, max(new_id) AS hi FROM (SELECT DISTINCT * FROM {fx_crosswalk}) GROUP BY old_id),
  m1 AS (SELECT old_id, CASE WHEN linked = 0 THEN 'unmapped' WHEN lo <> hi THEN 'split' WHEN linked < n THEN 'partly' ELSE 'mapped' END AS status, CASE WHEN lo = hi THEN lo END AS new_id FROM m0),
  mapping AS (SELECT old_id, CASE WHEN new_id IS NOT NULL AND count(*) OVER (PARTITION BY new_id) > 1 THEN 'merged' ELSE status END AS status, new_id FROM m1)"""


@query("jn18_map_old_ids", f"WITH {MAPPED} SELECT * FROM mapping")
def jn18(spark, sf):
    return upsert.map_ids(table(spark, sf, "fx_crosswalk"))


@query("jn20_apply_mapping", f"WITH {MAPPED} SELECT new_id AS old_id, data_source, record FROM (SELECT DISTINCT old_id, data_source, record FROM {{fx_crosswalk}}) x JOIN mapping USING (old_id) WHERE status = 'mapped'")
def jn20(spark, sf):
    rows = table(spark, sf, "fx_crosswalk")
    return upsert.rekeyed(rows.select("old_id", "data_source", "record").distinct(), upsert.map_ids(rows), "old_id")


@query("jn19_ids_by_place", "SELECT place, id, count(*) AS n FROM (SELECT 'orders' AS place, o_custkey AS id FROM orders UNION ALL SELECT 'customer', c_custkey FROM customer) GROUP BY ALL")
def jn19(spark, sf):
    a = table(spark, sf, "orders").select(F.lit("orders").alias("place"), c("o_custkey").alias("id"))
    b = table(spark, sf, "customer").select(F.lit("customer").alias("place"), c("c_custkey").alias("id"))
    return a.unionByName(b).groupBy("place", "id").agg(F.count("*").alias("n"))


@query("jn10_link_verdicts", "SELECT ord, coalesce(resolved_url, url) AS url, status FROM {fx_citations} LEFT JOIN {fx_links} USING (url)")
def jn10(spark, sf):
    return table(spark, sf, "fx_citations").join(table(spark, sf, "fx_links"), "url", "left").select("ord", F.coalesce("resolved_url", "url").alias("url"), "status")


@query("sel01_choose_sites", """SELECT site_id FROM {fx_sites} WHERE country_key NOT IN (7, 9) AND coalesce(facility_type, '') <> 'BUILDING' AND area_square_meters / 1e4 >= 20 AND NOT (facility_type IS NOT NULL AND coalesce(trim(facility_status), '') <> '' AND waste_in_place IS NOT NULL) ORDER BY site_id LIMIT 200""")
def sel01(spark, sf):
    sites = table(spark, sf, "fx_sites").where("country_key NOT IN (7, 9) AND coalesce(facility_type, '') <> 'BUILDING' AND area_square_meters / 1e4 >= 20")
    asked = text.is_empty(c("facility_type")) | text.is_empty(c("facility_status")) | c("waste_in_place").isNull()
    return sites.where(asked).select("site_id").orderBy("site_id").limit(200)


@query("sel04_skip_ledger", "SELECT site_id, reason FROM (SELECT site_id, pass_label AS reason, row_number() OVER (PARTITION BY site_id ORDER BY seq DESC) AS k FROM {fx_runlog}) WHERE k = 1 AND site_id NOT IN (SELECT user_id FROM events WHERE event_id % 50 = 0)")
def sel04(spark, sf):
    rows = table(spark, sf, "fx_runlog")
    searched = rows.where("seq % 50 = 0").select("site_id").distinct()
    return rows.groupBy("site_id").agg(F.max_by("pass_label", "seq").alias("reason")).join(searched, "site_id", "left_anti")


@query("sel09_urls_to_fetch", "SELECT DISTINCT url FROM {fx_citations} WHERE url NOT LIKE '%.maptons.com' AND url NOT IN (SELECT url FROM {fx_links} WHERE status = '200')")
def sel09(spark, sf):
    done = table(spark, sf, "fx_links").where("status = '200'").select("url")
    return table(spark, sf, "fx_citations").select("url").distinct().where(links.of_site(c("url"), links.MIRRORS).isNull()).join(done, "url", "left_anti")


@query("sel10_retry_worklist", "SELECT pass_label, string_agg(site_id::VARCHAR, ',' ORDER BY site_id::VARCHAR) AS sites FROM (SELECT DISTINCT site_id, pass_label FROM {fx_runlog} r WHERE input_tokens IS NULL AND NOT EXISTS (SELECT 1 FROM {fx_runlog} d WHERE d.site_id = r.site_id AND d.pass_label = r.pass_label AND d.web_searches > 4)) GROUP BY pass_label")
def sel10(spark, sf):
    rows = table(spark, sf, "fx_runlog")
    failed = rows.where("input_tokens IS NULL").select("site_id", "pass_label").distinct().join(rows.where("web_searches > 4").select("site_id", "pass_label"), ["site_id", "pass_label"], "left_anti")
    return selecting.listed(failed, "pass_label", "site_id", "sites")
