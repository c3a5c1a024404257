"""Names, pages, statuses and decisions."""

from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import pages as page_ops, pairs, resolve, review
from . import views  # noqa: F401
from .registry import VIEWS, query, table

c = F.col

VIEWS["fx_found"] = """
SELECT site_id, attribute, value, tier, ord, source_id, 'page' || CAST(source_id % 37 AS STRING) AS page, 'name' || CAST(site_id % 11 AS STRING) AS name, CAST(1990 + ord % 9 AS INT) AS year,
       'rev-' || CAST(site_id AS STRING) || '-' || CAST(source_id % 37 AS STRING) AS review_id, CASE WHEN ord % 13 = 0 THEN 'dead link' WHEN ord % 17 = 0 THEN 'empty' ELSE NULL END AS excluded, CASE WHEN site_id % 4 = 0 THEN NULL WHEN site_id % 4 = 1 THEN value ELSE 'ours' END AS held
FROM (SELECT site_id, CASE trim(attribute) WHEN 'area' THEN 'area_square_meters' ELSE trim(attribute) END AS attribute, value, tier, ord, source_id FROM {fx_values}) t
"""
VIEWS["fx_decisions"] = """
SELECT DISTINCT review_id, site_id, CASE (site_id * 7 + source_id % 37) % 10 WHEN 0 THEN 'correct' WHEN 1 THEN 'correct' WHEN 2 THEN 'correct' WHEN 3 THEN 'different' WHEN 4 THEN 'different' WHEN 5 THEN 'new' WHEN 6 THEN 'junk' WHEN 7 THEN 'maybe' ELSE '' END AS decision,
       CASE WHEN (site_id * 7 + source_id % 37) % 10 IN (3, 7) THEN site_id + 1 WHEN (site_id * 7 + source_id % 37) % 10 = 4 AND site_id % 5 = 0 THEN site_id ELSE NULL END AS other_site_id
FROM {fx_found}
"""

FOLD = "trim(regexp_replace(replace(lower(strip_accents(replace(t, 'ß', 'ss'))), '%', ' percent '), '[^a-z0-9]+', ' ', 'g'))"
CODE = "NOT (regexp_matches(w, '[a-z]') AND regexp_matches(w, '[0-9]') AND NOT regexp_matches(w, '^[0-9]+(st|nd|rd|th)$'))"
LISTED = ", ".join(f"'{w}'" for w in [*names.GENERIC, *names.COMPANY, "epr"])


@query("sc30_plain_text", f"SELECT doc_id, md5(k) AS h, length(k) AS n FROM (SELECT doc_id, {FOLD} AS k FROM (SELECT doc_id, text AS t FROM documents))")
def sc30(spark, sf):
    return table(spark, sf, "documents").select("doc_id", names.plain(c("text")).alias("k")).select("doc_id", F.md5("k").alias("h"), F.length("k").cast("long").alias("n"))


PART_WORDS = f"""pw AS (SELECT p_partkey, p_brand, list_sort(list_distinct(list_filter(list_transform(string_split({FOLD}, ' '), lambda w: CASE w WHEN 'lf' THEN 'landfill' WHEN 'slf' THEN 'landfill' WHEN 'msw' THEN 'waste' ELSE w END), lambda w: w <> '' AND w NOT IN ({LISTED}) AND {CODE}))) AS ws
  FROM (SELECT p_partkey, p_brand, p_name || CASE p_partkey % 4 WHEN 0 THEN ' Landfill Site' WHEN 1 THEN ' North EPR/BV7877IR' WHEN 2 THEN ' Cell ' || (p_partkey % 5) ELSE ' Ltd' END AS t FROM part))"""


def named_parts(spark, sf):
    tail = F.when(c("p_partkey") % 4 == 0, " Landfill Site").when(c("p_partkey") % 4 == 1, " North EPR/BV7877IR").when(c("p_partkey") % 4 == 2, F.concat(F.lit(" Cell "), (c("p_partkey") % 5).cast("string"))).otherwise(" Ltd")
    return table(spark, sf, "part").select("p_partkey", "p_brand", names.distinctive_words(F.concat("p_name", tail)).alias("ws"))


@query("sc31_distinctive_words", f"WITH {PART_WORDS} SELECT p_partkey, array_to_string(ws, ' ') AS words FROM pw")
def sc31(spark, sf):
    return named_parts(spark, sf).select("p_partkey", F.array_join("ws", " ").alias("words"))


@query("sc32_name_similarity")
def sc32(spark, sf):
    # candidates share a brand and a word, so that no brand is paired with itself in full
    return pairs.similar_names(named_parts(spark, sf), "p_partkey", "p_brand", "ws")


@query("sc33_same_operator", "SELECT s_suppkey, s_suppkey % 4 <> 3 AS same FROM supplier")
def sc33(spark, sf):
    name = c("s_name")
    other = F.when(c("s_suppkey") % 4 == 0, F.concat(F.lit("H. "), name, F.lit(" S.A."))).when(c("s_suppkey") % 4 == 1, F.upper(name)).when(c("s_suppkey") % 4 == 2, F.concat(name, F.lit(" de Servicios (SOS) 2024"))).otherwise(F.lit("Nobody else"))
    plain_sa = F.regexp_replace(other, r"\bS\.A\.", "SA")
    return table(spark, sf, "supplier").select("s_suppkey", names.same_operator(name, plain_sa).alias("same"))


@query("pj05_visible_text")
def pj05(spark, sf):
    return page_ops.page_texts(table(spark, sf, "pages"), "page_id", "html").select("page_id", F.length("text").cast("long").alias("n"), F.md5("text").alias("h"), "note")


@query("pj06_page_kind", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'pdf' ELSE 'html' END AS kind, length(html) < 1000 AND len(list_filter(string_split(html, chr(10)), lambda x: length(x) > 100)) = 0 AS menu FROM pages")
def pj06(spark, sf):
    body = F.when(c("page_id") % 3 == 0, F.lit("%PDF-1.7")).otherwise(c("html"))
    return table(spark, sf, "pages").select("page_id", page_ops.page_kind(body, c("url")).alias("kind"), page_ops.menu_only(c("html")).alias("menu"))


@query("pj07_quotes_on_pages", f"""WITH q AS (SELECT item_id, {FOLD} AS k FROM (SELECT item_id, text AS t FROM benchmark)), d AS (SELECT doc_id, {FOLD} AS k FROM (SELECT doc_id, text AS t FROM documents)),
  x AS MATERIALIZED (SELECT doc_id, item_id, q.k AS qk, d.k AS dk FROM d JOIN q ON d.doc_id % (SELECT count(*) FROM benchmark) = q.item_id),
  dw AS (SELECT DISTINCT doc_id, unnest(string_split(dk, ' ')) AS w FROM x), qw AS (SELECT doc_id, unnest(string_split(qk, ' ')) AS w FROM x),
  s AS (SELECT doc_id, avg((dw.w IS NOT NULL)::INT) FILTER (WHERE length(qw.w) > 2) AS share FROM qw LEFT JOIN dw USING (doc_id, w) GROUP BY doc_id)
  SELECT doc_id, item_id, CASE WHEN contains(' ' || dk || ' ', ' ' || qk || ' ') THEN 'found' WHEN share >= 0.8 THEN 'partly' ELSE 'not found' END AS result FROM x JOIN s USING (doc_id)""")
def pj07(spark, sf):
    quotes = table(spark, sf, "benchmark").select("item_id", c("text").alias("quote"))
    docs = table(spark, sf, "documents").select("doc_id", "text", (c("doc_id") % quotes.count()).alias("item_id"))
    asked = docs.select("doc_id", "item_id").join(quotes, "item_id")
    return page_ops.quote_results(asked, docs.select("doc_id", "text"), "doc_id").select("doc_id", "item_id", "result")


@query("res4_value_status", "SELECT ord, attribute, value, CASE WHEN excluded IS NULL AND attribute <> 'found_site_name' AND NOT (year < 1992) AND held IS NULL THEN 'review' ELSE 'not used' END AS status, CASE WHEN excluded IS NOT NULL THEN excluded WHEN attribute = 'found_site_name' THEN 'no longer asked' WHEN year < 1992 THEN 'planned year passed' WHEN held = value THEN 'confirms ours' WHEN held IS NOT NULL THEN 'would change ours' ELSE 'for review' END AS code FROM {fx_found}")
def res4(spark, sf):
    told, code = review.status(c("excluded"), c("attribute") == "found_site_name", c("year") < 1992, c("held"), c("value"))
    return table(spark, sf, "fx_found").select("ord", "attribute", "value", told.alias("status"), code.alias("code"))


@query("res5_needs_check", "SELECT ord, attribute, tier >= 3 AND attribute IN ('area_square_meters', 'annual_incoming_waste_metric_tonnes') AS check_it FROM {fx_found}")
def res5(spark, sf):
    return table(spark, sf, "fx_found").select("ord", "attribute", review.needs_check(c("attribute"), c("tier"), F.lit("Stated")).alias("check_it"))


@query("rev3_decision_faults", """SELECT DISTINCT review_id, unnest(list_filter([CASE WHEN decision = 'maybe' THEN 'unknown decision' END, CASE WHEN decision = 'different' AND other_site_id IS NULL THEN 'other site missing' END, CASE WHEN decision <> 'different' AND other_site_id IS NOT NULL THEN 'other site not wanted' END,
  CASE WHEN other_site_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = other_site_id) THEN 'other site unknown' END, CASE WHEN other_site_id = site_id THEN 'other site is itself' END], lambda x: x IS NOT NULL)) AS fault FROM {fx_decisions}""")
def rev3(spark, sf):
    return review.faults(table(spark, sf, "fx_decisions"), table(spark, sf, "customer").select(c("c_custkey").alias("site_id")))


HELD = "h AS (SELECT DISTINCT site_id, attribute FROM {fx_found} WHERE site_id % 3 = 0)"
GOES = f"""{HELD}, g AS (SELECT f.*, CASE WHEN decision = 'different' THEN other_site_id ELSE f.site_id END AS to_site, decision FROM {{fx_found}} f JOIN (SELECT * FROM {{fx_decisions}} WHERE decision IN ('correct', 'different')) d USING (review_id)),
  go AS (SELECT g.* FROM g LEFT JOIN h ON h.site_id = g.to_site AND h.attribute = g.attribute WHERE decision = 'correct' OR h.site_id IS NULL)"""


def going(spark, sf):
    found = table(spark, sf, "fx_found")
    return review.destinations(found, table(spark, sf, "fx_decisions"), found.where("site_id % 3 = 0").select("site_id", "attribute").distinct())


@query("rev6_destinations", f"WITH {GOES} SELECT ord, attribute, value, to_site, decision FROM go")
def rev6(spark, sf):
    return going(spark, sf).select("ord", "attribute", "value", "to_site", "decision")


@query("rev7_accepted_values", f"""WITH {GOES}, k AS (SELECT to_site, attribute, CASE WHEN attribute IN ('facility_status', 'annual_incoming_waste_metric_tonnes', 'cover_types') THEN year END AS for_year, value, tier, year, source_id, ord FROM go WHERE to_site IS NOT NULL),
  n AS (SELECT to_site, attribute, for_year, value, count(DISTINCT source_id) AS n_sources FROM k GROUP BY ALL)
  SELECT to_site, attribute, for_year, value, tier, n_sources, ord FROM (SELECT k.*, n_sources, row_number() OVER (PARTITION BY k.to_site, k.attribute, k.for_year ORDER BY tier, year DESC, n_sources DESC, ord, k.value) AS r FROM k JOIN n ON k.to_site = n.to_site AND k.attribute = n.attribute AND k.for_year IS NOT DISTINCT FROM n.for_year AND k.value = n.value) WHERE r = 1""")
def rev7(spark, sf):
    rows = going(spark, sf).where("to_site IS NOT NULL").withColumns({"for_year": review.decision_year(c("attribute"), c("year")), "at": F.make_date(c("year"), F.lit(1), F.lit(1))})
    return resolve.pick_values(rows, ["to_site", "attribute", "for_year"], tier="tier", date="at", value="value", source="source_id", order=["ord"]).select("to_site", "attribute", "for_year", "value", "tier", "n_sources", "ord")


@query("rev8_decision_counts", "SELECT decision, count(*) AS n FROM {fx_decisions} GROUP BY decision")
def rev8(spark, sf):
    return table(spark, sf, "fx_decisions").groupBy("decision").agg(F.count("*").alias("n"))


@query("rev9_new_sites", "WITH f AS (SELECT f.* FROM {fx_found} f JOIN (SELECT DISTINCT review_id FROM {fx_decisions} WHERE decision = 'new') USING (review_id)) SELECT 'new-' || substr(sha256(page || '|' || name), 1, 12) AS candidate_id, page, name, count(DISTINCT site_id) AS sites, min(ord) AS first FROM f GROUP BY page, name")
def rev9(spark, sf):
    return review.new_sites(table(spark, sf, "fx_found"), table(spark, sf, "fx_decisions"))


@query("jn13_site_names", "SELECT ord, attribute, value, coalesce(c_name, 'site ' || site_id) AS site_name FROM {fx_found} LEFT JOIN customer ON c_custkey = site_id AND c_custkey % 2 = 0")
def jn13(spark, sf):
    names_of = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(c("c_custkey").alias("site_id"), "c_name")
    return table(spark, sf, "fx_found").join(names_of, "site_id", "left").select("ord", "attribute", "value", F.coalesce("c_name", F.concat(F.lit("site "), c("site_id").cast("string"))).alias("site_name"))


@query("jn16_rival_values", "WITH n AS (SELECT site_id, attribute, count(DISTINCT value) AS n FROM {fx_found} GROUP BY ALL HAVING count(DISTINCT value) > 1) SELECT ord, attribute, value, n - 1 AS rivals FROM {fx_found} JOIN n USING (site_id, attribute)")
def jn16(spark, sf):
    return review.rivals(table(spark, sf, "fx_found"), ["site_id", "attribute"]).select("ord", "attribute", "value", "rivals")


@query("jn21_only_ids_changed", "WITH a AS (SELECT * EXCLUDE (site_id) FROM {fx_found}), b AS (SELECT * EXCLUDE (site_id) REPLACE (CASE WHEN ord % 97 = 0 THEN value || '!' ELSE value END AS value) FROM {fx_found} WHERE ord % 89 <> 0) SELECT attribute, count(*) AS differences FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY attribute")
def jn21(spark, sf):
    from ..operators.upsert import different

    rows = table(spark, sf, "fx_found")
    changed = F.when(c("ord") % 97 == 0, F.concat("value", F.lit("!"))).otherwise(c("value"))
    moved = rows.where("ord % 89 <> 0").withColumns({"site_id": c("site_id") + 1_000_000, "value": changed})
    return different(rows.drop("site_id"), moved.drop("site_id")).groupBy("attribute").agg(F.count("*").alias("differences"))


@query("ag08_closures", "SELECT site_id, string_agg(DISTINCT value, '; ' ORDER BY value) AS reported FROM {fx_found} WHERE attribute = 'facility_status' AND value = 'Closed' GROUP BY site_id")
def ag08(spark, sf):
    closed = table(spark, sf, "fx_found").where("attribute = 'facility_status' AND value = 'Closed'")
    return closed.groupBy("site_id").agg(F.array_join(F.array_sort(F.collect_set("value")), "; ").alias("reported"))


@query("ag10_contradictions", "SELECT site_id FROM (SELECT site_id, arg_max(value, (year, -ord, value)) FILTER (WHERE attribute = 'has_cover' AND value <> '') AS cover, arg_max(value, (year, -ord, value)) FILTER (WHERE attribute = 'cover_types' AND value <> '') AS kinds FROM {fx_found} GROUP BY site_id) WHERE lower(trim(cover)) = 'no' AND kinds IS NOT NULL")
def ag10(spark, sf):
    newest = lambda a: F.max_by("value", F.when((c("attribute") == a) & ~text.is_empty(c("value")), F.struct("year", (-c("ord")).alias("o"), "value")))
    any_of = lambda a: F.count_if((c("attribute") == a) & ~text.is_empty(c("value"))) > 0
    rows = table(spark, sf, "fx_found").groupBy("site_id").agg(F.when(any_of("has_cover"), newest("has_cover")).alias("cover"), F.when(any_of("cover_types"), newest("cover_types")).alias("kinds"))
    return rows.where(~text.tristate(c("cover")) & c("kinds").isNotNull()).select("site_id")


@query("ag12_run_statistics", "SELECT 'tier' AS setting, CASE WHEN tier <= 2 THEN 'Tier 1-2' ELSE 'Tier 3-5' END AS value, count(*) AS n FROM {fx_found} GROUP BY 2 UNION ALL SELECT 'excluded', excluded, count(*) FROM {fx_found} WHERE excluded IS NOT NULL GROUP BY 2")
def ag12(spark, sf):
    rows = table(spark, sf, "fx_found")
    settings = F.array_compact(F.array(F.struct(F.lit("tier").alias("setting"), F.when(c("tier") <= 2, "Tier 1-2").otherwise("Tier 3-5").alias("value")), F.when(c("excluded").isNotNull(), F.struct(F.lit("excluded").alias("setting"), c("excluded").alias("value")))))
    return rows.select(F.explode(settings).alias("s")).groupBy("s.setting", "s.value").agg(F.count("*").alias("n"))


@query("ag15_site_yield", "WITH l AS (SELECT site_id, sum(web_searches)::BIGINT AS searches FROM {fx_runlog} GROUP BY 1), f AS (SELECT site_id, count(*) AS values_found, count(DISTINCT attribute) AS attributes FROM {fx_found} WHERE excluded IS NULL GROUP BY 1) SELECT l.site_id, searches, coalesce(values_found, 0) AS values_found, coalesce(attributes, 0) AS attributes FROM l LEFT JOIN f USING (site_id)")
def ag15(spark, sf):
    log = table(spark, sf, "fx_runlog").groupBy("site_id").agg(F.sum("web_searches").alias("searches"))
    found = table(spark, sf, "fx_found").where("excluded IS NULL").groupBy("site_id").agg(F.count("*").alias("values_found"), F.count_distinct("attribute").alias("attributes"))
    return log.join(found, "site_id", "left").select("site_id", "searches", F.coalesce("values_found", F.lit(0)).alias("values_found"), F.coalesce("attributes", F.lit(0)).alias("attributes"))


@query("up01_mergeable_values", "SELECT site_id, attribute, value, year, tier, ord FROM (SELECT *, row_number() OVER (PARTITION BY site_id, attribute ORDER BY year DESC, tier, ord, value) AS k FROM {fx_found} WHERE excluded IS NULL) WHERE k = 1")
def up01(spark, sf):
    best = F.min_by(F.struct("value", "year", "tier", "ord"), F.struct((-c("year")).alias("y"), "tier", "ord", "value"))
    return table(spark, sf, "fx_found").where("excluded IS NULL").groupBy("site_id", "attribute").agg(best.alias("w")).select("site_id", "attribute", "w.*")


@query("sel11_loadable", "SELECT attribute, count(*) FILTER (WHERE excluded IS NULL AND held IS NULL) AS loadable, count(*) FILTER (WHERE excluded IS NULL AND held IS NOT NULL) AS set_aside FROM {fx_found} GROUP BY attribute")
def sel11(spark, sf):
    rows = table(spark, sf, "fx_found")
    return rows.groupBy("attribute").agg(F.count_if(c("excluded").isNull() & c("held").isNull()).alias("loadable"), F.count_if(c("excluded").isNull() & c("held").isNotNull()).alias("set_aside"))


@query("pj01_decimal_points", "SELECT s_suppkey, round(-58.0 + (s_suppkey % 24) * 5 + (s_suppkey * 17 % 1000) / 1000.0, 6) AS lat, round(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END * (s_suppkey % 170 + (s_suppkey * 29 % 1000) / 1000.0), 6) AS lon FROM supplier")
def pj01(spark, sf):
    from ..functions.points import decimal_point

    k = c("s_suppkey")
    lat, lon = F.lit(-58.0) + (k % 24) * 5 + (k * 17 % 1000) / 1000.0, (k % 170 + (k * 29 % 1000) / 1000.0)
    number = lambda x: F.format_string("%.3f", x)
    said = F.when(k % 3 == 0, F.concat(number(F.abs(lat)), F.when(lat < 0, "S").otherwise("N"), F.lit(", "), number(lon), F.when(k % 2 == 0, "E").otherwise("W"))).when(k % 3 == 1, F.concat(F.lit("lat "), number(lat), F.lit(" lon "), number(F.when(k % 2 == 0, lon).otherwise(-lon)))).otherwise(F.concat(F.lit("POINT("), number(F.when(k % 2 == 0, lon).otherwise(-lon)), F.lit(" "), number(lat), F.lit(")")))
    point = decimal_point(said)
    return table(spark, sf, "supplier").select("s_suppkey", F.round(point["lat"], 6).alias("lat"), F.round(point["lon"], 6).alias("lon"))


@query("sc17_single_coordinate", "SELECT s_suppkey, round(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END * (s_suppkey % 80 + (s_suppkey % 60) / 60.0 + 30 / 3600.0), 6) AS degrees FROM supplier")
def sc17(spark, sf):
    from ..functions.points import single_coordinate

    k = c("s_suppkey")
    said = F.concat((k % 80).cast("string"), F.lit("°"), (k % 60).cast("string"), F.lit("'30\""), F.when(k % 2 == 0, " N").otherwise(" S"))
    return table(spark, sf, "supplier").select("s_suppkey", F.round(single_coordinate(said), 6).alias("degrees"))
