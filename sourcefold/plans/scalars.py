"""Projections: normalising texts, links, tiers, dates, units and points."""

from pyspark.sql import functions as F

from ..functions import dates, geo, links, text, tiers, units
from ..sources import tables as files
from . import views  # noqa: F401
from .registry import query, table

c = F.col


def values(pairs: dict) -> str:
    return ", ".join(f"('{k}', {v!r})" for k, v in pairs.items())


TIERED = f"""tt(t, tier) AS (VALUES {values(tiers.TYPE_TIERS)}), et(t, new) AS (VALUES {values(tiers.EARLIER_TYPES)}), dt(t, tier) AS (VALUES {values(tiers.DATASET_TIERS)})"""


@query("sc01_canonical_text", "SELECT site_id, coalesce(trim(facility_status), '') AS status, lower(replace(trim(coalesce(contributing_data_sources, '')), ',', '')) AS datasets, CASE WHEN has_gas = 'TRUE' THEN 'TRUE' WHEN has_gas = 'FALSE' THEN 'FALSE' ELSE '' END AS gas FROM {fx_sites}")
def sc01(spark, sf):
    return table(spark, sf, "fx_sites").select("site_id", F.coalesce(F.trim("facility_status"), F.lit("")).alias("status"), text.comparable_text(c("contributing_data_sources")).alias("datasets"), F.coalesce(F.upper(text.tristate(c("has_gas")).cast("string")), F.lit("")).alias("gas"))


@query("sc02_emptiness", "SELECT facility_id, year, count(*) AS n, count(*) FILTER (WHERE status IS NULL OR trim(status) = '') AS no_status, count(*) FILTER (WHERE price IS NULL) AS no_price FROM {fx_facility_years} GROUP BY ALL")
def sc02(spark, sf):
    rows = table(spark, sf, "fx_facility_years")
    return rows.groupBy("facility_id", "year").agg(F.count("*").alias("n"), F.count_if(text.is_empty(c("status"))).alias("no_status"), F.count_if(text.is_empty(c("price"), "double")).alias("no_price"))


@query("sc03_tristate", """SELECT ord, CASE WHEN lower(trim(value)) IN ('yes','y','true','t','1') THEN true WHEN lower(trim(value)) IN ('no','n','false','f','0') THEN false END AS flag,
  lower(trim(value)) NOT IN ('yes','y','true','t','1','no','n','false','f','0','unknown','') AS unknown FROM {fx_values} WHERE attribute = 'has_cover'""")
def sc03(spark, sf):
    return table(spark, sf, "fx_values").where("attribute = 'has_cover'").select("ord", text.tristate(c("value")).alias("flag"), text.unknown_word(c("value")).alias("unknown"))


@query("sc05_list_items", """SELECT ord, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(regexp_replace(value, '[\\[\\]"]', '', 'g'), '[;,]'), lambda x: trim(x)), lambda x: x <> ''))), '|') AS items FROM {fx_values} WHERE attribute = 'cover_types'""")
def sc05(spark, sf):
    return table(spark, sf, "fx_values").where("attribute = 'cover_types'").select("ord", F.array_join(F.array_sort(text.list_items(c("value"))), "|").alias("items"))


@query("sc06_depth_band", """SELECT p_partkey, CASE WHEN lo <= 0 THEN NULL WHEN (lo <= 5) <> (hi <= 5) THEN NULL WHEN lo <= 5 THEN '<=5m' ELSE '>5m' END AS band,
  CASE WHEN lo <= 0 THEN 'not a measurement' WHEN (lo <= 5) <> (hi <= 5) THEN 'straddles' END AS reason FROM (SELECT p_partkey, p_size - 3 AS lo, p_size - 3 + p_partkey % 4 AS hi FROM part)""")
def sc06(spark, sf):
    low = (c("p_size") - 3).cast("double")
    band, reason = text.depth_band(low, low + c("p_partkey") % 4)
    return table(spark, sf, "part").select("p_partkey", band.alias("band"), reason.alias("reason"))


@query("sc07_canonical_attribute", "SELECT CASE trim(attribute) WHEN 'found_site_name' THEN 'found_facility_name' WHEN 'area' THEN 'area_square_meters' WHEN 'waste_depth_meters' THEN 'waste_depth' ELSE trim(attribute) END AS attribute, count(*) AS n FROM {fx_values} GROUP BY 1")
def sc07(spark, sf):
    return table(spark, sf, "fx_values").groupBy(text.canonical_attribute(c("attribute")).alias("attribute")).agg(F.count("*").alias("n"))


QUANTITY = """SELECT *, CASE p WHEN 0 THEN q || '' WHEN 1 THEN q || '400000' WHEN 2 THEN q || '400000' WHEN 3 THEN q || '.4' WHEN 4 THEN '3' WHEN 5 THEN q || '235000' WHEN 6 THEN q || '' ELSE q || '.5' END::DOUBLE AS first,
  CASE WHEN p = 4 THEN (q + 3)::DOUBLE END AS second, CASE WHEN p = 6 THEN 1e6 ELSE 1e0 END AS magnitude
  FROM (SELECT l_orderkey, l_linenumber, l_partkey % 8 AS p, l_suppkey % 12 AS u, l_quantity::INT AS q FROM lineitem)"""


@query("sc08_numbers", f"SELECT l_orderkey, l_linenumber, first, second, magnitude FROM ({QUANTITY})")
def sc08(spark, sf):
    found = units.numbers(c("value"))
    return table(spark, sf, "fx_quantity").select("l_orderkey", "l_linenumber", F.get(found, 0).alias("first"), F.get(found, 1).alias("second"), units.magnitude(c("value"), c("unit")).alias("magnitude"))


@query("sc09_unit_text", """SELECT unit, count(*) AS n FROM (SELECT CASE l_suppkey % 12 WHEN 0 THEN 'tonnes/day' WHEN 1 THEN 'short tons/year' WHEN 2 THEN 'kg' WHEN 3 THEN 'lb/year' WHEN 4 THEN 'tons' WHEN 5 THEN 'metric tonnes/month' WHEN 6 THEN 'acres' WHEN 7 THEN 'ft'
  WHEN 8 THEN 'miles' WHEN 9 THEN 't/h' WHEN 10 THEN 'long tons weekly' ELSE '' END AS unit FROM lineitem) GROUP BY unit""")
def sc09(spark, sf):
    return table(spark, sf, "fx_quantity").groupBy(units.unit_text(c("unit")).alias("unit")).agg(F.count("*").alias("n"))


#: Units as sources of several languages write them, and in English.
UNIT_WORDS = [("toneladas/año", "tonnes/year"), ("Tonnen/Jahr", "tonnes/year"), ("Mg/a", "tonnes/year"), ("to/Jahr", "tonnes/year"), ("toneladas métricas por día", "tonnes/day"), ("tonnellate al giorno", "tonnes/day"), ("ton/día", "tonnes/day"), ("metros cuadrados", "square meters"), ("Quilómetros Quadrados", "square kilometers"), ("metri cubi", "cubic meters"), ("hectáreas", "hectares"), ("кв. км", "square kilometers"), ("тыс. тонн в год", "тыс. tonnes/year"), ("m³/h", "m3/h"), ("toneladas anuales", "tonnes/year"), ("milyon ton", "milyon tonnes"), ("tons per yr", "tons/year"), ("MMCFD", "mmcf/day"), ("kilograms", "kg"), ("dönüm", "decares")]


@query("sc09_unit_words", f"SELECT event_id, CASE event_id % {len(UNIT_WORDS)} {' '.join(f"WHEN {k} THEN '{to}'" for k, (_, to) in enumerate(UNIT_WORDS))} END AS unit FROM events")
def sc09_words(spark, sf):
    said = F.element_at(F.array(*[F.lit(u) for u, _ in UNIT_WORDS]), (c("event_id") % len(UNIT_WORDS) + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", units.unit_text(said).alias("unit"))


FACTORS = "CASE u WHEN 0 THEN 1.0 WHEN 1 THEN 0.90718474 WHEN 2 THEN 0.001 WHEN 3 THEN 0.00045359237 WHEN 5 THEN 1.0 WHEN 9 THEN 1.0 WHEN 10 THEN 1.0160469088 WHEN 11 THEN 1.0 END"
RATES = "CASE u WHEN 0 THEN 365.0 WHEN 5 THEN 12.0 WHEN 9 THEN 8760.0 WHEN 10 THEN 52.0 ELSE 1.0 END"


@query("sc10_mass_factor", f"SELECT l_orderkey, l_linenumber, round(({FACTORS})::DOUBLE * first * magnitude, 6) AS tonnes FROM ({QUANTITY})")
def sc10(spark, sf):
    found = F.get(units.numbers(c("value")), 0) * units.magnitude(c("value"), c("unit"))
    return table(spark, sf, "fx_quantity").select("l_orderkey", "l_linenumber", F.round(units.factor(units.unit_text(c("unit")), units.MASS) * found, 6).alias("tonnes"))


@query("sc11_annualise", f"SELECT u AS unit_kind, ({RATES})::DOUBLE AS yearly, CASE WHEN u IN (0, 1, 3, 5, 9, 10) THEN NULL ELSE 1.0 END::DOUBLE AS stock, count(*) AS n FROM ({QUANTITY}) GROUP BY ALL")
def sc11(spark, sf):
    unit = units.unit_text(c("unit"))
    return table(spark, sf, "fx_quantity").groupBy("unit_kind", units.yearly_factor(unit).alias("yearly"), units.stock_factor(unit).alias("stock")).agg(F.count("*").alias("n"))


@query("sc12_area", "SELECT ord, round(value::DOUBLE * CASE unit WHEN 'acres' THEN 4046.856 WHEN 'ha' THEN 10000.0 WHEN '' THEN 1.0 WHEN 'sq. ft' THEN 0.092903 WHEN 'square miles' THEN 2589988.110336 END::DOUBLE, 4) AS m2 FROM {fx_values} WHERE attribute = 'area'")
def sc12(spark, sf):
    return table(spark, sf, "fx_values").where("attribute = 'area'").select("ord", F.round(F.get(units.numbers(c("value")), 0) * units.factor(units.unit_text(c("unit")), units.AREA), 4).alias("m2"))


@query("sc13_length_distance", f"SELECT l_orderkey, l_linenumber, round(CASE u WHEN 7 THEN 0.3048 WHEN 11 THEN 1.0 END::DOUBLE * first * magnitude, 6) AS metres, round(CASE u WHEN 8 THEN 1.609344 WHEN 11 THEN 1.0 END::DOUBLE * first * magnitude, 6) AS km FROM ({QUANTITY})")
def sc13(spark, sf):
    unit, found = units.unit_text(c("unit")), F.get(units.numbers(c("value")), 0) * units.magnitude(c("value"), c("unit"))
    return table(spark, sf, "fx_quantity").select("l_orderkey", "l_linenumber", F.round(units.factor(unit, units.LENGTH) * found, 6).alias("metres"), F.round(units.factor(unit, units.DISTANCE) * found, 6).alias("km"))


@query("sc14_fraction", "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_partkey % 3 = 0 THEN l_discount WHEN round(l_discount * 100) BETWEEN 0 AND 100 THEN round(l_discount * 100) / CASE WHEN l_partkey % 3 = 1 OR round(l_discount * 100) > 1 THEN 100 ELSE 1 END END, 6) AS share FROM lineitem")
def sc14(spark, sf):
    kind = c("l_partkey") % 3
    said = F.when(kind == 0, c("l_discount").cast("string")).when(kind == 1, F.concat(F.round(c("l_discount") * 100).cast("int").cast("string"), F.lit(" %"))).otherwise(F.round(c("l_discount") * 100).cast("int").cast("string"))
    return table(spark, sf, "lineitem").withColumn("said", said).select("l_orderkey", "l_linenumber", F.round(units.fraction(F.get(units.numbers(c("said")), 0), c("said").contains("%")), 6).alias("share"))


URL_KEY = r"""lower(CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) ELSE 'https' END) || '://' || regexp_replace(lower(regexp_extract(r, '^([^/?]*)', 1)), '^www\.', '') || regexp_replace(regexp_replace(r, '^[^/?]*', ''), '/+$', '')"""
URL_FROM = r"""(SELECT *, regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS r FROM (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM {src}))"""


@query("sc19_url_key", f"SELECT page_id, k AS url_key, 'src-' || substr(sha256(k), 1, 12) AS source_id FROM (SELECT page_id, {URL_KEY} AS k FROM {URL_FROM.replace('{src}', 'pages')})")
def sc19(spark, sf):
    return table(spark, sf, "pages").select("page_id", links.url_key(c("url")).alias("url_key"), links.source_id(c("url")).alias("source_id"))


@query("sc20_mirror_sites", "SELECT ord, CASE WHEN url LIKE '%.maptons.com' THEN 'maptons.com' END AS mirror FROM {fx_citations}")
def sc20(spark, sf):
    return table(spark, sf, "fx_citations").select("ord", links.of_site(c("url"), links.MIRRORS).alias("mirror"))


@query("sc21_url_variants", """WITH l AS (SELECT page_id, url || CASE page_id % 3 WHEN 0 THEN '/a%2Cb' WHEN 1 THEN '/a%2cb%2Cc/' ELSE '' END AS url FROM pages), k AS (SELECT *, regexp_replace(url, '%2[Cc]', ',', 'g') AS comma FROM l)
  SELECT page_id, unnest(list_filter(list_distinct([comma, CASE WHEN comma LIKE '%/' THEN regexp_replace(comma, '/$', '') ELSE comma || '/' END]), lambda x: x <> url)) AS variant FROM k""")
def sc21(spark, sf):
    k = c("page_id") % 3
    url = F.concat("url", F.when(k == 0, "/a%2Cb").when(k == 1, "/a%2cb%2Cc/").otherwise(F.lit("")))
    return table(spark, sf, "pages").select("page_id", F.explode(links.url_variants(url)).alias("variant"))


TYPE = "coalesce((SELECT t FROM tt WHERE t = s), (SELECT new FROM et WHERE t = s), (SELECT new FROM et WHERE starts_with(s, t) ORDER BY array_position(['regulator / court decision','eia','operator website','operator website / company profile','journal article','academic journal','newswire','map / coordinate directory'], t) LIMIT 1), (SELECT t FROM tt WHERE t = h), (SELECT new FROM et WHERE t = h), '')"
TYPED = f"SELECT s, {TYPE} AS kind FROM (SELECT DISTINCT lower(trim(coalesce(source_type, ''))) AS s, trim(regexp_extract(lower(trim(coalesce(source_type, ''))), '^([^/|,]*)', 1)) AS h FROM {{fx_citations}})"


@query("sc22_source_type", f"WITH {TIERED}, typed AS ({TYPED}) SELECT kind, count(*) AS n FROM {{fx_citations}} JOIN typed ON s = lower(trim(coalesce(source_type, ''))) GROUP BY kind")
def sc22(spark, sf):
    return table(spark, sf, "fx_citations").groupBy(tiers.source_type(c("source_type")).alias("kind")).agg(F.count("*").alias("n"))


TIER = "CASE WHEN kind <> '' AND publication_date IS NULL THEN greatest(coalesce(tt.tier, 5), 3) ELSE coalesce(tt.tier, 5) END"


@query("sc23_source_tier", f"WITH {TIERED}, typed AS ({TYPED}) SELECT ord, {TIER} AS tier, CASE WHEN kind = 'map or coordinate directory' THEN 3 ELSE {TIER} END AS location_tier FROM {{fx_citations}} JOIN typed ON s = lower(trim(coalesce(source_type, ''))) LEFT JOIN tt ON tt.t = kind")
def sc23(spark, sf):
    args = c("source_type"), c("publication_date")
    return table(spark, sf, "fx_citations").select("ord", tiers.source_tier(*args).alias("tier"), tiers.source_tier(*args, F.lit("found_location")).alias("location_tier"))


@query("sc24_baseline_tier", f"WITH {TIERED}, tok AS (SELECT site_id, lower(trim(unnest(string_split(contributing_data_sources, '+')))) AS t FROM {{fx_sites}}) SELECT s.site_id, coalesce(min(tier), 5) AS tier, coalesce(string_agg(tok.t, ', ' ORDER BY tok.t) FILTER (WHERE dt.t IS NULL AND tok.t <> ''), '') AS untiered FROM {{fx_sites}} s LEFT JOIN tok USING (site_id) LEFT JOIN dt ON dt.t = tok.t GROUP BY s.site_id")
def sc24(spark, sf):
    tier, unknown = tiers.baseline_tier(c("contributing_data_sources"))
    return table(spark, sf, "fx_sites").select("site_id", tier.alias("tier"), unknown.alias("untiered"))


@query("sc25_staleness", "SELECT site_id, CASE WHEN t < 3 AND reference_year - b >= 3 THEN t + 1 ELSE t END AS tier FROM (SELECT site_id, reference_year, 1 + site_id % 5 AS t, nullif(regexp_extract(backfilled_fields, 'waste_in_place_metric_tonnes@(\\d+)', 1), '')::INT AS b FROM {fx_sites})")
def sc25(spark, sf):
    year = dates.parse_year(F.try_element_at(text.provenance(c("backfilled_fields"), False), F.lit("waste_in_place_metric_tonnes")))
    return table(spark, sf, "fx_sites").select("site_id", tiers.stale_tier(1 + c("site_id") % 5, F.lit("waste_in_place_metric_tonnes"), c("reference_year"), year).alias("tier"))


@query("sc26_provenance_maps", """SELECT site_id, CASE site_id % 3 WHEN 0 THEN 'found_facility_name=lmop_2024;found_latitude=osm_2022;found_longitude=lmop_2024' WHEN 1 THEN 'found_latitude=sinir_2024;found_longitude=lmop_2024' ELSE '' END AS sources,
  CASE site_id % 4 WHEN 0 THEN 'area_square_meters=Tier 1;found_facility_name=Tier 3' WHEN 1 THEN 'found_latitude=Tier 9' ELSE '' END AS filled FROM {fx_sites}""")
def sc26(spark, sf):
    return table(spark, sf, "fx_sites").select("site_id", text.sorted_map(text.provenance(c("attribute_sources"))).alias("sources"), text.sorted_map(text.provenance(c("ai_filled_fields"))).alias("filled"))


@query("sc27_trust_gates", "SELECT site_id, CASE WHEN site_id % 4 = 0 THEN false ELSE site_id % 3 = 0 END AS name_trusted, site_id % 3 = 1 AS point_trusted, t <= 3 AS promotable, t <= 2 AS may_override FROM (SELECT *, 1 + site_id % 5 AS t FROM {fx_sites})")
def sc27(spark, sf):
    gate = lambda a: tiers.trusted(a, c("ai_filled_fields"), c("attribute_sources"))
    point = gate("found_latitude") & gate("found_longitude") & c("latitude").isNotNull() & c("longitude").isNotNull()
    tier = 1 + c("site_id") % 5
    return table(spark, sf, "fx_sites").select("site_id", (gate("found_facility_name") & ~text.is_empty(c("site_name"))).alias("name_trusted"), point.alias("point_trusted"), (tier <= tiers.PROMOTABLE).alias("promotable"), (tier <= tiers.OVERRIDES).alias("may_override"))


@query("sc28_dates", """SELECT ord, coalesce(split_part(value_date, '-', 1)::INT, 0) AS y, coalesce(nullif(split_part(value_date, '-', 2), '')::INT, 0) AS m, coalesce(nullif(split_part(value_date, '-', 3), '')::INT, 0) AS d,
  CASE WHEN split_part(value_date, '-', 1)::INT BETWEEN 1950 AND 1996 THEN split_part(value_date, '-', 1)::INT ELSE 1996 END AS year, value_date IS NOT NULL AND split_part(value_date, '-', 1)::INT <= 1996 AS exact FROM {fx_values}""")
def sc28(spark, sf):
    key, year = dates.date_key(c("value_date")), dates.value_year(c("value_date"), 1996)
    return table(spark, sf, "fx_values").select("ord", key["y"].alias("y"), key["m"].alias("m"), key["d"].alias("d"), year.alias("year"), dates.year_exact(c("value_date"), year).alias("exact"))


@query("sc29_comparable_numbers", "SELECT o_orderkey, round(o_totalprice / pow(10, floor(log10(abs(o_totalprice))) - 5)) * pow(10, floor(log10(abs(o_totalprice))) - 5) AS six FROM orders")
def sc29(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(text.significant(c("o_totalprice")), 6).alias("six"))


@query("sc36_stable_order", "SELECT c_custkey, substr(sha256(c_custkey::VARCHAR || '|' || c_name || '|default'), 1, 16) AS k FROM customer")
def sc36(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.stable_order(c("c_custkey").cast("string"), c("c_name"), F.lit("default")).alias("k"))


@query("sc37_haversine", """SELECT site_id, round(2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(10.5 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(10.5)) * pow(sin(radians(20.25 - longitude) / 2), 2), 1.0))), 6) AS km,
  CASE WHEN latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 THEN printf('%.4f', latitude) || ',' || printf('%.4f', longitude) END AS coord_key FROM {fx_sites}""")
def sc37(spark, sf):
    return table(spark, sf, "fx_sites").select("site_id", F.round(geo.haversine_km(c("latitude"), c("longitude"), F.lit(10.5), F.lit(20.25)), 6).alias("km"), geo.coord_key(c("latitude"), c("longitude")).alias("coord_key"))


@query("sc40_contradiction_check", "SELECT site_id, contributing_data_sources IN ('osm_2022') AND facility_type IS NULL AND waste_in_place IS NULL AS check_it FROM {fx_sites}")
def sc40(spark, sf):
    tokens = F.filter(F.transform(F.split(F.lower("contributing_data_sources"), r"\+"), lambda x: F.trim(x)), lambda x: x != "")
    only_maps = (F.size(tokens) > 0) & (F.size(F.array_except(tokens, F.array(F.lit("osm_2022"), F.lit("gpw_2021")))) == 0)
    return table(spark, sf, "fx_sites").select("site_id", (only_maps & c("facility_type").isNull() & c("waste_in_place").isNull()).alias("check_it"))


@query("sc41_requested_attributes", """SELECT site_id, array_to_string(list_filter([CASE WHEN country_key = 3 OR facility_type IS NOT NULL THEN '' ELSE 'facility_type' END, CASE WHEN country_key = 3 OR (facility_status IS NOT NULL AND trim(facility_status) <> '') THEN '' ELSE 'facility_status' END,
  CASE WHEN country_key = 3 OR waste_in_place IS NOT NULL THEN '' ELSE 'waste_in_place_metric_tonnes' END, CASE WHEN country_key <> 3 AND has_gas = 'TRUE' THEN 'has_flare' ELSE '' END], lambda x: x <> ''), ',') AS asked FROM {fx_sites}""")
def sc41(spark, sf):
    gas = F.coalesce(text.tristate(c("has_gas")), F.lit(False))
    want = [F.when(text.is_empty(c("facility_type")), "facility_type"), F.when(text.is_empty(c("facility_status")), "facility_status"), F.when(c("waste_in_place").isNull(), "waste_in_place_metric_tonnes"), F.when(gas, "has_flare")]
    asked = F.when(c("country_key") == 3, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*want)))
    return table(spark, sf, "fx_sites").select("site_id", F.array_join(asked, ",").alias("asked"))


@query("sc43_link_verdict", "SELECT url, CASE WHEN status = '200' THEN 'OK' WHEN status IN ('404', '410') THEN 'Broken' ELSE 'Unverified' END AS verdict, status IN ('429', '500', 'timeout') AS retry FROM {fx_links}")
def sc43(spark, sf):
    return table(spark, sf, "fx_links").select("url", links.verdict(c("status")).alias("verdict"), links.retryable(c("status")).alias("retry"))


@query("sc49_id_text", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR ELSE 'x' || c_custkey END AS id, row_number() OVER (ORDER BY CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END, 'x' || c_custkey) AS place FROM customer")
def sc49(spark, sf):
    from pyspark.sql import Window

    own = text.id_text(F.when(c("c_custkey") % 2 == 0, F.concat(c("c_custkey").cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit("x"), c("c_custkey").cast("string"))))
    number = F.expr("try_cast(id AS BIGINT)")
    order = [number.isNull(), number, c("id")]
    # dealt by ranges of the order and numbered in each; a range's offset is the rows of those before it
    path = files.scratch(spark)
    table(spark, sf, "customer").select("c_custkey", own.alias("id")).repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    offsets = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - c("n")).alias("offset"))
    placed = dealt.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(*order))).join(F.broadcast(offsets), "part")
    return placed.select("c_custkey", "id", (c("own") + c("offset")).cast("long").alias("place"))


@query("sc50_control_characters", "SELECT doc_id, length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g')) AS n, md5(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g')) AS h FROM documents")
def sc50(spark, sf):
    clean = text.without_controls(c("text"))
    return table(spark, sf, "documents").select("doc_id", F.length(clean).cast("long").alias("n"), F.md5(clean).alias("h"))
