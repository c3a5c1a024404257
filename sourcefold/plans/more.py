"""Further values, files, leads, checks and worklists."""

from pyspark.sql import Window, functions as F

from ..functions import links, names, text, values
from ..operators import nested, pages as page_ops, pairs
from ..sources import tables as files
from . import responses, reviewing  # noqa: F401
from .registry import query, table
from .scalars import FACTORS, QUANTITY, RATES

c = F.col


@query("sc04_enum_mapping", "SELECT event_id, CASE lower(event_type) WHEN 'click' THEN 'Clicked' WHEN 'view' THEN 'Viewed' WHEN 'purchase' THEN 'purchase' END AS kind FROM events")
def sc04(spark, sf):
    return table(spark, sf, "events").select("event_id", values.mapped(F.upper("event_type"), {"click": "Clicked", "View": "Viewed"}, ["purchase", "Clicked"]).alias("kind"))


#: What stands after the number, its unit, and the tonnes a year of value.
METHANE = [("", "MMSCFD", "value * 1e6 * 0.0192 / 1000 * 365"), ("", "m3/year", "value * 0.679 / 1000"), ("", "scfm", "value * 0.0192 / 1000 * 525600"), ("", "m3 of landfill gas", "NULL"), ("", "t CO2e", "NULL"), (" million", "cubic feet", "value * 1e6 * 0.0192 / 1000"), ("", "ft³ per day", "value * 0.0192 / 1000 * 365"), ("", "m³/month", "value * 0.679 / 1000 * 12"), ("", "m3 of biogas (methane part)", "value * 0.679 / 1000"), (" CH4", "ft3 of LFG/hour", "value * 0.0192 / 1000 * 8760"), ("", "thousand cubic metres", "value * 1e3 * 0.679 / 1000"), ("", "MCF", "value * 1e3 * 0.0192 / 1000"), ("", "tonnes", "NULL")]


@query("sc15_methane", f"SELECT event_id, round(CASE event_id % {len(METHANE)} {' '.join(f'WHEN {k} THEN {x}' for k, (_, _, x) in enumerate(METHANE))} END, 9) AS tonnes FROM (SELECT event_id, round(value, 2) AS value FROM events)")
def sc15(spark, sf):
    k = (c("event_id") % len(METHANE) + 1).cast("int")
    after, unit = (F.element_at(F.array(*[F.lit(m[i]) for m in METHANE]), k) for i in (0, 1))
    said = F.concat(F.format_string("%.2f", F.round("value", 2)), after)
    return table(spark, sf, "events").select("event_id", F.round(values.ch4_tonnes(said, unit), 9).alias("tonnes"))


@query("sc16_convert_by_attribute", f"SELECT l_orderkey, l_linenumber, round(({FACTORS})::DOUBLE * first * magnitude * ({RATES})::DOUBLE, 4) AS yearly FROM ({QUANTITY})")
def sc16(spark, sf):
    return table(spark, sf, "fx_quantity").select("l_orderkey", "l_linenumber", F.round(values.converted(F.lit("annual_incoming_waste_metric_tonnes"), c("value"), c("unit")), 4).alias("yearly"))


@query("sc18_normalise_value", r"""SELECT ord, CASE WHEN reason IS NULL THEN CASE WHEN area OR rate THEN regexp_replace(regexp_replace(printf('%.6f', value::DOUBLE * CASE WHEN rate THEN 1 ELSE f END), '0+$', ''), '\.$', '') ELSE trim(value) END END AS usable, reason FROM (
  SELECT *, CASE WHEN trim(value) = '' THEN 'empty' WHEN area AND unit = 'furlongs' OR rate AND unit <> '' THEN 'unit' END AS reason FROM (
    SELECT ord, value, unit, attribute = 'area' AS area, attribute = 'annual_incoming_waste_metric_tonnes' AS rate,
      CASE unit WHEN 'acres' THEN 4046.856 WHEN 'ha' THEN 10000.0 WHEN 'sq. ft' THEN 0.092903 WHEN 'square miles' THEN 2589988.110336 ELSE 1.0 END::DOUBLE AS f FROM {fx_values}))""")
def sc18(spark, sf):
    found = values.normal(text.canonical_attribute(c("attribute")), c("value"), c("unit"))
    return table(spark, sf, "fx_values").select("ord", found.alias("n")).select("ord", "n.usable", "n.reason")


@query("sc38_stated_parts", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 3 THEN '' ELSE s_name || ' Road' END AS address, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 3 THEN '' ELSE (s_suppkey % 80) || '.25, 10.5' END AS coordinates FROM supplier")
def sc38(spark, sf):
    k = c("s_suppkey") % 4
    point = F.concat((c("s_suppkey") % 80).cast("string"), F.lit(".25, 10.5"))
    said = F.when(k == 3, "Unknown | n/a").when(k == 0, F.concat("s_name", F.lit(" Road | not stated"))).when(k == 1, F.concat("s_name", F.lit(" Road | "), point)).otherwise(F.concat(point, F.lit("|"), c("s_name"), F.lit(" Road")))
    address, point = values.stated_parts(said)
    return table(spark, sf, "supplier").select("s_suppkey", address.alias("address"), point.alias("coordinates"))


@query("sc39_same_state", "SELECT c_custkey, n_name, c_custkey % 3 <> 0 AS same FROM customer JOIN nation ON c_nationkey = n_nationkey")
def sc39(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    theirs = F.when(c("c_custkey") % 3 == 0, "Élsewhere").when(c("c_custkey") % 3 == 1, F.lower("n_name")).otherwise(F.concat(F.lit(" "), F.initcap("n_name"), F.lit(".")))
    rows = table(spark, sf, "customer").join(F.broadcast(nation), c("c_nationkey") == c("n_nationkey"))
    return rows.select("c_custkey", "n_name", (names.plain(theirs) == names.plain(c("n_name"))).alias("same"))


@query("sc46_leads", "SELECT event_id, 'area' AS attribute, event_id::VARCHAR AS value FROM events WHERE event_id % 4 = 0 UNION ALL SELECT event_id, unnest(['a', 'b']), unnest(['1', '2']) FROM events WHERE event_id % 4 = 1 UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 4 >= 2")
def sc46(spark, sf):
    k = c("event_id") % 4
    lead = F.when(k == 0, F.to_json(F.struct(F.lit("area").alias("attribute_name"), c("event_id").cast("string").alias("value")))).when(k == 1, F.lit('{"values": [{"attribute": "a", "value": "1"}, {"attribute": "b", "value": "2"}]}')).when(k == 2, F.lit('{"note": "see page"}')).otherwise(F.lit("just text"))
    schema = "attribute_name string, attribute string, value string, values array<struct<attribute_name: string, attribute: string, value: string>>"
    read = table(spark, sf, "events").select("event_id", F.from_json(lead, schema).alias("l"))
    one = F.struct(F.coalesce("l.attribute_name", "l.attribute").alias("attribute"), c("l.value").alias("value"))
    several = F.transform("l.values", lambda v: F.struct(F.coalesce(v["attribute_name"], v["attribute"]).alias("attribute"), v["value"].alias("value")))
    return read.select("event_id", F.explode(F.coalesce(several, F.array(one))).alias("v")).select("event_id", "v.attribute", "v.value")


ENCODED = "replace(replace(url_encode(array_to_string({}, ' ')), '~', '%7E'), '%2A', '*')"


@query("sc48_quote_links", rf"""WITH w AS (SELECT page_id, url, regexp_replace(url, '#.*$', '') AS u, string_split_regex(trim(html), '\s+') AS s FROM pages)
  SELECT page_id, CASE WHEN regexp_matches(lower(url), '^https?://') THEN u || '#:~:text=' || CASE WHEN len(s) <= 8 THEN {ENCODED.format('s')} ELSE {ENCODED.format('s[1:4]')} || ',' || {ENCODED.format('s[-4:]')} END END AS link FROM w""")
def sc48(spark, sf):
    return table(spark, sf, "pages").select("page_id", values.quote_link(c("url"), c("html")).alias("link"))


@query("io07_row_counts", "SELECT o_orderstatus AS run, count(*) AS now, count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS before, count(*) <> count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS changed FROM orders GROUP BY 1")
def io07(spark, sf):
    counts = table(spark, sf, "orders").groupBy(c("o_orderstatus").alias("run")).agg(F.count("*").alias("now"), F.count_if(c("o_orderkey") % 10 != 0).alias("before"))
    return counts.withColumn("changed", c("now") != c("before"))


@query("io09_missing_files", "SELECT DISTINCT o_orderstatus || '.parquet' AS name FROM orders WHERE o_orderstatus <> 'F'")
def io09(spark, sf):
    rows = table(spark, sf, "orders").select(F.concat("o_orderstatus", F.lit(".parquet")).alias("name"))
    kept = rows.where("name = 'F.parquet'").distinct()
    path = files.scratch(spark)
    kept.write.parquet(path)
    return rows.distinct().join(spark.read.parquet(path), "name", "left_anti")


@query("io10_keyed_sidecar", "SELECT DISTINCT url, length(url) AS n FROM pages")
def io10(spark, sf):
    path, pages = files.scratch(spark), table(spark, sf, "pages")
    parts = 1 + pages.count() // 1000  # of about so many entries each
    pages.groupBy(F.pmod(F.xxhash64("url"), F.lit(parts)).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_set(F.struct("url", F.struct(F.length("url").alias("n")))))).alias("value")).select("value").write.text(path)
    read = spark.read.text(path).select(F.explode(F.from_json("value", "map<string, struct<n: bigint>>")).alias("url", "v"))
    return read.select("url", c("v.n").alias("n")).distinct()


@query("io12_page_text_by_source", "SELECT page_id, length(html) AS n FROM pages")
def io12(spark, sf):
    path = files.scratch(spark)
    pages = table(spark, sf, "pages").withColumn("source_id", F.concat(links.source_id(c("url")), F.lit("-"), c("page_id").cast("string")))
    pages.select("source_id", c("html").alias("text")).write.parquet(path)
    return pages.select("page_id", "source_id").join(spark.read.parquet(path), "source_id").select("page_id", F.length("text").cast("long").alias("n"))


@query("io14_fixed_header", "SELECT p_partkey, p_name, '' AS note FROM part WHERE p_size % 2 = 0")
def io14(spark, sf):
    path, parts = files.scratch(spark), table(spark, sf, "part")
    header = ["p_partkey", "p_name", "note"]
    files.write_fixed(parts.where("p_size % 2 = 1"), path, header)
    files.write_fixed(parts.where("p_size % 2 = 0"), path, header)
    return spark.read.parquet(path).select("p_partkey", "p_name", F.coalesce("note", F.lit("")).alias("note"))


@query("io14_fixed_header_csv", "SELECT p_partkey::VARCHAR AS p_partkey, p_name || ', \"' || p_size || '\"' || chr(10) || 'x' AS p_name, '' AS note FROM part")
def io14_csv(spark, sf):
    path, parts = files.scratch(spark), table(spark, sf, "part")
    header = ["p_partkey", "p_name", "note"]
    files.write_csv(parts.where("p_size % 2 = 1"), path, header)
    files.write_csv(parts.withColumn("p_name", F.concat("p_name", F.lit(', "'), c("p_size").cast("string"), F.lit('"\nx'))), path, header)
    return files.read_csv(spark, path, header)


@query("sel03_skip_by_type", "SELECT site_id, CASE WHEN facility_type = 'BUILDING' THEN 'own type' WHEN site_id IN (SELECT p_partkey FROM part WHERE p_size < 10) THEN 'reviewed list' END AS reason FROM {fx_sites}")
def sel03(spark, sf):
    listed = table(spark, sf, "part").where("p_size < 10").select(c("p_partkey").alias("site_id"), F.lit("reviewed list").alias("listed"))
    return table(spark, sf, "fx_sites").join(listed, "site_id", "left").select("site_id", F.coalesce(F.when(c("facility_type") == "BUILDING", "own type"), "listed").alias("reason"))


@query("ag11_stated_once", "SELECT site_id, source_id, arg_min(url, ord) AS url FROM (SELECT site_id, source_index AS source_id, url, ord * 100 + length(url) AS ord FROM (SELECT site_id, source_index, min(url) AS url, ord FROM {fx_citations} GROUP BY ALL)) GROUP BY ALL")
def ag11(spark, sf):
    rows = table(spark, sf, "fx_citations").groupBy("site_id", c("source_index").alias("source_id"), "ord").agg(F.min("url").alias("url"))
    return rows.groupBy("site_id", "source_id").agg(F.min_by("url", c("ord") * 100 + F.length("url")).alias("url"))


@query("nr06_leads_not_used", "SELECT site_id, attribute, 'lead' AS status, count(*) AS n FROM {fx_found} WHERE tier = 5 GROUP BY ALL UNION ALL SELECT site_id, attribute, 'found', count(*) FROM {fx_found} WHERE tier < 5 GROUP BY ALL")
def nr06(spark, sf):
    rows = table(spark, sf, "fx_found")
    leads = rows.where("tier = 5").select("site_id", "attribute", F.lit("lead").alias("status"))
    return rows.where("tier < 5").select("site_id", "attribute", F.lit("found").alias("status"), "value").unionByName(leads, allowMissingColumns=True).groupBy("site_id", "attribute", "status").agg(F.count("*").alias("n"))


@query("jn22_decisions_joined", "SELECT ord, attribute, value, coalesce(decision, 'undecided') AS decision FROM {fx_found} LEFT JOIN {fx_decisions} USING (review_id)")
def jn22(spark, sf):
    decisions = table(spark, sf, "fx_decisions").select("review_id", "decision")
    return table(spark, sf, "fx_found").join(decisions, "review_id", "left").select("ord", "attribute", "value", F.coalesce("decision", F.lit("undecided")).alias("decision"))


@query("rev1_worklist", "SELECT review_id, row_number() OVER (PARTITION BY site_id ORDER BY best, first, review_id) AS place, n FROM (SELECT site_id, review_id, min(tier) AS best, min(ord) AS first, count(*) AS n FROM {fx_found} WHERE excluded IS NULL GROUP BY ALL)")
def rev1(spark, sf):
    per = table(spark, sf, "fx_found").where("excluded IS NULL").groupBy("site_id", "review_id").agg(F.min("tier").alias("best"), F.min("ord").alias("first"), F.count("*").alias("n"))
    return per.select("review_id", F.row_number().over(Window.partitionBy("site_id").orderBy("best", "first", "review_id")).cast("long").alias("place"), "n")


@query("rev2_flags", "SELECT review_id, concat_ws('; ', CASE WHEN count(*) FILTER (WHERE excluded = 'dead link') > 0 THEN 'dead link' END, CASE WHEN min(tier) > 3 THEN 'weak source' END, CASE WHEN count(DISTINCT attribute) > 3 THEN 'many attributes' END) AS flags FROM {fx_found} GROUP BY review_id")
def rev2(spark, sf):
    return table(spark, sf, "fx_found").groupBy("review_id").agg(F.concat_ws("; ", F.when(F.count_if(c("excluded") == "dead link") > 0, "dead link"), F.when(F.min("tier") > 3, "weak source"), F.when(F.count_distinct("attribute") > 3, "many attributes")).alias("flags"))


@query("rev4_value_decisions", "SELECT ord, attribute, CASE WHEN ord % 4 = 1 THEN 'Correct' WHEN ord % 4 IN (2, 3) THEN 'Wrong' END AS decision, CASE WHEN ord % 4 = 3 THEN (ord % 100)::VARCHAR END AS correction FROM {fx_found}")
def rev4(spark, sf):
    said = F.when(c("ord") % 4 == 1, " correct ").when(c("ord") % 4 == 2, "WRONG").otherwise(F.lit(""))
    typed = F.when(c("ord") % 4 == 3, F.concat(F.lit(" "), (c("ord") % 100).cast("string"), F.lit(" "))).otherwise(F.lit(" "))
    correction = text.blank_to_null(typed)
    decision = F.coalesce(values.mapped(said, {}, ["Correct", "Wrong"]), F.when(correction.isNotNull(), "Wrong"))
    return table(spark, sf, "fx_found").select("ord", "attribute", decision.alias("decision"), correction.alias("correction"))


@query("rev5_page_corrections", "SELECT review_id, unnest(['area_square_meters', 'facility_status']) AS attribute, unnest(['12', 'Closed']) AS correction FROM {fx_decisions} WHERE decision = 'correct'")
def rev5(spark, sf):
    note = F.lit("area_square_meters: 12\nfacility_status: Closed")
    rows = table(spark, sf, "fx_decisions").where("decision = 'correct'")
    parts = F.split(note, r"\n(?=[a-z_]+:)")
    return rows.select("review_id", F.explode(F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"^([a-z_]+):\s*(.*)$", 1).alias("attribute"), F.regexp_extract(p, r"^([a-z_]+):\s*(.*)$", 2).alias("correction")))).alias("x")).select("review_id", "x.*")


@query("ag09_merged_places", "SELECT k, 2::INT AS places FROM (SELECT DISTINCT s_nationkey AS k FROM supplier)")
def ag09b(spark, sf):
    rows = table(spark, sf, "supplier").select(c("s_nationkey").alias("k"), c("s_suppkey").alias("ord"))
    spread = rows.select("k", F.explode(F.array(F.struct(c("ord").alias("ord"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude")), F.struct((c("ord") + 100000).alias("ord"), F.lit(1.01).alias("latitude"), F.lit(1.0).alias("longitude")), F.struct((c("ord") + 200000).alias("ord"), F.lit(2.0).alias("latitude"), F.lit(1.0).alias("longitude")))).alias("p")).select("k", "p.*")
    return pairs.merged_points(spread, "k")


@query("pj09_postal_patterns", "SELECT doc_id, nullif(regexp_extract(text, '\\b([0-9]{1,4} [A-Z][a-z]+)', 1), '') AS place FROM documents")
def pj09(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.nullif(F.regexp_extract("text", r"\b([0-9]{1,4} [A-Z][a-z]+)", 1), F.lit("")).alias("place"))
