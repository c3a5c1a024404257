"""Names, selections of sites, found values and closures, over many spellings built from the given tables."""

from pyspark.sql import functions as F

from ..functions import searchable, text, values
from ..operators import found, selecting
from . import curation, evidence, more, reviewing  # noqa: F401
from .registry import VIEWS, query, table

c = F.col

NAMES = "Landfill@@OpenStreetMap landfill@no name@Sin Nombre@https://x.example/d@12/3 #4@Update the tag after survey@L@Section No 1@улица Ленина 5@Blade 7@Old Slag field@Pasa@Halde 311@Müllhalde Nord@Tailings pond B@Domestic Landfill@tailings landfill@Erzhalde am Wald@What is it?@ул. Мира@map4@Map IV@waste rock tip"
FRONT = "@Old@Municipal@North@Former@K &@SR 85@GB@de la@Unnamed@Closed (2004)"
MIDDLE = "Landfill@dump@Relleno Sanitario@Basurero@Quarry@Widget/Works@waste@Свалка@W Landfill@[open-air] dump@Deponie, ehem.@MSW polygon@Recycling yard"
BACK = "@II@A@7@(site)@, final@bb"
ORIGINAL = "@Landfill@Vertedero El Salto@Карьер отвал@Halde 311@unnamed@Zona 12 Norte"
SOURCES = "osm_2022@gpw_2021@gpw_2021+gpw_2021@gpw_2021 + osm_2022@@gpw_2021"
pick = lambda words, k: f"split_part('{words}', '@', CAST({k} % {words.count('@') + 1} + 1 AS INT))"

VIEWS["fx_named"] = f"""
SELECT site_id, country, country_key, latitude, longitude, facility_status, has_gas,
       CASE WHEN site_id % 4 = 0 THEN {pick(NAMES, "floor(site_id / 4)")} WHEN site_id % 9 = 1 THEN site_name
            ELSE trim({pick(FRONT, "site_id")} || ' ' || {pick(MIDDLE, "floor(site_id / 3)")} || ' ' || {pick(BACK, "floor(site_id / 2)")}) END AS site_name,
       {pick(ORIGINAL, "site_id")} AS original_name, {pick(SOURCES, "floor(site_id / 7)")} AS sources
FROM {{fx_sites}}
"""
listed = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)
any_of = lambda words: "|".join(words)


def words_sql(name: str) -> str:
    return f"""list_transform(regexp_split_to_array(trim(regexp_replace(lower({name}), '[()/\\[\\]]', ' ', 'g')), '\\s+'), lambda w: trim(w, '.,;:()[]{{}}"''«»'))"""


def informative_sql(words: str) -> str:
    return f"""list_filter({words}, lambda w, i: w <> '' AND w NOT IN ({listed([*searchable.KINDS, *searchable.STATES])}) AND (length(w) > 2 OR (regexp_full_match(w, '\\p{{L}}{{1,2}}') AND NOT regexp_full_match(w, 'x{{0,3}}(ix|iv|v?i{{0,3}})')
      AND (coalesce({words}[i - 1] = '&' AND i > 1, false) OR coalesce({words}[i + 1] = '&', false) OR (length(w) = 2 AND w NOT IN ({listed(searchable.SHORT)}))))))"""


def generic_sql(name: str, words: str, told: str) -> str:
    return f"(trim({name}) = '' OR lower(trim({name})) IN ({listed(searchable.LABELS)}) OR (list_has_any({words}, [{listed(searchable.KINDS)}]) AND len({told}) = 0))"


def rules_sql(name: str, original: str, words: str, told: str) -> str:
    heap = lambda x: f"(regexp_matches({x}, '{any_of(searchable.SPOIL_ELSEWHERE)}') OR regexp_matches(replace({x}, 'müllhalde', ''), 'halde\\b') OR {x} IN ({listed(searchable.SPOIL_ALONE)}))"
    rule = lambda kind, reason, holds: f"WHEN {holds} THEN '{kind}:{reason}'"
    n, o = f"lower(trim({name}))", f"lower(trim({original}))"
    return "CASE " + " ".join([
        rule(searchable.NO_NAME, "empty name", f"{n} = ''"),
        rule(searchable.NO_NAME, "a filler for an unnamed polygon", f"{n} = 'openstreetmap landfill'"),
        rule(searchable.NO_NAME, "says it has no name", f"{n} IN ({listed(searchable.NAMELESS)})"),
        rule(searchable.NOT_A_NAME, "a link", f"({n} LIKE '%http://%' OR {n} LIKE '%https://%' OR {n} LIKE '%www.%')"),
        rule(searchable.NOT_A_NAME, "a bare number", f"regexp_full_match({n}, '[0-9\\s.,;:/#№-]+')"),
        rule(searchable.NOT_A_NAME, "a survey note", f"({n} LIKE '%?%' OR list_bool_or(list_transform([{listed(searchable.NOTES)}], lambda x: contains({n}, x))))"),
        rule(searchable.NOT_A_NAME, "a single letter", f"regexp_full_match({n}, '[\\p{{L}}\\p{{N}}_]')"),
        rule(searchable.NOT_A_NAME, "a numbered part of a site", f"regexp_full_match({n}, '(map|section|cell|card)\\s*(no\\.?|№|#)?\\s*[0-9]+')"),
        rule(searchable.NOT_A_NAME, "a street", f"regexp_matches({n}, '{any_of(searchable.STREETS)}|(^|[^\\p{{L}}])ул\\.')"),
        rule(searchable.MINING, "a mining word", f"regexp_matches({n}, '\\b({any_of(searchable.SPOIL)})\\b')"),
        rule(searchable.MINING, "a mining word in the original name", f"({heap(o)} OR {heap(n)})"),
        rule(searchable.GENERIC, "a listed label", f"{n} IN ({listed(searchable.LABELS)})"),
        rule(searchable.GENERIC, "only words for a kind of site", generic_sql(name, words, told)),
    ]) + " ELSE 'named:' END"


CLASSED = f"""a AS (SELECT *, {words_sql("site_name")} AS ws, {words_sql("original_name")} AS wo FROM {{fx_named}}),
  b AS (SELECT *, {informative_sql("ws")} AS ts, {informative_sql("wo")} AS os FROM a),
  d AS (SELECT *, {rules_sql("site_name", "original_name", "ws", "ts")} AS own, {rules_sql("original_name", "original_name", "wo", "os")} AS other FROM b),
  classed AS (SELECT *, CASE WHEN sources IN ('gpw_2021', 'gpw_2021+gpw_2021') THEN 'address only:only a dataset of addresses records it'
    WHEN lower(trim(site_name)) IN ('', 'openstreetmap landfill', {listed(searchable.NAMELESS)}) AND trim(original_name) <> '' AND lower(trim(original_name)) <> lower(trim(site_name)) AND other = 'named:' THEN 'named:' ELSE own END AS verdict FROM d)"""
SPLIT = "split_part(verdict, ':', 1) AS class, split_part(verdict, ':', 2) AS reason"


@query("sc34_name_class", f"WITH {CLASSED} SELECT site_id, site_name, original_name, {SPLIT} FROM classed")
def sc34(spark, sf):
    return selecting.classed(table(spark, sf, "fx_named")).select("site_id", "site_name", "original_name", "class", "reason")


@query("sel02_skip_by_name", f"WITH {CLASSED} SELECT class, reason, class <> 'named' AS skipped, count(*) AS n, min(site_id) AS first FROM (SELECT *, {SPLIT} FROM classed) GROUP BY ALL")
def sel02(spark, sf):
    return selecting.classed(table(spark, sf, "fx_named")).groupBy("class", "reason", "skipped").agg(F.count("*").alias("n"), F.min("site_id").alias("first"))


@query("sc35_informative_tokens", f"WITH {CLASSED} SELECT site_id, array_to_string(ts, ' ') AS tokens, {generic_sql('site_name', 'ws', 'ts')} AS generic FROM b".replace(CLASSED, CLASSED.split(",\n  d AS")[0]))
def sc35(spark, sf):
    return table(spark, sf, "fx_named").select("site_id", F.array_join(searchable.informative_words(c("site_name")), " ").alias("tokens"), searchable.generic_name(c("site_name")).alias("generic"))


@query("sel06_skip_candidates", f"""WITH {CLASSED}, batches AS (SELECT n_name AS country, n_nationkey % 4 AS batch FROM nation UNION ALL SELECT n_name, 4 FROM nation WHERE n_nationkey % 6 = 0)
  SELECT batch, class, reason, site_id, site_name, original_name, country, sources, latitude, longitude, 'https://www.google.com/maps/search/?api=1&query=' || latitude || ',' || longitude AS map FROM (SELECT *, {SPLIT} FROM classed) JOIN batches USING (country) WHERE class <> 'named'""")
def sel06(spark, sf):
    nation = table(spark, sf, "nation")
    batches = nation.select(c("n_name").alias("country"), (c("n_nationkey") % 4).alias("batch")).unionByName(nation.where("n_nationkey % 6 = 0").select(c("n_name").alias("country"), F.lit(4).alias("batch")))
    return selecting.skip_candidates(table(spark, sf, "fx_named"), batches)


SIZE, FIRST = 150, ["GERMANY", "CHINA"]
KEY = "substr(sha256(site_id::VARCHAR || '|' || trim(site_name) || '|' || country || '|{}'), 1, 16), site_id::VARCHAR"


@query("sel05_mixed_sample", f"""WITH w AS (SELECT *, {words_sql("site_name")} AS ws FROM {{fx_named}}), s AS (SELECT *, {generic_sql("site_name", "ws", informative_sql("ws"))} AS generic FROM w),
  p AS (SELECT row_number() OVER (ORDER BY list_position([{listed(FIRST)}], country), {KEY.format("priority")})::INT AS place, site_id, 'priority_country:' || country AS reason FROM s WHERE country IN ({listed(FIRST)}) QUALIFY place <= {SIZE}),
  np AS (SELECT count(*) AS n FROM p),
  t AS (SELECT site_id, country, row_number() OVER (PARTITION BY country ORDER BY {KEY.format("country_balance")}) AS turn, count(*) OVER (PARTITION BY country) AS size FROM s WHERE country NOT IN ({listed(FIRST)})),
  q AS (SELECT (row_number() OVER (ORDER BY turn, size DESC, country) + n)::INT AS place, site_id, 'country_balanced:' || country AS reason, n FROM t, np QUALIFY place - n <= least(50, ({SIZE} - n) // 2)),
  pq AS (SELECT place, site_id, reason FROM p UNION ALL SELECT place, site_id, reason FROM q), nq AS (SELECT count(*) AS n FROM pq),
  g AS (SELECT (row_number() OVER (ORDER BY {KEY.format("generic_hard_case")}) + n)::INT AS place, site_id, 'generic_name_hard_case' AS reason, n FROM s, nq WHERE generic AND site_id NOT IN (SELECT site_id FROM pq) QUALIFY place - n <= least(30, {SIZE} - n)),
  pqg AS (SELECT * FROM pq UNION ALL SELECT place, site_id, reason FROM g), ng AS (SELECT count(*) AS n FROM pqg),
  f AS (SELECT (row_number() OVER (ORDER BY {KEY.format("deterministic_fill")}) + n)::INT AS place, site_id, 'deterministic_fill' AS reason FROM s, ng WHERE site_id NOT IN (SELECT site_id FROM pqg) QUALIFY place <= {SIZE})
  SELECT * FROM pqg UNION ALL SELECT * FROM f""")
def sel05(spark, sf):
    return selecting.mixed_sample(table(spark, sf, "fx_named"), SIZE, FIRST)


GAS = "lower(trim(coalesce(has_gas, ''))) IN ('yes', 'y', 'true', 't', '1')"


@query("sel07_follow_up", f"""WITH said AS (SELECT site_id, arg_max(value, (ord, value)) AS said FROM {{fx_found}} WHERE attribute = 'has_cover' AND value <> '' AND excluded IS NULL GROUP BY site_id),
  later AS (SELECT site_id, coalesce(said, has_gas) AS has_gas FROM {{fx_sites}} LEFT JOIN said USING (site_id))
  SELECT site_id FROM later WHERE {GAS} AND site_id NOT IN (SELECT site_id FROM {{fx_sites}} WHERE {GAS}) AND site_id IN (SELECT site_id FROM {{fx_runlog}} WHERE web_searches > 0)""")
def sel07(spark, sf):
    sites = table(spark, sf, "fx_sites").select("site_id", "has_gas")
    given = table(spark, sf, "fx_found").where("attribute = 'has_cover' AND value <> '' AND excluded IS NULL").groupBy("site_id").agg(F.max_by("value", F.struct("ord", "value")).alias("said"))
    later = sites.join(given, "site_id", "left").select("site_id", F.coalesce("said", "has_gas").alias("has_gas"))
    searched = table(spark, sf, "fx_runlog").where("web_searches > 0")
    return selecting.follow_up(sites, later, searched, text.tristate(c("has_gas"))).select("site_id")


TITLES = "Site@Promotora del Norte@RED RECOLECTOR SA. DE CV.@Sociedad Anónima@Junta Intermunicipal@La Junta@Intermunicipal de Atlixco@Former mill@SHUT pit@Abandoned (closed)@tecmeda@S. de R.L.@Closet"
VIEWS["fx_operated"] = f"SELECT site_id, facility_status, {pick(TITLES, 'site_id')} || ' ' || {pick(TITLES, 'floor(site_id / 13)')} AS site_name, CASE WHEN site_id % 3 = 0 THEN '' ELSE {pick(TITLES, 'floor(site_id / 5)')} END AS original_name FROM {{fx_sites}}"
operator_sql = lambda name: f"regexp_matches(regexp_replace(lower(strip_accents({name})), '[^a-z0-9]+', ' ', 'g'), '\\b({any_of(searchable.OPERATORS)})\\b')"


@query("sc42_looks_closed", f"""SELECT site_id, (lower(trim(coalesce(facility_status, ''))) = 'inactive' OR regexp_matches(lower(site_name), 'closed|close\\)|former|abandoned|decommission|shut')) AS closed,
  CASE WHEN {operator_sql("original_name")} THEN 'original' WHEN {operator_sql("site_name")} THEN 'name' ELSE '' END AS operator_named FROM {{fx_operated}}""")
def sc42(spark, sf):
    return table(spark, sf, "fx_operated").select("site_id", searchable.looks_closed(c("facility_status"), c("site_name")).alias("closed"), searchable.operator_named(c("original_name"), c("site_name")).alias("operator_named"))


NOTED = "Nothing found@The search tool did not return results@Browsing tool: an error@web-search tool failed. Later an error@I could not complete the required web search@It did not return usable indexed results@SEARCH_QUERY TOOL returned an invalid answer@The register returned an invalid page@The web search tool gave invalid-arguments"
VIEWS["fx_notes"] = f"SELECT conv_id, turn, coalesce(text, '') || ' ' || {pick(NOTED, '(conv_id * 7 + turn)')} || ' ' || coalesce(text, '') AS notes FROM {{conversations}}"


@query("sc44_tool_failed", f"SELECT conv_id, turn, regexp_matches(notes, '(?i){searchable.TOOL_FAILED}') AS failed FROM {{fx_notes}}")
def sc44(spark, sf):
    return table(spark, sf, "fx_notes").select("conv_id", "turn", searchable.tool_failed(c("notes")).alias("failed"))


NUMBER = "regexp_full_match({0}, '[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[-+]?[0-9]+)?')"
item_sql = lambda x: f"CASE WHEN {NUMBER.format(x)} THEN printf('%.5e', ({x})::DOUBLE) ELSE {x} END"
folded_sql = lambda x: f"lower(replace(trim({x}), ',', ''))"
LISTED = "list_filter(list_transform(string_split_regex(regexp_replace(value, '[\\[\\]\"]', '', 'g'), '[;,]'), lambda x: trim(x)), lambda x: x <> '')"
VIEWS["fx_compared"] = """
SELECT ord, trim(attribute) AS attribute, CASE WHEN trim(attribute) = 'found_site_name' THEN CASE ord % 5 WHEN 0 THEN '1,234,' || value WHEN 1 THEN value || '.500' WHEN 2 THEN value || 'E3' WHEN 3 THEN ' No. ' || value || ', North' ELSE '0.00' || value END ELSE value END AS value FROM {fx_values}
UNION ALL SELECT -site_id, 'found_location', CAST(latitude AS STRING) || ', ' || CAST(longitude AS STRING) FROM {fx_sites}
"""
COMPARED = f"""CASE WHEN attribute = 'cover_types' THEN array_to_string(list_sort(list_distinct(list_transform({LISTED}, lambda x: {item_sql(folded_sql('x'))}))), '; ')
  WHEN attribute = 'found_location' THEN array_to_string(list_transform(string_split(value, ','), lambda x: {item_sql(folded_sql('x'))}), ', ') ELSE {item_sql(folded_sql('value'))} END"""


@query("sc29_comparable", f"SELECT ord, {COMPARED} AS comparable FROM {{fx_compared}}")
def sc29(spark, sf):
    return table(spark, sf, "fx_compared").select("ord", values.comparable(c("value"), c("attribute")).alias("comparable"))


VIEWS["fx_reviewed"] = """
SELECT site_id, 'rev-' || CAST(site_id AS STRING) || '-' || CAST(source_id % 5 AS STRING) AS review_id, CASE WHEN trim(attribute) = 'area' THEN 'area_square_meters' ELSE trim(attribute) END AS attribute,
       CAST(1995 + ord % 4 AS INT) AS year, value, CASE WHEN ord % 6 = 0 THEN '' ELSE value_date END AS value_date, ord % 7 <> 0 AND trim(value) <> '' AS used, ord, 'Reason ' || CAST(ord % 3 AS STRING) || '.' AS status_reason
FROM {fx_values}
"""


@query("ag07_named_values", f"""WITH r AS (SELECT *, CASE WHEN attribute = 'annual_incoming_waste_metric_tonnes' THEN year END AS y, NOT used AS idle, {COMPARED} AS cmp, value || ' (' || coalesce(nullif(trim(value_date), ''), 'undated') || ')' AS label,
    [coalesce(nullif(split_part(value_date, '-', 1), '')::INT, 0), coalesce(nullif(split_part(value_date, '-', 2), '')::INT, 0), coalesce(nullif(split_part(value_date, '-', 3), '')::INT, 0)] AS day FROM {{fx_reviewed}}),
  k AS (SELECT *, row_number() OVER w AS place, first_value(cmp) OVER w AS first FROM r WINDOW w AS (PARTITION BY site_id, review_id, attribute, y ORDER BY idle, coalesce(day, [0, 0, 0]) DESC, ord, value)),
  o AS (SELECT site_id, review_id, attribute, y, label, min(place) AS place FROM k WHERE used AND cmp <> first GROUP BY ALL),
  t AS (SELECT site_id, review_id, attribute, y, string_agg(label, '; ' ORDER BY place) AS others FROM o GROUP BY ALL)
  SELECT k.site_id, k.review_id, k.attribute, year, value, value_date, used, ord, status_reason || coalesce(' The source also gives ' || others || '.', '') AS status_reason
  FROM k LEFT JOIN t ON k.site_id = t.site_id AND k.review_id = t.review_id AND k.attribute = t.attribute AND k.y IS NOT DISTINCT FROM t.y WHERE k.place = 1""")
def ag07(spark, sf):
    return found.collapse_found(table(spark, sf, "fx_reviewed"), values.RATE_ATTRIBUTES)


VIEWS["fx_verdicts"] = """
SELECT o_custkey AS site_id, l_orderkey * 10 + l_linenumber AS ord, CASE l_linenumber % 3 WHEN 0 THEN 'facility_type' WHEN 1 THEN 'facility_status' ELSE 'closing_year' END AS attribute,
       CASE l_linenumber % 3 WHEN 0 THEN CASE WHEN l_partkey % 3 = 0 THEN 'Not a Waste Facility' ELSE 'Dumpsite' END WHEN 1 THEN CASE WHEN l_partkey % 5 = 0 THEN 'Inactive' ELSE 'Active' END ELSE CASE WHEN l_partkey % 7 = 0 THEN CAST(year(l_shipdate) AS STRING) ELSE '' END END AS value,
       CASE WHEN l_suppkey % 4 = 0 THEN true WHEN l_suppkey % 4 = 1 THEN NULL ELSE false END AS planned, CASE WHEN l_suppkey % 5 = 0 THEN 'not used' ELSE 'review' END AS status, 'Seen.' AS status_reason
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


@query("ag08_flagged_verdicts", """WITH s AS (SELECT site_id, said, min(ord) AS o FROM (SELECT site_id, ord, CASE WHEN attribute = 'facility_status' AND value = 'Inactive' THEN 'facility_status = Inactive' WHEN attribute = 'closing_year' AND value <> '' AND planned IS NOT TRUE THEN 'closing_year = ' || value END AS said FROM {fx_verdicts}) WHERE said IS NOT NULL GROUP BY ALL),
  r AS (SELECT site_id, string_agg(said, '; ' ORDER BY o, said) AS reported FROM s GROUP BY site_id)
  SELECT site_id, ord, attribute, value, status, status_reason || CASE WHEN attribute = 'facility_type' AND value = 'Not a Waste Facility' AND status = 'review' AND reported IS NOT NULL THEN ' CHECK: this run also found ' || reported || ' - is this a closed landfill misread as never a waste site?' ELSE '' END AS status_reason
  FROM {fx_verdicts} LEFT JOIN r USING (site_id)""")
def ag08(spark, sf):
    return found.flag_closures(table(spark, sf, "fx_verdicts"), c("status") == "review").select("site_id", "ord", "attribute", "value", "status", "status_reason")
