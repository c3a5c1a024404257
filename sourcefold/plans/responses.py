"""Files and nested responses."""

from pyspark.sql import functions as F

from ..functions import text
from ..operators import nested
from ..sources import tables as files
from . import views  # noqa: F401
from .registry import VIEWS, query, table

c = F.col

VIEWS["fx_flat"] = """
SELECT o_custkey AS site_id, CAST(l_orderkey % 2 AS BIGINT) AS pass, l_suppkey AS source, 'https://src' || CAST(l_suppkey AS STRING) || '.example' AS url, CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'regulator' END AS source_type, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE '2001' END AS publication_date,
       'Site ' || CAST(l_suppkey AS STRING) AS facility_name, l_orderkey * 1000 + l_linenumber * 100 + l_partkey % 97 AS place, CASE l_linenumber WHEN 1 THEN 'area' WHEN 2 THEN 'facility_status' WHEN 3 THEN 'owner' ELSE 'colour' END AS attribute_name,
       CASE WHEN l_partkey % 11 = 0 THEN '' ELSE CAST(l_partkey AS STRING) END AS value, 'ha' AS unit, CAST(year(l_shipdate) AS STRING) AS value_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

INDEXED = """x AS (SELECT *, dense_rank() OVER (PARTITION BY site_id, pass ORDER BY source) - 1 AS source_index, row_number() OVER (PARTITION BY site_id, pass, source ORDER BY place, attribute_name, value, unit, value_date) - 1 AS value_index FROM {fx_flat})"""


def read(spark, sf):
    return nested.read_sources(nested.responses(table(spark, sf, "fx_flat")))


@query("nr01_read_sources", f"WITH {INDEXED} SELECT site_id, pass, source_index, value_index, url, source_type, publication_date, attribute_name, value FROM x")
def nr01(spark, sf):
    return read(spark, sf).select("site_id", "pass", c("source_index").cast("long").alias("source_index"), c("value_index").cast("long").alias("value_index"), "url", "source_type", "publication_date", "attribute_name", "value")


@query("nr02_attribute_first", """WITH f AS (SELECT *, attribute_name || place AS a FROM {fx_flat}) SELECT site_id, url, max(nullif(source_type, '')) AS source_type, max(publication_date) AS publication_date, count(*) AS cited, count(DISTINCT attribute_name) AS attributes FROM f GROUP BY ALL""")
def nr02(spark, sf):
    flat = table(spark, sf, "fx_flat")
    one = F.struct("place", "attribute_name", "value", "unit", F.array(F.struct("url", "source_type", "publication_date")).alias("sources"))
    body = F.to_json(F.struct(F.sort_array(F.collect_list(one)).alias("attributes")))
    return nested.by_page(flat.groupBy("site_id").agg(body.alias("body")))


@query("nr03_merge_passes", f"WITH {INDEXED}, d AS (SELECT site_id, pass, source_index, row_number() OVER (PARTITION BY site_id ORDER BY pass, source_index) - 1 AS merged_index FROM (SELECT DISTINCT site_id, pass, source_index FROM x)) SELECT site_id, pass, source_index, merged_index, count(*) AS n FROM x JOIN d USING (site_id, pass, source_index) GROUP BY ALL")
def nr03(spark, sf):
    return nested.merged_passes(read(spark, sf)).groupBy("site_id", "pass", c("source_index").cast("long").alias("source_index"), "merged_index").agg(F.count("*").alias("n"))


@query("nr04_evidence_ids", f"WITH {INDEXED} SELECT 'ev-' || site_id || '-S' || lpad((source_index + 1)::VARCHAR, 3, '0') || '-' || lpad((value_index + 1)::VARCHAR, 3, '0') AS id, attribute_name FROM x")
def nr04(spark, sf):
    return read(spark, sf).select(nested.evidence_id("site_id", "source_index", "value_index").alias("id"), "attribute_name")


@query("nr07_found_attributes", "SELECT site_id, pass, count(DISTINCT attribute_name) AS attributes, count(DISTINCT url) AS urls FROM {fx_flat} GROUP BY ALL")
def nr07(spark, sf):
    return read(spark, sf).groupBy("site_id", "pass").agg(F.count_distinct("attribute_name").alias("attributes"), F.count_distinct("url").alias("urls"))


@query("nr08_problems", "SELECT DISTINCT site_id, 'unsupported attribute colour' AS problem FROM {fx_flat} WHERE attribute_name = 'colour' UNION ALL SELECT DISTINCT site_id, 'no value for ' || attribute_name FROM {fx_flat} WHERE value = ''")
def nr08(spark, sf):
    return nested.problems(read(spark, sf), ["area", "facility_status", "owner"])


@query("nr09_tool_actions", "SELECT user_id AS site_id, count(*) AS actions, sum(CASE WHEN event_type = 'click' THEN greatest((event_id % 4)::INT, 1) ELSE 0 END)::BIGINT AS queries FROM events GROUP BY 1")
def nr09(spark, sf):
    logs = table(spark, sf, "events").withColumn("queries", F.transform(F.sequence(F.lit(1), (c("event_id") % 4).cast("int")), lambda x: x.cast("string")))
    logs = logs.withColumn("queries", F.when(c("event_id") % 4 == 0, F.array().cast("array<string>")).otherwise(c("queries")))
    per = logs.groupBy("user_id").agg(F.collect_list(F.struct(c("event_type").alias("type"), "queries")).alias("actions"))
    done = per.select("user_id", F.posexplode("actions").alias("place", "a"))
    return done.groupBy(c("user_id").alias("site_id")).agg(F.count("*").alias("actions"), F.sum(F.when(c("a.type") == "click", F.greatest(F.size("a.queries"), F.lit(1))).otherwise(0)).alias("queries"))


@query("io01_csv", "SELECT c_custkey::VARCHAR AS c_custkey, c_name || ', \"x\"' || chr(10) || 'y' AS c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def io01(spark, sf):
    path = files.scratch(spark)
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(', "x"\ny')).alias("c_name"), F.when(c("c_custkey") % 3 == 0, "").otherwise(c("c_mktsegment")).alias("c_mktsegment"))
    rows.write.csv(path, header=True, quote='"', escape='"', emptyValue="")
    return files.read_csv(spark, path, ["c_custkey", "c_name", "c_mktsegment"])


@query("io02_site_aliases", "SELECT site_id, coalesce(nullif(trim(facility_status), ''), facility_type, '0') AS kind FROM {fx_sites}")
def io02(spark, sf):
    return table(spark, sf, "fx_sites").withColumn("zero", F.lit(0)).select("site_id", files.first_present("facility_status", "facility_type", "zero").alias("kind"))


@query("io03_json_documents", "SELECT c_nationkey || '.json' AS name, count(*) AS n, c_nationkey % 5 = 0 AS broken FROM customer GROUP BY c_nationkey")
def io03(spark, sf):
    path = files.scratch(spark)
    body = F.when(c("c_nationkey") % 5 == 0, "{broken").otherwise(F.to_json(F.struct("ids")))
    per = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.collect_list("c_custkey").alias("ids"), F.count("*").alias("n"))
    per.select("c_nationkey", body.alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    found = files.read_documents(spark, path, "ids array<bigint>").select("name", F.size("document.ids").alias("size"), "broken")
    # the part of the path is the name here; counts come back from the documents themselves
    tagged = spark.read.text(path, wholetext=True).select("c_nationkey", F.from_json("value", "ids array<bigint>").alias("d"), F.expr("try_parse_json(value) IS NULL").alias("broken"))
    assert found.columns == ["name", "size", "broken"]
    return tagged.join(per.select("c_nationkey", "n"), "c_nationkey").select(F.concat(c("c_nationkey").cast("string"), F.lit(".json")).alias("name"), F.when(c("broken"), c("n")).otherwise(F.size("d.ids").cast("long")).alias("n"), "broken")


@query("io04_tolerant_json", "SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN NULL ELSE turn END AS found FROM conversations")
def io04(spark, sf):
    json = F.to_json(F.struct(c("turn").alias("t"), F.lit("a}b").alias("x")))
    said = F.when(c("turn") % 4 == 0, json).when(c("turn") % 4 == 1, F.concat(F.lit("```json\n"), json, F.lit("\n```"))).when(c("turn") % 4 == 2, F.concat(F.lit("Here it is: "), json, F.lit(" Done."))).otherwise(F.lit("nothing"))
    return table(spark, sf, "conversations").select("conv_id", "turn", files.tolerant_json(said, "t bigint, x string")["t"].alias("found"))


@query("io05_run_scan", "SELECT facility_id, year, price FROM {fx_facility_years} WHERE run_id = 1 AND price IS NOT NULL AND year >= 1995")
def io05(spark, sf):
    path = files.scratch(spark)
    table(spark, sf, "fx_facility_years").write.partitionBy("run_id").parquet(path)
    return spark.read.parquet(path).where("run_id = 1 AND price IS NOT NULL AND year >= 1995").select("facility_id", "year", "price")


@query("io06_choose_run", "SELECT run, newest, n AS rows, linkages FROM (SELECT o_orderstatus AS run, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END) AS newest, count(*) AS n, count(DISTINCT o_orderpriority) AS linkages FROM orders GROUP BY 1) ORDER BY newest DESC NULLS LAST, run DESC LIMIT 1")
def io06(spark, sf):
    runs = table(spark, sf, "orders").select(c("o_orderstatus").alias("run"), F.when(c("o_orderkey") % 2 == 0, c("o_orderdate")).alias("date"), c("o_orderpriority").alias("linkage"))
    return files.choose_run(runs)


@query("io08_snapshot", "SELECT count(*) AS rows, true AS same FROM orders WHERE o_orderstatus = 'F'")
def io08(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    manifest = files.snapshot(rows, files.scratch(spark))
    return manifest.join(rows.agg(F.bit_xor(F.xxhash64(*rows.columns)).alias("x"))).select("rows", (c("checksum") == c("x")).alias("same"))


@query("io11_last_record_wins", "SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def io11(spark, sf):
    path = files.scratch(spark)
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").write.json(path)
    rows = spark.read.schema("event_id long, user_id long, event_type string, value double").json(path)
    return rows.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), "event_id").alias("w")).select("user_id", "w.*")


@query("io13_exclusion_list", "SELECT site_id FROM {fx_sites} WHERE site_id NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def io13(spark, sf):
    listed = table(spark, sf, "part").where("p_size < 10").select(c("p_partkey").alias("site_id"))
    return table(spark, sf, "fx_sites").select("site_id").join(listed, "site_id", "left_anti")


@query("io15_header_union", "SELECT s_suppkey AS k, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer")
def io15(spark, sf):
    a = table(spark, sf, "supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("name"), c("s_acctbal").alias("balance"))
    b = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@query("io16_pinned_corpus", "SELECT c_custkey, c_name FROM customer")
def io16(spark, sf):
    path, rows = files.scratch(spark), table(spark, sf, "customer").select("c_custkey", "c_name")
    files.pinned(rows, path)
    return files.pinned(rows, path)


@query("io17_union_of_runs", "SELECT 'a' AS run, user_id AS site_id, value, NULL::VARCHAR AS status FROM events UNION ALL SELECT 'b', o_custkey, o_totalprice, o_orderstatus FROM orders")
def io17(spark, sf):
    a = table(spark, sf, "events").select(c("user_id").alias("site_id"), "value")
    b = table(spark, sf, "orders").select(c("o_custkey").alias("site_id"), c("o_totalprice").alias("value"), c("o_orderstatus").alias("status"))
    return files.union_of_runs({"a": a, "b": b}, ["site_id", "value"]).select("run", "site_id", "value", "status")


@query("io18_single_run", "SELECT count(DISTINCT o_orderstatus) AS runs, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) END AS run FROM orders")
def io18(spark, sf):
    return files.one_run(table(spark, sf, "orders"), "o_orderstatus")


@query("sc45_tag_name", "SELECT event_id, json_extract_string(props, '$.k') AS name FROM events")
def sc45(spark, sf):
    single = F.translate(c("props"), '"', "'")
    return table(spark, sf, "events").select("event_id", F.coalesce(F.from_json(F.when(c("event_id") % 2 == 0, c("props")), "k string"), F.from_json(F.when(c("event_id") % 2 == 1, single), "k string", {"allowSingleQuotes": "true"}))["k"].alias("name"))


@query("sc47_generated_id", "SELECT s_suppkey, 'x_' || lower(regexp_replace(regexp_replace(s_name, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g')) AS id FROM supplier")
def sc47(spark, sf):
    snake = F.lower(F.regexp_replace(F.regexp_replace("s_name", "([a-z0-9])([A-Z])", "$1_$2"), "[^A-Za-z0-9]+", "_"))
    return table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("x_"), snake).alias("id"))


@query("jn05_fill_places", "SELECT s.site_id, coalesce(s.municipality, 'T' || n.c_custkey) AS municipality FROM {fx_sites} s LEFT JOIN customer n ON n.c_custkey = s.site_id AND n.c_custkey % 14 = 0")
def jn05(spark, sf):
    saved = table(spark, sf, "customer").where("c_custkey % 14 = 0").select(c("c_custkey").alias("site_id"), F.concat(F.lit("T"), c("c_custkey").cast("string")).alias("place"))
    return table(spark, sf, "fx_sites").join(saved, "site_id", "left").select("site_id", F.coalesce(text.blank_to_null(c("municipality")), "place").alias("municipality"))


@query("sel08_pass_work_list", "SELECT site_id, 'facility_type' AS attributes FROM {fx_sites} WHERE facility_type IS NULL AND site_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click')")
def sel08(spark, sf):
    asked = F.array_compact(F.array(F.when(c("facility_type").isNull(), "facility_type"), F.when(c("waste_in_place").isNull(), "waste_in_place")))
    wanted = F.array_intersect(asked, F.array(F.lit("facility_type"), F.lit("owner")))
    done = table(spark, sf, "events").where("event_type = 'click'").select(c("user_id").alias("site_id"))
    return table(spark, sf, "fx_sites").withColumn("w", wanted).where("size(w) > 0").join(done, "site_id", "left_anti").select("site_id", F.array_join("w", ",").alias("attributes"))
