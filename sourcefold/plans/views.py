"""Views that give the curation operators their inputs, derived from the given tables."""

from .registry import VIEWS

VIEWS["fx_sites"] = """
SELECT site_id, site_name, country, country_key, latitude, CASE WHEN raw < -180 THEN raw + 360 ELSE raw END AS longitude, area_square_meters, municipality, admin1, contributing_data_sources,
       reference_year, facility_type, facility_status, waste_in_place, backfilled_fields, attribute_sources, ai_filled_fields, has_gas
FROM (
  SELECT c_custkey AS site_id, c_name AS site_name, n_name AS country, CAST(n_nationkey AS BIGINT) AS country_key,
         CAST(-60 + n_nationkey * 5 AS DOUBLE) + CAST((c_custkey * 7919) % 1000 AS DOUBLE) / 1e3 AS latitude,
         CAST(n_nationkey * 15 AS DOUBLE) - 1805e-1 + CAST((c_custkey * 104729) % 1000 AS DOUBLE) / 1e3 AS raw,
         abs(c_acctbal) * 1e3 AS area_square_meters,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'M' || CAST(c_custkey % 40 AS STRING) END AS municipality, 'S' || CAST(c_custkey % 8 AS STRING) AS admin1,
         CASE c_custkey % 5 WHEN 0 THEN 'osm_2022' WHEN 1 THEN 'LMOP_2024' WHEN 2 THEN 'osm_2022 + waste_atlas_landfills_2013' WHEN 3 THEN 'manual_entry+mystery_2020' ELSE '' END AS contributing_data_sources,
         CAST(1990 + c_custkey % 30 AS INT) AS reference_year,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS facility_type,
         CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Closed' WHEN 2 THEN 'Open' WHEN 3 THEN ' ' WHEN 4 THEN 'closed since 2004' ELSE 'Inactive' END AS facility_status,
         CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE round(abs(c_acctbal), 0) END AS waste_in_place,
         CASE WHEN c_custkey % 4 = 0 THEN 'waste_in_place_metric_tonnes@' || CAST(1985 + c_custkey % 30 AS STRING) || '; facility_status@1999' WHEN c_custkey % 4 = 1 THEN 'noyear@x; @2001' ELSE '' END AS backfilled_fields,
         CASE c_custkey % 3 WHEN 0 THEN 'found_facility_name@lmop_2024; found_latitude@osm_2022; found_longitude@lmop_2024' WHEN 1 THEN 'found_latitude@sinir_2024; found_longitude@lmop_2024;bad' ELSE '' END AS attribute_sources,
         CASE c_custkey % 4 WHEN 0 THEN 'found_site_name@Tier 3; area@Tier 1' WHEN 1 THEN 'found_latitude@Tier 9' ELSE '' END AS ai_filled_fields,
         CASE c_custkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'FALSE' ELSE NULL END AS has_gas
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) t
"""

VIEWS["fx_facility_years"] = """
SELECT o_custkey AS facility_id, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS ord, o_orderkey % 3 AS run_id,
       CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS price
FROM {orders}
"""

VIEWS["fx_citations"] = """
SELECT o_custkey AS site_id, l_orderkey AS response_id, CAST(l_linenumber AS BIGINT) AS source_index, l_orderkey * 10 + l_linenumber AS ord,
       CASE l_suppkey % 4 WHEN 0 THEN 'https://www.Src' || CAST(l_suppkey AS STRING) || '.example/' || CAST(l_partkey % 7 AS STRING) || '/'
                          WHEN 1 THEN 'HTTP://src' || CAST(l_suppkey AS STRING) || '.example/A' || CAST(l_partkey % 7 AS STRING) || '#top'
                          WHEN 2 THEN 'src' || CAST(l_suppkey AS STRING) || '.maptons.com' ELSE 'https://m.src' || CAST(l_suppkey AS STRING) || '.example/p?q=' || CAST(l_partkey % 7 AS STRING) END AS url,
       CASE l_suppkey % 16 WHEN 0 THEN 'Regulator' WHEN 1 THEN 'Regulator / Court decision' WHEN 2 THEN 'EIA' WHEN 3 THEN 'Peer-reviewed article' WHEN 4 THEN 'News report, local'
            WHEN 5 THEN 'NGO report' WHEN 6 THEN 'Map / coordinate directory' WHEN 7 THEN 'Wiki or aggregator' WHEN 8 THEN 'blog' WHEN 9 THEN '' WHEN 10 THEN 'Operator website' WHEN 11 THEN 'Operator website / company profile'
            WHEN 12 THEN 'newswire' WHEN 13 THEN 'Municipal document | annex' WHEN 14 THEN 'Government statistics' ELSE NULL END AS source_type,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(year(l_shipdate) AS STRING) END AS publication_date,
       CASE WHEN l_partkey % 9 = 0 THEN '' ELSE 'Site No. ' || CAST(l_partkey % 11 AS STRING) || ' - Landfill' END AS facility_name,
       CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(-60 + (l_partkey % 25) * 5 AS DOUBLE) + CAST((l_partkey * 31) % 1000 AS DOUBLE) / 1e3 END AS latitude,
       CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST((l_partkey % 25) * 14 - 170 AS DOUBLE) + CAST((l_partkey * 37) % 1000 AS DOUBLE) / 1e3 END AS longitude
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEWS["fx_values"] = """
SELECT o_custkey AS site_id, l_suppkey AS source_id, l_orderkey * 10 + l_linenumber AS ord,
       CASE l_linenumber WHEN 1 THEN 'area' WHEN 2 THEN 'waste_depth_meters' WHEN 3 THEN 'facility_status' WHEN 4 THEN 'has_cover' WHEN 5 THEN 'cover_types' WHEN 6 THEN 'annual_incoming_waste_metric_tonnes' ELSE ' found_site_name ' END AS attribute,
       CASE l_linenumber WHEN 3 THEN CASE l_returnflag WHEN 'A' THEN 'Active' WHEN 'N' THEN 'open' ELSE 'Closed' END
                         WHEN 4 THEN CASE l_partkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'T' WHEN 3 THEN ' unknown ' WHEN 4 THEN 'maybe' ELSE '' END
                         WHEN 5 THEN CASE l_partkey % 4 WHEN 0 THEN 'sand; clay' WHEN 1 THEN 'clay,sand ; clay' WHEN 2 THEN '["sand", "clay"]' ELSE '' END
                         ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS value,
       CASE l_partkey % 6 WHEN 0 THEN 'acres' WHEN 1 THEN 'ha' WHEN 2 THEN '' WHEN 3 THEN 'sq. ft' WHEN 4 THEN 'square miles' ELSE 'furlongs' END AS unit,
       1 + l_suppkey % 5 AS tier,
       CASE l_partkey % 4 WHEN 0 THEN CAST(year(l_shipdate) AS STRING) WHEN 1 THEN CAST(year(l_shipdate) AS STRING) || '-' || CAST(month(l_shipdate) AS STRING)
            WHEN 2 THEN CAST(year(l_shipdate) AS STRING) || '-' || CAST(month(l_shipdate) AS STRING) || '-' || CAST(day(l_shipdate) AS STRING) ELSE NULL END AS value_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

VIEWS["fx_quantity"] = """
SELECT l_orderkey, l_linenumber, l_suppkey % 12 AS unit_kind,
       CASE l_partkey % 8 WHEN 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' 400 000' WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.400.000'
            WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ',4' WHEN 4 THEN '3-' || CAST(CAST(l_quantity AS INT) + 3 AS STRING) WHEN 5 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ',235,000'
            WHEN 6 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ' million' ELSE 'about ' || CAST(CAST(l_quantity AS INT) AS STRING) || '.5' END AS value,
       CASE l_suppkey % 12 WHEN 0 THEN 'tonnes/day' WHEN 1 THEN 'short tons per year' WHEN 2 THEN 'kg' WHEN 3 THEN 'lb per annum' WHEN 4 THEN 'tons' WHEN 5 THEN 'metric tons/month' WHEN 6 THEN 'acres' WHEN 7 THEN 'ft'
            WHEN 8 THEN 'miles' WHEN 9 THEN 't/h' WHEN 10 THEN 'long tons weekly' ELSE '' END AS unit
FROM {lineitem}
"""

VIEWS["fx_runlog"] = """
SELECT user_id AS site_id, event_type AS pass_label, event_id AS seq, CAST(floor(value) AS BIGINT) % 7 AS web_searches,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END AS input_tokens,
       CASE user_id % 5 WHEN 0 THEN 'terra-2' WHEN 1 THEN 'terra-2-mini' WHEN 2 THEN 'luna' WHEN 3 THEN '' ELSE 'unknown-model' END AS model
FROM {events}
"""

VIEWS["fx_links"] = """
SELECT url, CASE CAST(s % 6 AS INT) WHEN 0 THEN '200' WHEN 1 THEN '404' WHEN 2 THEN '403' WHEN 3 THEN '429' WHEN 4 THEN '500' ELSE 'timeout' END AS status,
       CASE WHEN s % 11 = 0 THEN url || '/fixed' ELSE NULL END AS resolved_url
FROM (SELECT url, min(ord) AS s FROM {fx_citations} GROUP BY url) t
"""

VIEWS["fx_crosswalk"] = """
SELECT l_partkey % 500 AS old_id, l_suppkey % 7 AS data_source, l_partkey AS record,
       CASE WHEN l_partkey % 1000 BETWEEN 503 AND 507 OR l_partkey % 10 = 1 THEN NULL WHEN l_partkey % 10 = 0 THEN l_partkey WHEN l_partkey % 10 = 2 THEN 100000 + l_partkey % 50 ELSE l_partkey % 500 END AS new_id
FROM {lineitem}
"""
