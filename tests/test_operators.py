"""Operators on literal rows, and what must hold whatever the order of the rows."""

import dataclasses
import math
import random

from pyspark.sql import functions as F

from sourcefold.functions import dates, grids, links, names, points, text, tiers, units, values
from sourcefold.operators import evidence, nested, pages, pairs, resolve, review, seed, spatial, upsert
from sourcefold.sources import tables
from sourcefold.streaming import run_log

c = F.col


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(c("x")).alias("r")).first().r


def test_numbers_and_units(spark):
    cases = {"1 400 000 t": [1400000.0], "1.400.000": [1400000.0], "1.234,5": [1234.5], "1,235,000": [1235000.0], "1,4 millones": [1.4], "3-8 metres": [3.0, 8.0], "-5": [-5.0], "45.000": [45.0], "1e3": [1000.0], "": []}
    for said, wanted in cases.items():
        assert one(spark, units.numbers, said) == wanted, said
    assert one(spark, lambda x: units.magnitude(x, F.lit("millones de toneladas")), "1,4") == 1e6
    unit = lambda x: units.unit_text(x)
    assert one(spark, unit, "MMSCFD") == "mmcf/day" and one(spark, unit, "metric tons per yr") == "metric tonnes/year"
    assert one(spark, lambda x: units.factor(units.unit_text(x), units.MASS), "tons") is None
    assert one(spark, lambda x: units.factor(units.unit_text(x), units.AREA), "sq mi") == 2589988.110336
    assert one(spark, lambda x: units.stock_factor(units.unit_text(x)), "t/day") is None


def test_links(spark):
    assert one(spark, links.url_key, "HTTPS://www.Example.org/A/?q=1#x") == "https://example.org/A/?q=1"
    assert one(spark, links.url_key, "example.org/Path/") == "https://example.org/Path"
    assert one(spark, lambda x: links.of_site(x, links.MIRRORS), "ca.maptons.com/1") == "maptons.com"
    assert one(spark, lambda x: links.of_site(x, links.MIRRORS), "https://notmaptons.com") is None
    assert one(spark, links.url_variants, "https://a.b/x%2Cy") == ["https://a.b/x,y", "https://a.b/x,y/"]
    assert [one(spark, links.verdict, s) for s in ("200", "410", "503")] == ["OK", "Broken", "Unverified"]


def test_tiers(spark):
    tier = lambda kind, date: spark.range(1).select(tiers.source_tier(F.lit(kind), F.lit(date)).alias("r")).first().r
    assert tier("Regulator", "2001") == 1 and tier("Regulator", None) == 3 and tier("NGO report", None) == 3
    assert tier("EIA", "2001") == 1 and tier("Wiki or aggregator", "") == 4 and tier("blog", "2001") == 5 and tier(None, None) == 5
    assert one(spark, lambda x: tiers.baseline_tier(x)[0], "osm_2022 + LMOP_2024") == 1
    assert one(spark, text.provenance, "a@x; b@y@z;bad; a@w") == {"b@y": "z", "a": "w"}


def test_dates_and_bands(spark):
    assert one(spark, lambda x: dates.date_key(x), "2004-3") == (2004, 3, 0)
    assert one(spark, lambda x: dates.value_year(x, 2026), "1949-01") == 2026 and one(spark, lambda x: dates.value_year(x, 2026), "2027") == 2026
    band = lambda lo, hi: spark.range(1).select(text.depth_band(F.lit(lo), F.lit(hi))[0].alias("r")).first().r
    assert band(3.0, 5.0) == "<=5m" and band(5.5, 9.0) == ">5m" and band(4.0, 6.0) is None and band(0.0, 0.0) is None


def test_names(spark):
    assert one(spark, names.distinctive_words, "Kettle Hill Sanitary Landfill Ltd EPR/BV7877IR") == ["hill", "kettle"]
    pair = lambda a, b: spark.range(1).select(names.containment(names.distinctive_words(F.lit(a)), names.distinctive_words(F.lit(b))).alias("r")).first().r
    assert pair("North Kettle Landfill", "South Kettle Landfill") == 0.0 and pair("Kettle North", "Kettle Landfill") == 1.0 and pair("Landfill", "Kettle") is None
    assert one(spark, names.plain, "Café — 5% Straße") == "cafe 5 percent strasse"
    same = lambda a, b: spark.range(1).select(names.same_operator(F.lit(a), F.lit(b)).alias("r")).first().r
    assert same("H. Ayuntamiento de Tixkokob 2024", "Ayuntamiento de Tixkokob") and not same("Ayuntamiento de Tixkokob", "Ayuntamiento de Motul") and same("Hidro Limpieza", "Hidrolimpieza")


def test_points(spark):
    assert tuple(one(spark, points.decimal_point, "51.507 N, 0.128 W")) == (51.507, -0.128)
    assert tuple(one(spark, points.decimal_point, "POINT(-0.128 51.507)")) == (51.507, -0.128)
    assert one(spark, points.decimal_point, "95.5, 10.2") is None
    assert abs(one(spark, points.single_coordinate, "51°30'26\" S") + 51.507222) < 1e-6 and one(spark, points.single_coordinate, "51°75'") is None


def test_fold_keeps_newest_values_and_stamps_older_ones(spark):
    rows = [(1, 2001, 1, "a", 5.0), (1, 2003, 2, " ", None), (1, 2002, 3, "b", float("nan")), (2, 2000, 4, None, None)]
    found = {r.k: r for r in seed.fold_years(spark.createDataFrame(rows, "k int, year int, ord int, status string, price double"), "k", identity=["status"], varying={"price": "double"}).collect()}
    assert (found[1].status, found[1].price, found[1].backfilled_fields, found[1].reference_year) == ("b", 5.0, "price@2001", 2003)
    assert found[2].status is None and found[2].backfilled_fields == ""


def test_pick_does_not_depend_on_partitions(spark):
    rows = spark.range(3000).selectExpr("id % 50 AS k", "id % 4 AS tier", "make_date(2000 + id % 7, 1, 1) AS d", "id % 9 AS v", "id % 31 AS src", "id % 500 AS ord")
    pick = lambda r: sorted(map(tuple, resolve.pick_values(r, ["k"], tier="tier", date="d", value="v", source="src", order=["ord"]).collect()))
    first = pick(rows)
    assert len(first) == 50 and first == pick(rows.repartition(7, "v")) == pick(rows.orderBy(F.desc("ord")).coalesce(1))


def test_outcomes(spark):
    held = spark.createDataFrame([(1, None, 5, 2000), (2, "a", 3, 2000), (3, "a", 3, 2000), (4, "a", 1, 2000), (5, "a", 2, 2000), (6, "a", 1, 2000)], "k int, held string, held_tier int, held_year int")
    ev = spark.createDataFrame([(1, "x", 5, 1), (2, "a", 2, 1), (3, "x", 2, 1), (4, "x", 2, 2001), (5, "x", 4, 2001), (6, "x", 3, 2009)], "k int, value string, tier int, year int")
    ev = ev.withColumns({"date": F.make_date(F.col("year") + 1000, F.lit(1), F.lit(1)), "source": F.lit("s"), "ord": F.lit(1)})
    told = {r.k: r.outcome for r in resolve.arbitrate(ev, held, ["k"], recent=True).collect()}
    assert told == {1: "Filled empty baseline", 2: "Confirmed baseline", 3: "Overrides baseline", 4: "Conflict - lower credibility", 5: "Conflict - lower credibility", 6: "Overrides baseline"}


def test_near_joins_wrap_around_the_date_line(spark):
    a = spark.createDataFrame([(1, 0.0, 179.99), (2, 89.0, 10.0)], "site_id int, latitude double, longitude double")
    b = spark.createDataFrame([(7, 0.0, -179.99, 0.0), (8, 89.0, 11.0, 0.0), (9, 5.0, 5.0, 0.0)], "other_id int, other_latitude double, other_longitude double, area double")
    found = {(r.site_id, r.other_id) for r in spatial.near(a, b, 10).collect()}
    assert found == {(1, 7), (2, 8)}


def test_pairs_and_greedy_places(spark):
    rows = spark.createDataFrame([(1, 1, 0.0, 0.0), (1, 2, 0.01, 0.0), (1, 3, 1.0, 0.0), (2, 1, 5.0, 5.0)], "k int, ord int, latitude double, longitude double")
    assert {r.k: r.places for r in pairs.merged_points(rows, "k").collect()} == {1: 2, 2: 1}
    shared = spark.createDataFrame([(1, "p", "n"), (2, "p", "n"), (3, "p", "m")], "site_id int, page string, name string")
    assert {(r.site_id, r.other_site) for r in pairs.shared_pages(shared).collect()} == {(1, 2), (2, 1)}


def test_visible_text_and_quotes(spark):
    html = "<html><head><title>t</title></head><body><script>x</script><p>One&amp;two</p><div>three<br>four</div></body></html>"
    assert pages.visible_text(html) == "One&two\nthree\nfour" and pages.visible_text(None) is None
    page = spark.createDataFrame([(1, "The landfill took 1200 tonnes a year of munici-\npal waste from the district."), (2, "")], "id int, text string")
    quotes = spark.createDataFrame([(1, "took 1200 tonnes"), (1, "The landfill ... municipal waste"), (1, "landfill took tonnes year municipal waste from district"), (1, "took 1300 tonnes a year"), (1, "too few"), (9, "no such page here")], "id int, quote string")
    assert [r.result for r in pages.quote_results(quotes, page, "id").orderBy("quote").collect()] == ["found", "partly", "no page text", None, "found", "not found"]


def test_decisions(spark):
    decisions = spark.createDataFrame([("a", 1, "correct", None), ("b", 1, "different", None), ("c", 1, "different", 1), ("d", 1, "maybe", None), ("e", 2, "correct", None), ("e", 2, "junk", None)], "review_id string, site_id int, decision string, other_site_id int")
    found = {(r.review_id, r.fault) for r in review.faults(decisions, spark.createDataFrame([(1,), (2,)], "site_id int")).collect()}
    assert found == {("b", "other site missing"), ("c", "other site is itself"), ("d", "unknown decision"), ("e", "decided twice")}


def test_ids_split_merge_and_get_lost(spark):
    rows = [(1, 0, 1, 10), (2, 0, 2, 20), (2, 0, 3, 21), (3, 0, 4, None), (4, 0, 5, 40), (4, 0, 6, None), (5, 0, 7, 50), (6, 0, 8, 50)]
    found = {r.old_id: r.status for r in upsert.map_ids(spark.createDataFrame(rows, "old_id int, data_source int, record int, new_id int")).collect()}
    assert found == {1: "mapped", 2: "split", 3: "unmapped", 4: "partly", 5: "merged", 6: "merged"}


def test_run_log_stream_adds_counters_once(spark, tmp_path):
    schema = "site_id int, pass_label string, seq int, web_searches long, model string"
    spark.createDataFrame([(1, "a", 1, 2, "m"), (1, "a", 2, 3, "")], schema).write.json(str(tmp_path / "in"))
    for more in ([], [(1, "a", 3, 5, "n"), (2, "b", 4, 1, "m")]):
        if more:
            spark.createDataFrame(more, schema).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        run_log.keep_run_log(stream, str(tmp_path / "log"), str(tmp_path / "state"), ["site_id", "pass_label"], ["web_searches"]).awaitTermination()
    found = {r.site_id: (r.seq, r.web_searches, r.model) for r in run_log.current_log(spark.read.parquet(str(tmp_path / "log")), ["site_id", "pass_label"], ["web_searches"]).collect()}
    assert found == {1: (3, 10, "n"), 2: (4, 1, "m")}


def test_pinned_rows_and_replies(spark, tmp_path):
    rows = spark.range(5)
    tables.pinned(rows, str(tmp_path / "p"))
    assert tables.pinned(rows.repartition(2), str(tmp_path / "p")).count() == 5
    try:
        tables.pinned(spark.range(6), str(tmp_path / "p"))
        raise AssertionError("other rows must be refused")
    except ValueError:
        pass
    get = lambda x: one(spark, lambda t: tables.tolerant_json(t, "a int")["a"], x)
    assert get('{"a": 1}') == 1 and get('```json\n{"a": 2}\n```') == 2 and get('So: {"a": 3}.') == 3 and get("none") is None


def test_written_numbers(spark):
    from sourcefold.functions import units

    wanted = {"1 400": [1400.0], "1.400.000": [1400000.0], "1,4": [1.4], "3 - 8": [3.0, 8.0], "-5": [-5.0], "1.5e-2": [0.015], "1,400,000.5": [1400000.5], "1.234,5": [1234.5], "140.000": [140.0], "1400.000": [1400000.0], "10 t (2 300)": [10.0, 2300.0], "none": []}
    rows = spark.createDataFrame([(v,) for v in wanted] + [(None,)], "v string")
    found = {r.v: r.n for r in rows.select("v", units.numbers(F.col("v")).alias("n")).collect()}
    assert found == wanted | {None: []}


def test_grid_references(spark):
    cases = {
        ("TG 51409 13177", "GBR"): (52.65798, 1.71605), ("O 15904 34671", "IRL"): (53.3498, -6.26024), ("ITM 715830 734697", ""): (53.3498, -6.2602),
        ("Licence W0123, grid ref T 285 935", "IRL"): "fine", ("TQ 28 80", "GBR"): "coarse",
        ("E 531090 N 180600", "gbr"): "same", ("Easting: 531090 Northing: 180600", "GBR"): "same", ("N 180600, E 531090", "GBR"): "same",
        ("E 531090 N 180600", "FRA"): None, ("T 285 935", "FRA"): None, ("TQ 285 93", "GBR"): None, ("ZZ 285 935", "GBR"): None, ("", ""): None, (None, "GBR"): None, ("x" * 100_000, None): None,
    }
    rows = spark.createDataFrame([(k, *said) for k, said in enumerate(cases)], "k int, said string, country string")
    # the worked example that the survey publishes for its own datum
    own = dataclasses.replace(grids.BRITISH, shift=(0.0, 0.0, 0.0), turn=(0.0, 0.0, 0.0), stretch=0.0)
    example = grids.to_wgs84(F.lit(651409.903) + c("k") * 0, F.lit(313177.270), own)
    found = sorted(rows.select("k", grids.grid_reference(c("said"), c("country")).alias("p"), example.alias("example")).collect())
    assert abs(found[0].example.lat - (52 + 39 / 60 + 27.2531 / 3600)) < 1e-8 and abs(found[0].example.lon - (1 + 43 / 60 + 4.5177 / 3600)) < 1e-8
    read = [(wanted, row.p) for wanted, row in zip(cases.values(), found)]
    for wanted, p in read:
        if wanted is None:
            assert p is None
        elif isinstance(wanted, tuple):
            assert abs(p.lat - wanted[0]) < 5e-5 and abs(p.lon - wanted[1]) < 5e-5, p
    assert len({p for wanted, p in read if wanted == "same"}) == 1
    by_name = {wanted: p for wanted, p in read if isinstance(wanted, str)}
    assert by_name["fine"].basis == "grid reference" and by_name["fine"].uncertainty_km is None
    assert by_name["coarse"].basis == "hint" and abs(by_name["coarse"].uncertainty_km - 0.7071) < 1e-3


def test_methane_volumes(spark):
    read = lambda value, unit: one(spark, lambda x: values.ch4_tonnes(x, F.lit(unit)), value)
    assert abs(read("5 million", "cubic feet") - 96) < 1e-9
    assert abs(read("1000", "ft³") - 0.0192) < 1e-12 and abs(read("1000", "m³/day") - 0.679 * 365) < 1e-9
    assert read("10", "m3 landfill gas") is None and read("10", "m3 landfill gas (methane part)") is not None and read("10 CH4", "m3 LFG") is not None
    assert read("10", "t CO2e") is None and read("10", "tonnes") is None and read("", "m3") is None and read(None, "m3") is None


def test_units_are_read_in_several_languages(spark):
    from sourcefold.functions import units, values

    said = {"sq. ft": "sq. ft", "lb per annum": "lb/year", "metric tons/month": "metric tonnes/month", "квадратных метров": "square meters", "м3/час": "cubic meters/hour", "ft³ per day": "ft3/day", "Tonnen pro Tag": "tonnes/day", "kubikmeter": "cubic meters", "": "", None: "", "Mg": "tonnes", "mg": "mg", "ton/día": "tonnes/day", "tons/day": "tons/day", "metros cúbicos por hora": "cubic meters/hour", "toneladas métricas anuales": "tonnes/year", "кв. метр": "square meters", "/day": "/day"}
    rows = spark.createDataFrame(list(enumerate(said)), "i int, u string")
    assert {r.u: r.t for r in rows.select("u", units.unit_text(F.col("u")).alias("t")).collect()} == said
    big = [("5", "mm", 1.0), ("5", "k", 1.0), ("5 mm", "", 1e6), ("1.2", "million tonnes", 1e6), ("1,4", "millones de toneladas", 1e6), ("3", "mil millones de t", 1e9), ("5 mil", "t", 1e3), ("2", "тыс. тонн", 1e3), ("2 bn", None, 1e9), ("5k", "", 1.0), ("5", "miles", 1.0), (None, None, 1.0)]
    assert [r.m for r in spark.createDataFrame(big, "v string, u string, w double").select(units.magnitude(F.col("v"), F.col("u")).alias("m")).collect()] == [w for *_, w in big]
    cases = [("annual_incoming_waste_metric_tonnes", "1,4", "millones de toneladas por año", "1400000"), ("annual_incoming_waste_metric_tonnes", "20 Mg/a", "", "20"), ("area_square_meters", "3", "hectáreas", "30000"), ("area_square_meters", "about 35.5", "", "35.5"), ("waste_in_place_metric_tonnes", "5", "t/day", None), ("annual_incoming_waste_metric_tonnes", "7", "tons", None)]
    table = spark.createDataFrame(cases, "a string, v string, u string, w string")
    assert [r.n for r in table.select(values.normalised(F.col("a"), F.col("v"), F.col("u"))[0].alias("n")).collect()] == [w for *_, w in cases]


def test_similar_names_work_once_for_each_pair_of_names(spark, monkeypatch):
    from difflib import SequenceMatcher

    monkeypatch.setattr(pairs, "BLOCK", 3)
    rng = random.Random(3)
    lists = [["bolt", "large"], ["bolt", "small"], ["large", "north", "ring"], ["ring", "south"], ["2", "bolt"], ["plate"], []]
    rows = [(k, rng.choice("AB"), rng.choice(lists)) for k in range(120)]
    shares = {}
    for x in lists:
        for y in lists:
            r = spark.range(1).select(names.containment(F.array(*map(F.lit, x)).cast("array<string>"), F.array(*map(F.lit, y)).cast("array<string>")).alias("r")).first().r if set(x) & set(y) else None
            shares[" ".join(x), " ".join(y)] = r
    want = set()
    for a, g, x in rows:
        for b, h, y in rows:
            if a < b and g == h and set(x) & set(y):
                inside = shares[" ".join(x), " ".join(y)]
                want.add((a, b, inside, inside and max(inside, SequenceMatcher(None, " ".join(x), " ".join(y)).ratio())))
    found = pairs.similar_names(spark.createDataFrame(rows, "id long, g string, ws array<string>"), "id", "g", "ws").collect()
    assert len(found) == len(want) and set(map(tuple, found)) == want


def crowded(rng, n):
    """Sites of two countries, many at the same points, some without a town or a place."""
    rows = []
    for k in range(n):
        lat, lon = rng.choice([60.0, 60.05, 60.4]) + rng.choice([0.0, 0.01, 0.02]), rng.choice([179.9, -179.95, 179.2])
        rows.append((k, rng.choice([1, 2]), lat if rng.random() < 0.95 else None, lon, rng.choice(["M1", "M2", None]), rng.choice(["S1", "S2"]), rng.choice([0.0, 5e6, None])))
    return rows


def km_between(a, b, c, d):
    half = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(half, 1)))


SITES = "site_id long, country_key long, latitude double, longitude double, municipality string, admin1 string, area double"


def test_nearest_others_by_brute_force(spark):
    rows = crowded(random.Random(1), 150)
    want = {}
    for a in rows:
        found = []
        for b in rows:
            if a[0] != b[0] and a[1] == b[1] and None not in (a[2], b[2]):
                km = km_between(a[2], a[3], b[2], b[3])
                if km <= 15 or (km <= 60 and a[4] and a[4:6] == b[4:6]):
                    found.append((round(km, 9), b[0]))
        if found:
            want[a[0]] = [km for km, _ in sorted(found)[:4]], sorted(found), max(len(found) - 4, 0)
    got = spatial.nearest_others(spark.createDataFrame(rows, SITES), "site_id", "country_key", ["municipality", "admin1"], 15, 60, 4).collect()
    assert {r.site_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        kms, found, more = want[r.site_id]
        of = {other: km for km, other in found}
        ids = [int(x) for x in r.nearest.split(",")]
        # distances that differ in the last bit may change places
        assert r.more == more and [of[x] for x in ids] == kms and len(set(ids)) == len(ids)
    lone = spatial.nearest_others(spark.createDataFrame([(k, 1, 0.0, 0.0, None, "S", 0.0) for k in (5, 3, 9, 1)], SITES), "site_id", "country_key", ["municipality", "admin1"], 15, 60, 2)
    assert {r.site_id: (r.nearest, r.more) for r in lone.collect()} == {1: ("3,5", 1), 3: ("1,5", 1), 5: ("1,3", 1), 9: ("1,3", 1)}


def test_nearest_sites_of_equal_points(spark):
    rng = random.Random(2)
    sites = [(r[0], r[2], r[3], r[6]) for r in crowded(rng, 60)]
    points = [(k, rng.choice([60.0, 61.0, 65.0, -60.0]), rng.choice([179.9, -179.0])) for k in range(40)] + [(99, None, 1.0)]
    want = {}
    for k, lat, lon in points:
        found = [(max(km_between(lat, lon, s[1], s[2]) - min(math.sqrt((s[3] or 0.0) / math.pi) / 1000, 2.0), 0.0), s[0]) for s in sites if None not in (lat, s[1])]
        if found and min(found)[0] <= 1000:
            want[k] = min(found)[0]
    places = spark.createDataFrame(sites, "site_id long, other_latitude double, other_longitude double, area double")
    got = {r.k: r for r in spatial.nearest(spark.createDataFrame(points, "k long, latitude double, longitude double"), places, "k").collect()}
    assert set(got) == set(want) and all(abs(got[k].km - km) < 1e-6 for k, km in want.items())


def test_spread_points_are_never_broadcast(spark):
    a = spark.createDataFrame([(1, 0.0, 179.99)], "site_id int, latitude double, longitude double")
    b = spark.createDataFrame([(7, 0.0, -179.99)], "other_id int, other_latitude double, other_longitude double")
    assert "Broadcast" not in spatial.near(a, b, 1000, degrees=5.0)._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_written_out_behind_the_join(spark, monkeypatch):
    monkeypatch.setattr(pairs, "BLOCK", 4)
    rows = crowded(random.Random(4), 90)
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and None not in (a[2], b[2]) and max(km_between(a[2], a[3], b[2], b[3]) - min(math.sqrt((b[6] or 0.0) / math.pi) / 1000, 2.0), 0) <= 25}
    sites = spark.createDataFrame(rows, SITES)
    found = spatial.all_near(sites, sites.selectExpr("site_id AS other_id", "latitude AS other_latitude", "longitude AS other_longitude", "area"), "site_id", "other_id", 25, edge_area="area").collect()
    assert len(found) == len(want) and {(r.site_id, r.other_id) for r in found} == want


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_passes_are_merged_without_a_join(spark):
    rows = [(1, 0, 0, 0), (1, 0, 0, 1), (1, 0, 1, 0), (1, 1, 0, 0), (1, 2, None, None), (2, 1, 3, 0), (None, 1, 0, 0)]
    read = nested.merged_passes(spark.createDataFrame(rows, "site_id long, pass long, source_index int, value_index int"))
    assert "Join" not in plan_of(read)
    assert sorted(map(tuple, read.collect())) == [(1, 0, 0, 0, 0), (1, 0, 0, 1, 0), (1, 0, 1, 0, 1), (1, 1, 0, 0, 2), (2, 1, 3, 0, 0)]


def test_listed_sources_are_shuffled_once(spark):
    flat = spark.createDataFrame([(s, p, k, f"https://a{k}.example", "t", "2001", "n", v, "owner", "x", "ha", "2001") for s in (1, 2) for p in (0, 1) for k in (1, 2) for v in (1, 2)], "site_id long, pass long, source long, url string, source_type string, publication_date string, facility_name string, place long, attribute_name string, value string, unit string, value_date string")
    read = nested.merged_passes(nested.read_sources(nested.responses(flat.repartition("site_id")))).drop("source_index").withColumnRenamed("merged_index", "source_index")
    links = spark.createDataFrame([("https://a1.example", "200", "https://b.example")], "url string, status string, resolved_url string")
    listed = evidence.listed_sources(read, links, ["owner"])
    assert plan_of(listed).count("Exchange hashpartitioning") == 1
    want = {(s, i, "https://b.example" if i % 2 == 0 else "https://a2.example", "n", 2) for s in (1, 2) for i in range(4)}
    assert set(map(tuple, listed.collect())) == want
