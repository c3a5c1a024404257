"""Names, selections, found values, evidence, page checks and places against plain Python, with their edges."""

import hashlib
import random

import pytest

from sourcefold.functions import geocoding, searchable, values
from sourcefold.operators import evidence, found, locate, page_check, selecting
from sourcefold.plans.catalog import QUERIES
from pyspark.sql import functions as F

# name, original, class
NAMES = [
    (None, None, "no name"), ("  ", "", "no name"), ("OpenStreetMap Landfill", "", "no name"), ("Sin nombre", "", "no name"),
    ("", "Vertedero El Salto", "named"), ("unnamed", "Landfill", "no name"), ("", "Halde 311", "no name"),
    ("see http://a.example", "", "not a name"), ("12/3 № 4", "", "not a name"), ("FIXME later", "", "not a name"), ("Is it?", "", "not a name"), ("L", "", "not a name"), ("Ж", "", "not a name"),
    ("Map 4", "", "not a name"), ("Section №1", "", "not a name"), ("card #12", "", "not a name"), ("Map Four", "", "named"), ("проспект Мира", "", "not a name"), ("ул. Мира 5", "", "not a name"),
    ("Blade 7", "", "mining feature"), ("Tailings Pond North", "", "mining feature"), ("Tailings Landfill Ipê", "", "named"), ("Halde 311", "", "mining feature"), ("Müllhalde Nord", "", "named"), ("Heap", "отвал 3", "mining feature"), ("pasa", "", "mining feature"), ("Pasadena", "", "named"),
    ("Landfill", "", "generic label"), ("Municipal Landfill (closed)", "", "generic label"), ("Relleno Sanitario Tipo C", "", "generic label"), ("Landfill II", "", "generic label"), ("Dump 1", "", "generic label"), ("Landfill A", "", "generic label"), ("бывшая свалка", "", "generic label"),
    ("GB Landfill", "", "named"), ("SR 85 Landfill", "", "named"), ("K & W Landfill", "", "named"), ("of Landfill", "", "generic label"), ("North Landfill", "", "named"), ("Municipal", "", "named"), ("Landfill/Dump", "", "generic label"), ("ruins", "", "generic label"),
]


def test_name_classes(spark):
    rows = spark.createDataFrame([(k, n, o) for k, (n, o, _) in enumerate(NAMES)], "k int, site_name string, original_name string").withColumn("sources", F.lit(None).cast("string"))
    told = {r["k"]: r["class"] for r in selecting.classed(rows).collect()}
    assert [(NAMES[k][0], told[k]) for k in sorted(told)] == [(n, c) for n, _, c in NAMES]
    only = spark.createDataFrame([("gpw_2021",), ("gpw_2021+osm_2022",), (" gpw_2021 + gpw_2021",), ("",), (None,)], "sources string")
    assert [r[0] for r in only.select(searchable.name_class(F.lit("Kettle Hill"), None, F.col("sources"))["class"]).collect()] == ["address only", "named", "address only", "named", "named"]


def brute_sample(rows, size, first):
    key = lambda r, salt: (hashlib.sha256("|".join([str(r[0]), r[1], r[2], salt]).encode()).hexdigest()[:16], str(r[0]))
    out, seen = [], set()

    def add(r, reason):
        if len(out) < size and r[0] not in seen:
            out.append((r[0], reason))
            seen.add(r[0])
            return True

    for country in first:
        for r in sorted((r for r in rows if r[2] == country), key=lambda r: key(r, "priority")):
            add(r, f"priority_country:{country}")
    turns, by = min(50, (size - len(out)) // 2), {}
    for r in sorted(rows, key=lambda r: key(r, "country_balance")):
        if r[2] and r[2] not in first:
            by.setdefault(r[2], []).append(r)
    order, taken, turn = sorted(by, key=lambda x: (-len(by[x]), x)), 0, 0
    while taken < turns and any(len(by[x]) > turn for x in order):
        for x in order:
            if taken < turns and len(by[x]) > turn:
                taken += bool(add(by[x][turn], f"country_balanced:{x}"))
        turn += 1
    hard = 0
    for r in sorted(rows, key=lambda r: key(r, "generic_hard_case")):
        if r[1] in ("Landfill", "") and hard < 30:
            hard += bool(add(r, "generic_name_hard_case"))
    for r in sorted(rows, key=lambda r: key(r, "deterministic_fill")):
        add(r, "deterministic_fill")
    return out


@pytest.mark.parametrize("size", [1, 7, 40, 130, 1000])
def test_mixed_sample(spark, size):
    rng = random.Random(size)
    rows = [(k, rng.choice(["Landfill", "", "Kettle Hill", "Mill"]), rng.choice(["A", "B", "C", "C", "C", "D", ""])) for k in range(150)]
    sites = spark.createDataFrame(rows + [(None, "x", "A")], "site_id long, site_name string, country string")
    told = sorted(selecting.mixed_sample(sites.unionByName(sites.limit(20)), size, ["B", "Z"]).collect(), key=lambda r: r.place)
    assert [(r.site_id, r.reason) for r in told] == brute_sample(rows, size, ["B", "Z"])
    assert [r.place for r in told] == list(range(1, len(told) + 1))


def test_mixed_sample_of_nothing(spark):
    none = spark.createDataFrame([], "site_id long, site_name string, country string")
    assert selecting.mixed_sample(none, 10, ["A"]).count() == 0
    assert selecting.mixed_sample(none, 0, []).count() == 0


def test_comparable(spark):
    said = [("4,200", "x", "4.20000e+03"), ("4200.0", "x", "4.20000e+03"), ("1e3", "x", "1.00000e+03"), (" North ", "x", "north"), (None, "x", ""), ("-0", "x", "0.00000e+00"), ("999999.6", "x", "1.00000e+06"), ("1000000", "x", "1.00000e+06"),
            ("clay; Sand;clay", "cover_types", "clay; sand"), ("sand, clay", "cover_types", "clay; sand"), ("1.50, 2", "found_location", "1.50000e+00, 2.00000e+00"), ("nan", "x", "nan"), ("1e999", "x", "1e999")]
    rows = spark.createDataFrame([(k, v, a) for k, (v, a, _) in enumerate(said)], "k int, v string, a string")
    assert [r[1] for r in sorted(rows.select("k", values.comparable(F.col("v"), F.col("a"))).collect())] == [x for _, _, x in said]


def test_collapse_and_closures(spark):
    rows = spark.createDataFrame(
        [(1, None, "owner", 2000, "A", "2001", True, 1, "r."), (1, None, "owner", 2001, "B", None, True, 2, "r."), (1, None, "owner", 2001, "B", None, True, 3, "r."), (1, None, "owner", 2000, "C", "2009", False, 4, "r."), (1, None, "owner", 2000, "a", "1990", True, 5, None),
         (2, "x", "rate", 2000, "1", None, False, 1, None), (2, "x", "rate", 2001, "2", None, True, 2, None)],
        "site_id int, review_id string, attribute string, year int, value string, value_date string, used boolean, ord int, status_reason string")
    told = {(r.site_id, r.year): (r.value, r.status_reason) for r in found.collapse_found(rows, ["rate"]).collect()}
    assert told == {(1, 2000): ("A", "r. The source also gives B (undated)."), (2, 2000): ("1", ""), (2, 2001): ("2", "")}
    said = spark.createDataFrame([(1, "facility_type", "Not a Waste Facility", None, 1, ""), (1, "closing_year", "2001", None, 2, ""), (1, "closing_year", "2001", False, 3, ""), (1, "facility_status", "Inactive", None, 4, ""), (1, "closing_year", "2030", True, 0, ""), (2, "facility_type", "Not a Waste Facility", None, 1, None), (None, None, None, None, 5, "x")],
                                 "site_id int, attribute string, value string, planned boolean, ord int, status_reason string")
    told = found.flag_closures(said, F.lit(True)).collect()
    assert len(told) == 7
    assert [r.status_reason for r in told if r.status_reason] == ["x", " CHECK: this run also found closing_year = 2001; facility_status = Inactive - is this a closed landfill misread as never a waste site?"]


def test_evidence_edges(spark):
    read = spark.createDataFrame(
        [(1, 0, 0, None, "regulator", "2001", "F", "owner", "x", None, None), (1, 1, None, "https://a.example", None, None, "G", None, None, None, None), (1, 2, 0, "https://sub.maptons.com/1", None, None, "H", "area", "1", "ha", None),
         (1, 3, 0, "https://b.example", None, None, "H", "owner", " y ", None, None), (1, 3, 1, "https://b.example", None, None, "H", "found_latitude", "1", None, None)],
        "site_id long, source_index long, value_index long, url string, source_type string, publication_date string, facility_name string, attribute_name string, value string, unit string, value_date string")
    links = spark.createDataFrame([("https://b.example", "404", None)], "url string, status string, resolved_url string")
    supported = ["owner", "area_square_meters"]
    told = {r.source_index: (r.excluded, r.normalized) for r in evidence.extracted(read, links, supported).collect()}
    assert told == {0: ("no link", "x"), 3: ("dead link", "y")}
    assert {r.source_index: r.excluded for r in evidence.extracted(read, links, supported, keep_broken=True).collect()} == {0: "no link", 3: None}
    assert sorted((r.source_index, r.n_values) for r in evidence.listed_sources(read, links, supported).collect()) == [(0, 1), (1, 0), (3, 1)]
    assert sorted(r.warning for r in evidence.warnings(read, supported).collect()) == ["Dropped 1 citation(s) of maptons.com: map sites that copy others are not used as sources.", "area_square_meters: every source was a dropped map site; not used."]
    assert evidence.extracted(read.limit(0), links.limit(0), supported).count() == 0


def test_pages_with_notes(spark):
    quote, here = "one thing that nobody said 777", "the tip took 500 tonnes in May"
    pages = spark.createDataFrame([("a", here, "html", None), ("b", here, "text", None), ("c", here, "html", "read in part"), ("d", here, "html", "little text"), ("e", here + " " + "and so on " * 20, "html", ""), ("f", None, "html", None)], "source_id string, text string, kind string, note string")
    rows = spark.createDataFrame([(p, q, "Mill Lane 98765", None, "rooftop", None, None) for p in [*"abcdefg", None] for q in (quote, here, None)], "source_id string, quote string, address string, coordinates string, basis string, lat double, lon double")
    told = {(r.source_id, r.quote): (r.quote_on_page, r.place_on_page) for r in page_check.checked_evidence(rows, pages).collect()}
    assert len(told) == 24
    for page, missing in {"a": "no page text", "b": "not found", "c": "not in the part read", "d": "no page text", "e": "not found", "f": "no page text", "g": "no page text", None: "no page text"}.items():
        there = "no page text" if page in ("d", "f", "g", None) else "found"
        assert told[page, quote] == (missing, missing)
        assert told[page, here] == (there, missing)
        assert told[page, None] == (None, missing)


def test_located_edges(spark):
    schema = "key int, url string, iso3 string, address string, coordinates string, names array<string>, town string, state string, latitude double, longitude double, earlier boolean"
    rows = spark.createDataFrame([(1, None, None, None, None, None, None, None, None, None, None), (2, None, "USA", "5 Mill Road", "95.1234, 200.1234", ["x"], "Springfield", None, None, None, None), (3, None, "USA", "5 Mill Road | 6 Mill Road", None, ["x"], "Springfield", None, None, None, None), (4, "u", "GBR", None, "TQ 310 806", None, None, None, 1.0, 2.0, True)], schema)
    cache = spark.createDataFrame([("usa", "6 Mill Road, Springfield", 1.5, 2.5, "street", None), ("USA", "5 Mill Road, Springfield", 9.0, 9.0, "", None)], "country string, address string, lat double, lon double, basis string, state string")
    told = {r.key: r for r in locate.locate_stated(rows, cache).collect()}
    assert (told[1].basis, told[1].reason) == ("none", "no location stated")
    assert told[2].basis == "none" and told[2].latitude is None
    assert (told[3].basis, told[3].latitude, told[3].longitude) == ("street", 1.5, 2.5)
    assert told[4].basis == "grid reference" and abs(told[4].latitude - 51.51) < 0.02 and told[4].rough is None
    assert locate.locate_stated(rows.limit(0), cache.limit(0)).count() == 0


def test_answers_of_services(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{}",), ('{"lat":"1,5","lon":"2"}',)], "a string")
    assert [r[0] for r in rows.select(geocoding.feature_answer(F.col("a"))).collect()] == [None] * 4
    told = [r[0] for r in rows.select(geocoding.result_answer(F.col("a"))).collect()]
    assert told[:3] == [None] * 3 and (told[3].lat, told[3].precision, told[3].described) == (15.0, "", "?=?, rank ?")


def test_failed_sites_of_a_pass_are_one_list(spark, tmp_path):
    # event 6k fails (no tokens); a value of 5 or 6 (modulo 7) is a search that was done
    rng = random.Random(10)
    log = [(k, rng.choice([None, *range(400)]), rng.choice(["click", "view", None]), float(rng.choice([0, 1, 4, 5, 6, 11]) if k % 6 else 1)) for k in range(9000)] + [(9000, None, "lost", 1.0), (9006, 7, "done", 6.0)]
    spark.createDataFrame(log, "event_id long, user_id long, event_type string, value double").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    done = {(u, t) for k, u, t, v in log if v % 7 > 4 and u is not None and t is not None}
    failed = {(u, t) for k, u, t, v in log if k % 6 == 0} - done
    wanted = {t: ",".join(sorted(str(u) for u, x in failed if x == t and u is not None)) or None for t in {t for _, t in failed}}
    told = QUERIES["sel10_retry_worklist"](spark, str(tmp_path)).collect()
    assert len(told) == len(wanted) and {r.pass_label: r.sites for r in told} == wanted
    assert wanted["lost"] is None and "done" not in wanted and len(wanted["click"].split(",")) > 20


def test_listed_joins_ranges_in_order(spark):
    rows = [(g, v) for g in ("a", "b", None) for v in (range(3000) if g == "a" else [5, 40, None])] + [("c", None)]
    told = selecting.listed(spark.createDataFrame(rows, "g string, v long").repartition(5), "g", "v", "vs")
    assert {r.g: r.vs for r in told.collect()} == {"a": ",".join(sorted(map(str, range(3000)))), "b": "40,5", None: "40,5", "c": None}
    assert selecting.listed(spark.createDataFrame([], "g string, v long"), "g", "v", "vs").count() == 0
