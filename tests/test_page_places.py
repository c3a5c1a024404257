"""Coordinates, address phrases and quotes in texts, and the joins that use them."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sourcefold.functions import coordinates, phrases
from sourcefold.operators import page_places, pages
from sourcefold.plans.catalog import ORACLES, QUERIES

# text, country, latitude, longitude, basis; a reason alone where there is no point
SPELLINGS = [
    ("48.8434, -87.4296", "", 48.8434, -87.4296, "coordinates"),
    ("48.8434°N 87.4296°W", "", 48.8434, -87.4296, "coordinates"),
    ("N 48.8434 W 87.4296", "", 48.8434, -87.4296, "coordinates"),
    ("N48.8434 W87.4296", "", 48.8434, -87.4296, "coordinates"),
    ("63° 43' 58.15\" N, 68° 30' 1.5\" W", "", 63.7328194, -68.5004167, "coordinates"),
    ("51°30.25'N 0°7.5'W", "", 51.504167, -0.125, "hint"),
    ("48,8434; 2,3488", "", 48.8434, 2.3488, "coordinates"),
    ("POINT(-75.6972 45.4215)", "", 45.4215, -75.6972, "coordinates"),
    ("19.4326, 98° 50’ 42.8” O", "MEX", 19.4326, -98.845222, "coordinates"),
    ("52.1234 N 13.4567 O", "deu", 52.1234, 13.4567, "coordinates"),
    ("49.1234 North, 97.1234 West", "", 49.1234, -97.1234, "coordinates"),
    ("lon -87.43212, lat 48.84321", "", 48.84321, -87.43212, "coordinates"),
    ("45.42311 (lat), -75.70122 (long)", "", 45.42311, -75.70122, "coordinates"),
    ("Longitude/Latitude: -75.6972, 45.4215", "", 45.4215, -75.6972, "coordinates"),
    ("12.345 ha at 48.8434, -87.4296", "", 48.8434, -87.4296, "coordinates"),
    ("1.5 km north of 48.8434, -87.4296", "", 48.8434, -87.4296, "coordinates"),
    ("98.7654, 19.4321", "", 19.4321, 98.7654, "coordinates"),
    ("latitud sur 33.4567, longitud oeste 70.6543", "CHL", -33.4567, -70.6543, "coordinates"),
    ("33.4567 latitud sur; 70.6543 longitud oeste", "CHL", -33.4567, -70.6543, "coordinates"),
    ("Latitude S: 33.4567 Longitude W: 70.6543", "", -33.4567, -70.6543, "coordinates"),
    ("−33.4567, −70.6543", "", -33.4567, -70.6543, "coordinates"),
    ("48.84, -87.43", "", 48.84, -87.43, "hint"),
    ("95.1234, 200.1234", "", None, None, None),
    ("0.000, 0.000", "", None, None, None),
]


@pytest.mark.parametrize("text,country,lat,lon,basis", SPELLINGS)
def test_spellings_of_coordinates(text, country, lat, lon, basis):
    found = coordinates.stated(text, country)
    if basis is None:
        assert found[:3] == (None, None, None) and "out of range" in found[3]
    else:
        assert found[:2] == pytest.approx((lat, lon), abs=1e-5) and found[2] == basis


@pytest.mark.parametrize("text", ["", None, "12 Mill Road", "1.2.3.4 and 10.0.0.1", "48.8434", "version 2.345.6", "12.5 km, 13.5 ha", "9" * 50_000])
def test_texts_without_coordinates(text):
    assert coordinates.stated(text) is None


def test_random_spellings_are_read_back(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lat, lon = round(rng.uniform(-89, 89), 4), round(rng.uniform(-179, 179), 4)
        sides = ("NS"[lat < 0], "EW"[lon < 0])
        parts = []
        for value, side, axis in zip((lat, lon), sides, ("lat", "long")):
            minutes = (abs(value) % 1) * 60
            parts.append(rng.choice([f"{abs(value):.4f}°{side}", f"{abs(value):.4f} {side}", f"{side} {abs(value):.4f}", f"{axis} {value:.4f}", f"{int(abs(value))}° {int(minutes)}' {(minutes % 1) * 60:.2f}\" {side}", f"{int(abs(value))}º{minutes:.4f}′ {side}"]))
        if rng.random() < 0.3 and not any(p.startswith(("N ", "S ", "E ", "W ")) for p in parts):
            parts.reverse()
        rows.append((i, f"{rng.choice(['', 'The gate: ', 'Site 12, 3.5 ha; ', 'GPS '])}{parts[0]}{rng.choice([', ', '; ', ' / '])}{parts[1]}", lat, lon))
    table = spark.createDataFrame(rows, "i int, t string, lat double, lon double").withColumn("p", coordinates.stated_point(F.col("t")))
    for r in table.collect():
        assert r.p.basis == "coordinates" and (r.p.lat, r.p.lon) == pytest.approx((r.lat, r.lon), abs=2e-5), r.t


def test_strict_coordinates_stand_alone():
    assert coordinates.stated("GPS coordinates: 48.8434 N, 87.4296 W (WGS84)", strict=True)
    assert coordinates.stated("12 Mill Road, 48.8434, -87.4296", strict=True) is None
    assert coordinates.stated("48.8434, -87.4296, 12.3456", strict=True) is None


def test_points_of_a_page_and_their_places():
    text = "Head. " + "word " * 5000 + "A: 48.1234, 2.3456; B: 49.2222 N, 3.3333 E" + " filler" * 5000 + " lat 12.345" + " x" * 60 + " lon 13.456"
    found = list(coordinates.on_page(text))
    assert [text[a:b] for a, b, *_ in found][0] == "48.1234, 2.3456" and (48.1234, 2.3456) in [x[2:4] for x in found] and (49.2222, 3.3333) in [x[2:4] for x in found]
    assert all(abs(x[2] - 12.345) > 1e-6 for x in found), "too far apart"


def test_address_phrases():
    cut = lambda t: (lambda s: t[slice(*s)] if s else None)(phrases.address(t))
    said = {"Visit 12 Otaihanga Road.": "12 Otaihanga Road.", "at 4800 Old Highway 99": "4800 Old Highway", "200 tonnes a day by road": None, "en Calle Mayor 15, bajo": "Calle Mayor 15", "via Roma, n. 7": "via Roma, n. 7", "an der Hauptstraße 12b steht": "Hauptstraße 12b", "Lot 5 of Concession 12": "Lot 5 of Concession 12", "12 January": None, "": None, "x" * 100_000 + " 7 High St": "7 High St"}
    for text, want in said.items():
        assert cut(text) == want, text[:40]
    assert phrases.postcode("to SW1A 1AA or K1A 0B1", ["CAN", "GBR"]) == (15, 22) and phrases.postcode("SW1A 1AA", ["FRA"]) is None
    assert phrases.address("1 " * 100_000 + "A" * 100_000) is None


def test_other_numbers_are_no_house_numbers():
    for text in ["Call +1 (258) 555-4892 Erinou st or", "+44 20 7946 0958 Thea Way", "(030) 555-1234 Ther St", "Osgata 55.63.178.14 and", "via Roma 10.12.13.14", "Osgata 12@mail.example"]:
        assert phrases.address(text) is None, text
    cut = lambda t: t[slice(*phrases.address(t))]
    assert cut("+1 (258) 555-4892 Erinou st, 12 Mill Road") == "12 Mill Road" and cut("Unit 3 12 Mill Road") == "12 Mill Road"
    assert cut("+1 258 555 4892 12 Mill Road") == cut("Call (030) 555-1234\n12 Mill Road") == cut("+44 20 79\n12 Mill Road") == "12 Mill Road"
    assert cut("Osgata 55.63.178.14, Lagata 7.") == "Lagata 7" and cut("Osgata 10-12") == "Osgata 10"


def test_missed_locations_by_brute_force(spark):
    rng = random.Random(4)
    sites = [(s, rng.uniform(-60, 60), rng.uniform(-179, 179), rng.choice(["GBR", "FRA", None])) for s in range(12)] + [(50, None, None, "GBR")]
    place = {s[0]: s for s in sites}
    texts, cites = [], []
    for p in range(80):
        own = rng.sample(range(12), rng.randint(1, 4)) + ([50] if p % 9 == 0 else [])
        cites += [(p, s, rng.random() < 0.2) for s in own]
        points = []
        for _ in range(rng.randint(0, 3)):
            s = place[rng.choice(own)]
            if s[1] is not None:
                points.append((s[1] + rng.choice([0.01, 0.3, 1.5, 9]), s[2]))
        said = [f"at {a:.5f}, {b:.5f} {'-' * 90}" for a, b in points] + rng.choice([[], ["12 Mill Road"], ["SW1A 1AA"]])
        texts.append((p, " ".join(said) or None))
    found = {r.source_id: r for r in page_places.missed_locations(spark.createDataFrame(cites, "source_id int, site_id int, stated boolean"), spark.createDataFrame(sites, "site_id int, latitude double, longitude double, iso3 string"), spark.createDataFrame([*texts, (999, "48.123, 2.345")], "source_id int, text string")).collect()}

    def km(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))

    assert set(found) == {p for p, t in texts if t}
    for p, text in texts:
        if not text:
            continue
        own = [place[s] for q, s, _ in cites if q == p]
        away = [km(a, b, s[1], s[2]) for _, _, a, b, fine in coordinates.on_page(text) if fine for s in own if s[1] is not None]
        nearest = min(away, default=None)
        kind = None
        if nearest is not None and nearest <= 5:
            kind = "coordinates"
        elif "Road" in text:
            kind = "street address"
        elif nearest is not None and nearest <= 300:
            kind = "another facility's point"
        elif "SW1A" in text and any(s[3] == "GBR" for s in own):
            kind = "postcode"
        stated = any(x for q, _, x in cites if q == p)
        r = found[p]
        assert (r.found_kind, r.stated, r.missed) == (kind, stated, not stated and kind in ("coordinates", "street address")), p
        assert r.km is None if kind not in ("coordinates", "another facility's point") else r.km == pytest.approx(nearest, abs=1e-6)


def test_quotes_in_all_forms(spark):
    page = spark.createDataFrame([(1, "The land-\nfill took 1 200 tonnes at 12 Mill Rd in 2019.", False), (2, "この埋立地は２０１９年に一万トンの廃棄物を受け入れました。", False), (3, "menu", True)], "id int, text string, partial boolean")
    said = [(1, "landfill took 1200 tonnes", "found"), (1, "at 12 Mill Road in", "found"), (1, "The landfill ... in 2019", "found"), (1, "landfill tonnes took Mill", "partly"), (1, "landfill took 1300 tonnes", "not found"), (2, "廃棄物を受け入れました", "found"), (2, "２０１９年 に 一万トン", "found"), (2, "この埋立地は2019年に一万トンの廃棄物を受け取りました", "partly"), (2, "別の場所で起きたこと", "not found"), (3, "something else than a menu", "not in the part read"), (4, "no such page at all", "no page text"), (1, "two words", None), (1, None, None), (1, " ... ", None)]
    quotes = spark.createDataFrame([(k, q, w, i) for i, (k, q, w) in enumerate(said)], "id int, quote string, want string, i int")
    for r in pages.quote_results(quotes, page, "id").collect():
        assert r.result == r.want, r.quote


def test_stated_places_on_pages(spark):
    text = "Gate at 48.84341 N, 87.42960 W. Office: 12 Mill Road. Grid ref TQ310806."
    said = [
        (1, None, "48.8434, -87.4296", "coordinates", 48.8434, -87.4296, "found"),
        (1, None, "48.8440, -87.4296", "coordinates", 48.844, -87.4296, "found"),  # within 250 m
        (1, None, "48.9440, -87.4296", "coordinates", 48.944, -87.4296, "partly"),
        (1, None, "TQ 310 806", "grid reference", 51.5, 0.1, "found"),
        (1, "12 Mill Rd", None, "street", 1.0, 1.0, "found"),
        (1, "12 Mill Rd", "10.1234, 11.1234", "coordinates", 10.1234, 11.1234, "not found"),
        (1, "12 Mill Rd", "10.1234, 11.1234", None, None, None, "found"),
        (1, "99 Nowhere Lane | 12 Mill Rd", None, None, None, None, "found"),
        (1, " ", None, None, None, None, None),
        (2, "12 Mill Rd", None, None, None, None, "no page text"),
        (2, None, None, None, None, None, None),
        (None, "12 Mill Rd", None, None, None, None, "no page text"),
    ]
    rows = spark.createDataFrame(said, "id int, address string, coordinates string, basis string, lat double, lon double, want string")
    found = page_places.stated_places_on_pages(rows, spark.createDataFrame([(1, text), (3, None)], "id int, text string"), "id").collect()
    assert len(found) == len(said)
    for r in found:
        assert r.place_on_page == r.want, r


def test_addresses_are_prepared(spark):
    from sourcefold.functions import addresses

    # address, names, town, state: sent, plainer, reasons, refused
    cases = [
        ("Brady Road Landfill, 1777 Brady Road, Winnipeg", ["Brady Road", "Brady Road Landfill"], "Winnipeg", "Manitoba", "1777 Brady Road, Winnipeg, Manitoba", None, ["name in front"], None),
        ("Hartland Avenue 1", ["Hart"], "Victoria", None, "Hartland Avenue 1, Victoria", None, [], None),
        ("SMITH & SONS: 12 Mill Road", ["Smith and Sons"], None, None, "12 Mill Road", None, ["name in front"], None),
        ("P.O. Box 12, Mill Road, Springfield", [], "Springfield", "North", "Mill Road, Springfield, North", None, ["post box"], None),
        ("PO Box 7", [], "X", "Y", None, None, ["post box"], "post box alone"),
        ("The Big Dump", ["the big dump"], "X", "Y", None, None, ["name in front"], "a name alone"),
        ("Km 14", [], "X", "Y", None, None, [], "kilometre marker"),
        ("somewhere nice", [], "X", "Y", None, None, [], "no street and no place"),
        (None, ["x"], "X", "Y", None, None, [], "no address"),
        (" , ; ", None, "X", "Y", None, None, [], "no address"),
        ("3610 Victoria Avenue East on NW 1/4 17-10-18 WPM in Brandon, Manitoba", [], "Brandon", "Manitoba", "3610 Victoria Avenue East on NW 1/4 17-10-18 WPM in Brandon, Manitoba, Brandon", "3610 Victoria Avenue East, Brandon, Manitoba", ["land description", "words before a place"], None),
        ("Reynolds Bach Drive, accessed from Eastern Hutt Road in Silverstream", [], "Silverstream", None, "Reynolds Bach Drive, accessed from Eastern Hutt Road in Silverstream", "Reynolds Bach Drive, Silverstream", ["words before a place", "directions"], None),
        ("Lots A & B, 12 High Street (north gate), City of Guelph", [], "Guelph", "Ontario", "Lots A & B, 12 High Street (north gate), City of Guelph, Ontario", "12 High Street, Guelph, Ontario", ["brackets", "lot"], None),
        ("Calle Morelos 5", [], "Yautepec", "Morelos", "Calle Morelos 5, Yautepec, Morelos", None, [], None),
    ]
    rows = spark.createDataFrame([(*c[:4],) for c in cases], "a string, n array<string>, t string, s string").withColumn("p", addresses.prepared(F.col("a"), F.coalesce("n", F.array().cast("array<string>")), F.col("t"), F.col("s")))
    for r, want in zip(rows.collect(), cases):
        assert (r.p.sent, r.p.plainer, r.p.reasons, r.p.refused) == tuple(want[4:]), want[0]


def test_candidates_are_listed_once(spark):
    from sourcefold.operators import candidates

    found = spark.createDataFrame([(1, "a", 1, "https://X.example/p", "Big  Dump", 10.0, 20.0, "area = 5"), (2, "a", 1, "https://x.example/p/", "big dump", 11.0, 20.0, "owner = Me"), (3, "b", 2, "https://x.example/p", "Big Dump", 10.0, 20.0, ""), (4, "c", 3, "https://y.example", None, None, None, "area = 6"), (5, "d", 3, "https://y.example", None, 1.0, 1.0, None)], "ord int, review_id string, site_id int, url string, name string, latitude double, longitude double, line string")
    said = spark.createDataFrame([("a", "new", "Jo", "2026-01-02", "seen"), ("b", "new", None, None, " "), ("c", "new", "Al", None, None), ("d", "junk", None, None, None)], "review_id string, decision string, reviewer string, reviewed string, notes string")
    sites = spark.createDataFrame([(1, 10.1, 20.0, 0.0), (2, 10.01, 20.0, None), (3, -50.0, 0.0, None)], "site_id int, other_latitude double, other_longitude double, area double")
    new, citing = candidates.candidates(found, said)
    empty = spark.createDataFrame([], f"{new._jdf.schema().toDDL()}, nearest_site_id int, nearest_km double")
    listed, by = candidates.merged(empty, citing.limit(0), new, citing, sites)
    rows = {r.url: r for r in listed.collect()}
    assert len(rows) == 2 and (rows["https://X.example/p"].nearest_site_id, rows["https://X.example/p"].nearest_km) == (2, 1.1) and rows["https://y.example"].nearest_site_id is None
    notes = {r.site_id: r.note for r in by.collect()}
    assert notes == {1: "Marked as a new site (Jo on 2026-01-02) under site 1. It gives area = 5; owner = Me. seen", 2: "Marked as a new site under site 2.", 3: "Marked as a new site (Al) under site 3. It gives area = 6."}
    edited = listed.withColumn("name", F.lit("edited"))
    again, more = candidates.merged(edited, by, new, citing, sites)
    assert again.count() == 2 and {r.name for r in again.collect()} == {"edited"} and more.count() == by.count()


@pytest.fixture(scope="module")
def date_line(spark, tmp_path_factory):
    """Tables in which all sites lie beside the date line, half of them beyond it."""
    folder = tmp_path_factory.mktemp("date_line")
    spark.range(151).selectExpr("id AS c_custkey", "'n' AS c_name", "24 AS c_nationkey", "1.0D AS c_acctbal", "'m' AS c_mktsegment").write.parquet(f"{folder}/customer.parquet")
    spark.range(1).selectExpr("24 AS n_nationkey", "'x' AS n_name").write.parquet(f"{folder}/nation.parquet")
    spark.range(150).selectExpr("id AS doc_id", "'Some prose.' AS text").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def same_as_sql(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    other = duckdb.connect()
    for t in ("customer", "nation", "documents"):
        other.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    found = QUERIES[name](spark, folder)
    wanted = other.sql(ORACLES[name]).project(", ".join(f'"{c}"' for c in found.columns)).fetchall()
    return Counter(map(tuple, found.collect())) == Counter(wanted)


def test_missed_locations_beyond_the_date_line(spark, date_line):
    assert same_as_sql(spark, date_line, "ag18_missed_locations")


def test_summary_of_missed_locations_beyond_the_date_line(spark, date_line):
    assert same_as_sql(spark, date_line, "ag18_missed_summary")


def test_page_check_beyond_the_date_line(spark, date_line):
    assert same_as_sql(spark, date_line, "jn12_page_check")


def test_stated_places_beyond_the_date_line(spark, date_line):
    assert same_as_sql(spark, date_line, "pj08_stated_places")
