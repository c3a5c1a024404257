"""Address phrases in long texts: where the first one of each kind stands.

Each kind is looked for by the word or shape that gives it away, and only the few characters beside that are read
further, so time grows with the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Characters that are read beside a word for a road, and shown around a finding.
BESIDE, SHOWN = 120, 140
#: Characters of a telephone number that are looked at before its last digits.
CALL = 24

# Words for roads behind a name, in front of it, and at a name's end.
ROADS = "road rd street st avenue ave highway hwy drive dr lane ln way boulevard blvd crescent cres court ct place pl parkway pkwy terrace tce close line sideroad trail route rte chemin rue rang".split()
ROADS_FIRST = ["calle", "avenida", "av.", "rua", "rodovia", "estrada", "carretera", "via", "viale", "rue", "chemin", "route", "ulica", "ul."]
ROAD_ENDINGS = tuple("straße strasse weg gasse allee platz laan straat vej gata gatan".split())
# Published forms of postcodes.
POSTCODES = {
    "AUS": r"\b(?:NSW|VIC|QLD|SA|WA|TAS|NT|ACT)\s+\d{4}\b",
    "CAN": r"\b[ABCEGHJ-NPRSTVXY]\d[ABCEGHJ-NPRSTV-Z]\s?\d[ABCEGHJ-NPRSTV-Z]\d\b",
    "GBR": r"\b[A-Z]{1,2}\d[A-Z\d]?\s?\d[ABD-HJLNP-UW-Z]{2}\b",
    "IRL": r"\b[AC-FHKNPRTV-Y]\d{2}\s?[AC-FHKNPRTV-Y0-9]{4}\b",
}

NUMBER = r"\d{1,5}[A-Za-z]?(?:-\d{1,5})?"
NUMBERED = re.compile(rf"(?:^|(?<=[^\w.,])){NUMBER}\s+(?=[A-Z])")
NUMBER_FIRST = re.compile(rf"{NUMBER}(?:\s+[A-Z][\w'’.-]*){{1,4}}\s+(?i:{'|'.join(ROADS)})\.?(?!\w)")
ROAD_FIRST = re.compile(rf"(?<!\w)(?i:{'|'.join(map(re.escape, ROADS_FIRST))})(?=\s)")
NAME_NUMBER = re.compile(r"(?:\s+[A-Z0-9][\w'’.-]*){1,4}?,?\s+(?:(?i:n[º°o.]?|km)\s*)?\d{1,5}\b(?!\.\d|@)")
NUMBER_BEHIND = re.compile(r"(?<=[a-zß])\s+\d{1,4}[a-z]?\b(?!\.\d|@)")
#: What stands before the last digits of a telephone number: fewer than ten others behind a plus, or an area code.
CALLED = re.compile(r"\+(?:[ ().-]*\d){1,9}[ ().-]*\Z|\(\d{2,5}\)[ -]?\Z")
LOT = re.compile(r"(?i)\blot\s+\d+[a-z]?\s*,?\s*(?:of\s+)?concession\s+\d+")
GRID = re.compile(r"(?<![A-Za-z])[A-HJ-Z]{1,2}\s?\d{3,5}\s?\d{3,5}(?!\d)")


def street(text: str) -> tuple[int, int] | None:
    """A number that ends no telephone number, up to four words with capitals, and a word for a road."""
    for m in NUMBERED.finditer(text):
        whole = NUMBER_FIRST.match(text, m.start(), m.start() + BESIDE)
        if whole and not CALLED.search(text[max(0, m.start() - CALL) : m.start()]):
            return whole.span()
    return None


def street_first(text: str) -> tuple[int, int] | None:
    """A word for a road or a name that ends in one, and a number behind."""
    found = []
    for m in ROAD_FIRST.finditer(text):
        if after := NAME_NUMBER.match(text, m.end(), m.end() + BESIDE):
            found.append((m.start(), after.end()))
            break
    for m in NUMBER_BEHIND.finditer(text):
        word = re.search(r"\w*$", text[max(0, m.start() - BESIDE) : m.start()])[0]
        if word[:1].isupper() and word.endswith(ROAD_ENDINGS):
            found.append((m.start() - len(word), m.end()))
            break
    return min(found, default=None)


def lot(text: str) -> tuple[int, int] | None:
    m = LOT.search(text)
    return m and m.span()


def address(text: str) -> tuple[int, int] | None:
    """The first street with a number before it, else the first one with a number behind, else a lot of a concession."""
    return street(text) or street_first(text) or lot(text)


def postcode(text: str, countries: list[str]) -> tuple[int, int] | None:
    """The first postcode of the first of the countries, in their order, that has one."""
    for country in sorted(countries):
        if country in POSTCODES and (m := re.search(POSTCODES[country], text)):
            return m.span()
    return None


def grid_texts(text: str, countries: list[str]) -> Iterator[tuple[int, int]]:
    """What may be a grid reference, where such are used."""
    if {"GBR", "IRL"} & set(countries):
        yield from (m.span() for m in GRID.finditer(text))


def shown(text: str, start: int) -> str:
    """Some of the text around a place, on one line."""
    left = max(0, start - SHOWN // 3)
    return " ".join(text[left : left + SHOWN].split())
