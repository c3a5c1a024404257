"""Numbers and units in texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Unit patterns in the order in which they are tried, with their factors.
MASS = [(r"\b(short|us)\s+tons?\b", 0.90718474), (r"\b(long|imperial)\s+tons?\b", 1.0160469088), (r"\bkg\b", 0.001), (r"\blb\b", 0.00045359237), (r"\bmetric tonnes?\b|\btonnes?\b|\bt\b", 1.0)]
AREA = [
    (r"(mi2|mi\^2|mi²|square miles?|sq\.?\s*mi(les?)?\b)", 2589988.110336),
    (r"\b(ha|hectares?)\b", 10000.0),
    (r"\b(daa|decares?)\b", 1000.0),
    (r"(km2|km\^2|km²|square kilomet(er|re)s?|sq\.?\s*km)", 1000000.0),
    (r"\bacres?\b", 4046.856),
    (r"(ft2|ft\^2|ft²|square f(ee|oo)t|sq\.?\s*(f(ee|oo)t|ft)\b)", 0.092903),
    (r"(m2|m\^2|m²|square met(er|re)s?|sq\.?\s*m)", 1.0),
]
LENGTH = [(r"\b(ft|foot|feet)\b", 0.3048), (r"\b(m|meter|meters|metre|metres)\b", 1.0), (r"\b(yd|yard|yards)\b", 0.9144)]
DISTANCE = [(r"\b(km|kilomet(er|re)s?)\b", 1.0), (r"\b(mi|mile|miles)\b", 1.609344), (r"\b(m|meter|meters|metre|metres)\b", 0.001)]
# Periods, their short forms and adverbs, and how many make a year.
PERIODS = [("day", "d", "daily", 365.0), ("week", None, "weekly", 52.0), ("month", None, "monthly", 12.0), ("minute", "min", None, 525600.0), ("hour", "hr|h", "hourly", 8760.0), ("year", None, "annual", 1.0)]
# Words and abbreviations for powers of ten; a star stands for any ending. Abbreviations count in a value only, where a unit's "mm" is millimetres.
MAGNITUDES = {
    1e9: "billion billions milliard milliards miliardo miliardi milliarde milliarden mrd млрд миллиард* milyar",
    1e6: "million millions millon millones milhao milhoes milione milioni millionen mio млн миллион* milyon",
    1e3: "thousand thousands mil millier milliers mille mila tausend tsd тыс* bin",
}
SHORT_MAGNITUDES = {1e9: "billion bn", 1e6: "million mn mm", 1e3: "thousand k"}
# Unit words of other languages, without accents; a star stands for any ending.
MASS_WORDS = {
    "tonnes": "tonelada toneladas tonnellata tonnellate tonnen тонн* т",
    "kg": "kilogramo kilogramos kilograma kilogramas quilograma quilogramas kilogramme kilogrammes kilogramm kilogrammi килограмм* кг",
}
LENGTH_WORDS = {
    "kilometers": "kilometro kilometros quilometro quilometros chilometri километр* км",
    "meters": "metro metros metri метр* м",
}
OTHER_WORDS = {
    "square kilometers": "quadratkilometer kilometrekare км2",
    "square meters": "quadratmeter metrekare м2",
    "cubic meters": "kubikmeter metrekup кубометр* м3",
    "hectares": "hectarea hectareas ettaro ettari hektar hektare hektaren гектар* га",
    "decares": "donum dekar",
}
#: Adjectives that make a length an area or a volume, on either side of it; metric ones are left out.
ADJECTIVES = {"square": "cuadrado cuadrados quadrado quadrados carre carres quadrati квадратн* кв", "cubic": "cubico cubicos cube cubes cubi кубическ* куб", "": "metrica metricas metrico metricos"}
PER = "por par pro al all' в"
PERIOD_WORDS = {"day": "dia jour giorno tag gun день сут*", "week": "semana semaine settimana woche hafta неделю", "month": "mes mois mese monat ay мес*", "year": "ano an anno jahr yil год*", "hour": "hora heure ora stunde saat час ч"}
PERIODIC = {
    "day": "diario diarios diaria diarias quotidien quotidiens quotidienne quotidiennes giornaliere giornalieri taglich gunluk gunde ежедневно",
    "week": "semanal semanales hebdomadaire hebdomadaires settimanale settimanali wochentlich haftalik еженедельно",
    "month": "mensual mensuales mensuel mensuels mensuelle mensuelles mensile mensili monatlich aylik ежемесячно",
    "year": "anual anuales annuel annuels annuelle annuelles annue annui jahrlich yillik yilda ежегодно",
}
# English short forms, and gas flows whose names hold volume and period in one.
ENGLISH = {"kg": "kilogram kilograms", "lb": "pound pounds", "mmcf/day": "mmscfd mmcfd", "mcf/day": "mscfd mcfd", "cubic feet/day": "scfd cfd", "cubic feet/minute": "scfm cfm", "mmcf": "mmscf"}
YEAR_SHORT = "yr y annum a"

TOKEN = r"\p{L}[\p{L}\d^'’₄]*\.?|\d[\d.,]*|\S"
ACCENTS = "áàâãäåéèêëíìîïóòôõöúùûüñçığşйё²³’", "aaaaaaeeeeiiiiooooouuuuncigsие23'"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def folded(text: Column) -> Column:
    """Lower case, without accents, raised digits as plain ones."""
    return F.translate(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\p{M}", ""), *ACCENTS)


def _codes() -> dict[str, str]:
    """What each word is: a letter for its part in a unit, `!` if it is another language's, and what it stands for."""
    table = [("l!", LENGTH_WORDS), ("a!", ADJECTIVES), ("u!", MASS_WORDS), ("u!", OTHER_WORDS), ("d!", PERIOD_WORDS), ("y!", PERIODIC), ("u ", ENGLISH), ("d ", {"year": YEAR_SHORT}), ("p!", {"": PER}), ("p ", {"": "per /"}), ("o!", {"": "bin milyon milyar mio mrd tsd тыс* млн млрд"})]
    return {word: kind + meaning for kind, words in table for meaning, said in words.items() for word in said.split()}


def unit_text(unit: Column) -> Column:
    """A unit in the spelling that the factor tables read.

    Its words are read from left to right: what is measured, with square or cubic from either side, then a slash or a
    word for it and a period. Words of other languages are put into English, and beside them a ton is a tonne.
    """
    codes = _codes()
    whole = F.create_map(*[F.lit(x) for pair in codes.items() if "*" not in pair[0] for x in pair])
    endings = [(word[:-1], code) for word, code in codes.items() if "*" in word]
    cased = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(unit, F.lit(""))), r"\bMg\b", "tonnes"), r"(?i)\bto(?=\s*/)", "tonnes")

    def coded(token: Column) -> Column:
        def found(bare: Column) -> Column:
            stems = F.coalesce(*[F.when(F.startswith(bare, F.lit(stem)), F.lit(code)) for stem, code in endings])
            return F.coalesce(F.try_element_at(whole, bare), F.when(bare.rlike("^[а-я]"), stems), F.lit("o "))

        bare = F.when(F.length(token) > 1, F.rtrim(token, F.lit("."))).otherwise(token)
        return let(let(bare, found), lambda x: F.struct(F.substring(x, 1, 1).alias("kind"), (F.substring(x, 2, 1) == "!").alias("foreign"), F.substring(x, 3, 99).alias("to"), token.alias("said")))

    state = F.struct(F.lit("").alias("done"), F.lit("").alias("last"), F.lit("").alias("adjective"), F.lit(False).alias("per"))

    def read(at: Column, t: Column) -> Column:
        kind, last = t["kind"], at["last"]
        length = last.isin(*LENGTH_WORDS)
        attached = (kind == "y") | ((kind == "d") & at["per"])
        turned = (kind == "a") & length & (t["to"] != "")
        skipped = (kind == "p") | ((kind == "a") & (~length | turned))
        word = F.when(kind.isin("u", "l"), F.concat(F.when((kind == "l") & (at["adjective"] != ""), F.concat(at["adjective"], F.lit(" "))).otherwise(F.lit("")), t["to"])).when(t["said"].rlike("^tons?$") & (last == "metric"), F.lit("tonnes")).otherwise(t["said"])
        new = F.when(attached, F.concat(last, F.lit("/"), t["to"])).when(turned, F.concat(t["to"], F.lit(" "), last)).when(skipped, last).when(at["per"], F.concat(last, F.lit("/"), word)).otherwise(word)
        done = F.when(attached | skipped | at["per"], at["done"]).otherwise(F.ltrim(F.concat(at["done"], F.lit(" "), last)))
        adjective = F.when(skipped & ~turned & (kind == "a"), t["to"]).when(kind.isin("p", "y", "d"), at["adjective"]).otherwise(F.lit(""))
        return F.struct(done.alias("done"), new.alias("last"), adjective.alias("adjective"), (kind == "p").alias("per"))

    def put_together(tokens: Column) -> Column:
        said = F.aggregate(tokens, state, read, lambda s: F.trim(F.concat(s["done"], F.lit(" "), s["last"])))
        return F.when(F.exists(tokens, lambda t: t["foreign"]), F.regexp_replace(said, r"\btons?\b", "tonnes")).otherwise(said)

    return let(F.transform(F.regexp_extract_all(folded(cased), F.lit(TOKEN), F.lit(0)), coded), put_together)


def period_pattern(word: str, short: str | None, adverb: str | None) -> str:
    return "|".join([f"/{word}", *([rf"/({short})\b"] if short else []), *([adverb] if adverb else [])])


YEARLY = [(period_pattern(*p[:3]), p[3]) for p in PERIODS]
ANY_RATE = "|".join(p for p, _ in YEARLY)


#: What shows that a value's own wording names a unit.
KNOWN = "|".join(["%", r"\btons?\b", ANY_RATE, *(p for table in (MASS, AREA, LENGTH, DISTANCE) for p, _ in table)])


def detected_unit(value: Column, unit: Column) -> Column:
    """The unit field's unit, else the value's wording if it names a unit; blank where neither does."""
    given = F.trim(F.coalesce(unit, F.lit(""))) != ""
    return let(unit_text(F.when(given, unit).otherwise(value)), lambda u: F.when(given | u.rlike(KNOWN), u).otherwise(F.lit("")))


def factor(unit: Column, table: list[tuple[str, float]], bare: float | None = 1.0) -> Column:
    """The first factor of the table whose pattern the unit has; `bare` for no unit at all; null for an unknown unit."""
    return let(unit, lambda u: F.coalesce(*[F.when(u.rlike(pattern), F.lit(x)) for pattern, x in table], F.when(u == "", F.lit(bare))))


def yearly_factor(unit: Column) -> Column:
    """What a rate is multiplied by to be a year's."""
    return F.coalesce(factor(unit, YEARLY, None), F.lit(1.0))


def stock_factor(unit: Column) -> Column:
    """1 for an amount, null for a rate, which no stock can be."""
    return F.when(~unit.rlike(ANY_RATE), F.lit(1.0))


#: A written number: whole groups with dots (then perhaps a comma), or groups with spaces or commas and a decimal point.
#: A minus that stands after another number is a dash.
DOTTED = r"\d{1,3}(?:\.\d{3}){2,}(?!\d)(?:,\d+)?|\d{1,3}(?:\.\d{3})+,\d+|\d{4,}\.\d{3}(?!\d)"
WRITTEN = rf"(?:(?<!\d\s{{0,9}})[-+])?(?:{DOTTED}|\d+(?:[ \u00a0\u2009\u202f]\d{{3}}(?!\d))*(?:,\d+)*(?:\.\d+)?|\.\d+)(?:e[-+]?\d+)?"


def numbers(value: Column) -> Column:
    """The numbers of a text: grouped thousands joined, a decimal comma read as a point, and `3-8` as two numbers."""

    def read(said: Column) -> Column:
        plain = F.translate(said, " \u00a0\u2009\u202f", "")
        plain = F.when(plain.rlike(f"^[-+]?(?:{DOTTED})$"), F.replace(plain, F.lit("."), F.lit(""))).otherwise(plain)
        decimals = F.regexp_extract(plain, r",(\d{1,2})$", 1)
        whole = F.when(decimals != "", F.regexp_extract(plain, r"^(.*),", 1)).otherwise(plain)
        return F.concat(F.replace(whole, F.lit(","), F.lit("")), F.when(decimals != "", F.concat(F.lit("."), decimals)).otherwise(F.lit(""))).cast("double")

    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(value, F.lit(""))), F.lit(WRITTEN), F.lit(0)), read)


def magnitude(value: Column, unit: Column) -> Column:
    """The power of ten that a value names, or else value or unit in whole words."""

    def named(tokens: Column, said: str) -> Column:
        whole = F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in said.split() if "*" not in w]))
        stems = [w[:-1] for w in said.split() if "*" in w]
        return whole | F.exists(tokens, lambda t: t.rlike(f"^({'|'.join(stems)})")) if stems else whole

    def power(tokens: Column) -> Column:
        words, both = tokens["words"], tokens["both"]
        thousand_million = F.concat(F.lit(" "), F.array_join(both, " "), F.lit(" ")).contains(" mil millones ")
        return F.coalesce(*[F.when(named(words, said), F.lit(x)) for x, said in SHORT_MAGNITUDES.items()], F.when(thousand_million, F.lit(1e9)), *[F.when(named(both, said), F.lit(x)) for x, said in MAGNITUDES.items()], F.lit(1.0))

    words, others = (F.regexp_extract_all(folded(x), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)) for x in (value, unit))
    return let(F.struct(words.alias("words"), F.concat(words, F.array(F.lit("|")), others).alias("both")), power)


def fraction(number: Column, percent: Column) -> Column:
    """A share as 0 to 1: a percentage, or any number over 1, is divided by 100."""
    share = F.when(percent | (number > 1), number / 100).otherwise(number)
    return F.when(share.between(0, 1), share)
