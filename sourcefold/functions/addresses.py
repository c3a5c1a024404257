"""Addresses made ready for a lookup, and stated places looked for in page texts."""

from pyspark.sql import Column, functions as F

from .units import let


def without_po_box(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?i)\b(p\.?\s?o\.?\s?box|postfach|casilla|apartado)\s*\d+\s*,?", ""))


def to_send(address: Column, name: Column, town: Column, state: Column) -> tuple[Column, Column]:
    """(text to look up, why there is none): post boxes and the facility's name in front off, town and state appended once."""
    bare = without_po_box(F.coalesce(address, F.lit("")))
    low, own = F.lower(bare), F.lower(F.trim(name))
    bare = F.when(low.startswith(F.concat(own, F.lit(","))), F.trim(F.substring(bare, F.length(own) + 2, F.length(bare)))).otherwise(bare)
    missing = F.filter(F.array(town, state), lambda x: x.isNotNull() & ~F.contains(F.lower(bare), F.lower(x)))
    reason = F.when(bare == "", "no address").when(F.lower(bare).rlike(r"^(km|kilomet(er|re))\s*\d"), "kilometre marker").when(~bare.rlike(r"[\p{L}]{3}"), "no place")
    return F.when(reason.isNull(), F.array_join(F.concat(F.array(bare), missing), ", ")), reason


def numbers_on_page(stated: Column, page: Column) -> Column:
    """Whether every decimal number of a stated location stands on the page, to the decimals stated."""
    numbers = F.regexp_extract_all(stated, F.lit(r"(\d{1,3}\.\d+)"), F.lit(1))
    return F.when(F.size(numbers) > 0, F.forall(numbers, lambda n: F.contains(page, n)))


#: What is taken out of an address or put another way, in order: why, the pattern, and what stands there instead.
REWORDED = [
    ("post box", r"(?i)\b(?:p\.?\s?o\.?\s?box|post office box|postfach|casilla|apartado(?: postal)?|caixa postal|boîte postale|b\.?p\.?)\s*(?:n[º°o.]*\s*)?\d+\b", ","),
    ("brackets", r"\([^()]*\)", " "),
    ("land description", r"(?i)\b(?:on\s+|at\s+|in\s+)?(?:the\s+)?(?-i:[NS][EW])[\s-]*(?:1/4|¼|quarter)?(?:\s+of)?[\s,-]*(?:sec(?:tion|\.)?\s*)?\d{1,2}\s*[-,]\s*(?:(?:twp|township)\.?\s*)?\d{1,3}\s*[-,]\s*(?:and\s+)?(?:(?:rge|range)\.?\s*)?\d{1,2}(?:[\s,-]*(?:[we]\.?\s?p\.?\s?m\b\.?|w\s?\d\s?m\b|[we]\b\.?))?", " "),
    ("words before a place", r"(?i)\s+in\s+(?:the\s+)?(?:[\w-]+\s+){0,3}?(?:part|area|section|corner|end|outskirts|vicinity)\s+of\s+|\s+(?:in|at)\s+", ", "),
]
LEFT_OUT = [
    ("directions", r"(?i)^(?:approx(?:imately|\.)?|about|around|roughly|some|access(?:ed)?|entrance|entered|off|via|near|adjacent|next to|behind|opposite|beside|located|situated|(?:the )?(?:end|corner|junction|intersection|top|bottom) of)\b|^\d+(?:\.\d+)?\s*(?:km|kilomet(?:er|re)s?|mi(?:les?)?|m|met(?:er|re)s)\b"),
    ("lot", r"(?i)^(?:lot|unit|suite|parcel|plot|block)s?\s+\S"),
]
GOVERNMENT = r"(?i)^(?:city|town|village|township|municipality|borough)\s+of\s+"
STREET = r"(?i)\d|\b(?:road|rd|street|st|avenue|ave|highway|hwy|drive|dr|lane|ln|way|boulevard|crescent|court|place|parkway|terrace|close|line|trail|route|calle|avenida|rua|via|rue|chemin|carretera|camino|straße|strasse|weg)\b"
APART = r"[\s,;:|(–—-]+"


def words_only(text: Column) -> Column:
    """Words in lower case with one space between them, & as a word."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), r"(?U)[\W_]+", " "))


def without_names(address: Column, names: Column) -> Column:
    """An address less the names in front of it, the longest first, in any case and punctuation; blank for a name alone.

    A name ends where a separator or a number follows, so Hart is no name in front of Hartland Avenue.
    """

    def less(at: Column, name: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iU)^[\W_]*"), F.regexp_replace(F.regexp_replace(words_only(name), r"\band\b", "(?:and|&)"), " ", r"[\\W_]*"), F.lit(r"(?=\s*[,;:|(–—-]|\s+\d)"))
        return F.when(words_only(at) == words_only(name), F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(at, pattern, F.lit("\u0001")), f"^\u0001{APART}|^\u0001", ""))

    longest = F.reverse(F.array_sort(F.transform(F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (words_only(n) != ""))), lambda n: F.struct(F.length(n).alias("l"), n.alias("n")))))
    return F.aggregate(longest, F.trim(address), lambda at, x: less(at, x["n"]))


def prepared(address: Column, names: Column, town: Column, state: Column) -> Column:
    """(sent, plainer, reasons, refused) of a stated address.

    sent: the address less names in front and post boxes, with the town and the state behind it where no part names them.
    plainer: the same without brackets, land descriptions, directions, lots and joining words, for a second try; null where
    that changes nothing or leaves no street with a place. reasons: what was changed, in order. refused: why nothing
    can be sent: no address, a name alone, a kilometre marker, or no street and no second part.
    """
    state_of = lambda text, reasons: F.struct(text.alias("text"), reasons.alias("reasons"))
    tidy = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"\s*,[\s,;]*", ", "), r"^[\s,;:–—-]+|[\s,;:–—-]+$", "")
    said = tidy(F.coalesce(address, F.lit("")))

    def step(at: Column, why: str, text: Column) -> Column:
        return let(F.struct(at["text"].alias("old"), text.alias("new"), at["reasons"].alias("reasons")), lambda s: state_of(s["new"], F.when(s["new"] == s["old"], s["reasons"]).otherwise(F.array_append(s["reasons"], F.lit(why)))))

    def reworded(at: Column, rules: list[tuple[str, str, str]]) -> Column:
        def by(why: str, pattern: str, to: str):
            return lambda s: step(s, why, tidy(F.regexp_replace(s["text"], pattern, to)))

        for rule in rules:
            at = let(at, by(*rule))
        return at

    def placed(text: Column) -> Column:
        parts = F.transform(F.split(text, "[,;]"), words_only)
        named = lambda bare: F.exists(parts, lambda p: p == bare) | F.exists(F.slice(parts, 2, 100), lambda p: F.contains(F.concat(F.lit(" "), p, F.lit(" ")), F.concat(F.lit(" "), bare, F.lit(" "))))
        more = F.filter(F.array(town, state), lambda x: x.isNotNull() & (words_only(x) != "") & ~named(words_only(x)))
        return F.when(text == "", text).otherwise(F.array_join(F.concat(F.array(text), F.array_distinct(more)), ", "))

    def plainer(at: Column) -> Column:
        parts = F.filter(F.transform(F.split(at["text"], "[,;]"), lambda p: F.regexp_replace(F.regexp_replace(p, r"^[\s.:–—-]+|[\s.:–—-]+$", ""), GOVERNMENT, "")), lambda p: p != "")
        gone = lambda p: F.coalesce(*[F.when(p.rlike(x) & (~p.rlike(STREET) if why == "lot" else F.lit(True)), F.lit(why)) for why, x in LEFT_OUT])
        kept = F.filter(parts, lambda p: gone(p).isNull())
        kept = F.filter(kept, lambda p, i: (i == 0) | (F.lower(p) != F.lower(F.get(kept, i - 1))))
        reasons = F.array_distinct(F.filter(F.transform(parts, gone), lambda r: r.isNotNull()))
        return state_of(F.array_join(kept, ", "), F.concat(at["reasons"], reasons))

    def told(first: Column) -> Column:
        bare = without_names(first["text"], names)
        sent = let(first, lambda s: step(s, "name in front", bare))

        def done(s: Column) -> Column:
            second = let(let(reworded(s, REWORDED[1:]), plainer), lambda p: state_of(without_names(p["text"], names), p["reasons"]))
            refused = F.when(said == "", "no address").when(s["text"] == "", F.when(F.array_contains(s["reasons"], "post box"), "post box alone").otherwise("a name alone")).when(s["text"].rlike(r"(?i)^(?:km|kilomet(?:er|re))\.?\s*\d+(?:[.,+]\d+)?(?:\s*(?:,|of|on|de|da)\b.*)?$"), "kilometre marker").when(~s["text"].rlike(STREET) & (F.size(F.split(s["text"], "[,;]")) < 2), "no street and no place")
            return let(F.struct(s.alias("s"), second.alias("p"), refused.alias("r")), lambda x: F.struct(
                F.when(x["r"].isNull(), placed(x["s"]["text"])).alias("sent"),
                F.when(x["r"].isNull() & (x["p"]["text"] != x["s"]["text"]) & (F.size(F.split(x["p"]["text"], "[,;]")) > 1) & x["p"]["text"].rlike(STREET), placed(x["p"]["text"])).alias("plainer"),
                x["p"]["reasons"].alias("reasons"), x["r"].alias("refused")))

        return let(sent, done)

    return let(reworded(state_of(said, F.array().cast("array<string>")), REWORDED[:1]), told)
