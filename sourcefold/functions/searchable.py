"""Whether a name gives a search anything to look for, and whose name it is.

Words first: a name's informative words could say which site it is; a name of kind words and none of these is generic.
Then ordered rules, the first that holds gives class and reason. All of it is columns, without Python in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .names import folded

NO_NAME, NOT_A_NAME, GENERIC, MINING, ADDRESS, NAMED = "no name", "not a name", "generic label", "mining feature", "address only", "named"
#: Classes that a search leaves out.
SKIPPED = [NO_NAME, NOT_A_NAME, GENERIC, MINING, ADDRESS]

# Words and phrases that the rules know.
FILLERS = ["openstreetmap landfill"]
NAMELESS = ["no name", "noname", "unnamed", "sin nombre"]
NOTES = ["update the tag", "after survey", "fixme", "clarify", "looks like", "not valid", "incomprehensible", "no longer in use", "what is being"]
PARTS = ["map", "section", "cell", "card"]
STREETS = ["проспект", "шоссе", "улица", "переулок"]
STREET_SHORT = "ул."
SPOIL = ["blades?", "terrikons?", "overburden", "spoil", "slag", "gangue", "waste rock", "tailings (?:ponds?|dams?|storage)"]
SPOIL_ELSEWHERE = ["отвал", "террикон", "терикон", "відвал", "хвостохранилищ", "хвостосховищ", "erzhalde"]
SPOIL_ALONE = ["kaliberg", "kalimadscharo", "kalimandscharo", "pasa"]
ADDRESS_SOURCES = ["gpw_2021"]
LABELS = [
    "openstreetmap landfill", "domestic landfill", "landfill", "dump", "dumps", "municipal garbage dump", "municipal dump", "solid waste landfill", "city landfill", "rubbish tip", "landfill site", "dumping",
    "landfillmsw", "biolandfill", "pigsty", "sump", "ruins", "shooting range", "reclamation lands",
]
KINDS = (
    "landfill dump dumpsite garbage waste rubbish tip trash disposal basurero basureros tiradero tiraderos relleno rellenos vertedero vertederos basura residuos disposicion disposición "
    "msw tbo tko polygon poltgon dumping dumps storage pit pits beds pockets yard hump area zone facility "
    "deponie mülldeponie muelldeponie erddeponie abfalldeponie bauschuttdeponie bodendeponie erdmassendeponie erdaushubdeponie altdeponie kreismülldeponie müllkippe muellkippe kippe schuttplatz "
    "wertstoffhof recyclinghof altlastsanierung свалка свалки полигон тбо тко"
).split()
STATES = (
    "municipal municpal intermunicipal regional city public sanitary controlled open air open-air final site solid unnamed unknown without name sanitario sanitaria controlado controlada cielo abierto sitio tipo "
    "solidos sólidos urbanos rsu sin nombre the del los las former old new closed inactive unused illegal unauthorized spontaneous elemental temporary currently incomplete reclaimed recultivated excavated "
    "district village household urban domestic industrial production woodworking deprocessing sawdust lignin litter livestock alkaline rubber goods oil drain wastewater asbestos lime soda ore mud peat clay "
    "earth green rubble space place sorting complex collection processing operating use fill dumping ehem ehemalige ehm städt stillgelegt rekultivierte "
    "бывшая бывший старая стихийная несанкционированная незаконная городская районная поселковая закрыта закрытая"
).split()
SHORT = "no nr lf of in at on to by or an as is it de do da di du el la le lo en et es na al os ao".split()
CLOSED_HINTS = ["closed", "close)", "former", "abandoned", "decommission", "shut"]
OPERATORS = [
    "s ?a ?de ?c ?v", "sociedad anonima", "s ?de ?r ?l", "simeprode", "promotora", "proactiva", "tecmed", "sistema integral para el manejo", "sistema intermunicipal", "junta intermunicipal",
]
FAILED_TOOLS = ["search_query tool", "browsing tool", "web[- ]search tool", "search tool"]
FAILED_WAYS = ["did not return", "returned an invalid", "invalid[- ]arguments", "error", "not return usable"]
FAILED_SAYINGS = ["could not complete the required web search", "did not return usable (?:indexed )?(?:results|search-result)"]

PUNCTUATION = ".,;:()[]{}\"'«»"
ROMAN = "^x{0,3}(ix|iv|v?i{0,3})$"
TOOL_FAILED = f"({'|'.join(FAILED_TOOLS)})[^.]{{0,80}}({'|'.join(FAILED_WAYS)})|{'|'.join(FAILED_SAYINGS)}"


def said(name: Column) -> Column:
    """A name without outer white space; null is empty."""
    return F.regexp_replace(F.coalesce(name, F.lit("")), r"(?U)^\s+|\s+$", "")


def word_list(name: Column) -> Column:
    """A name's words in lower case; brackets and slashes part words, outer punctuation is off (what is left may be empty)."""
    words = F.split(said(F.regexp_replace(F.lower(said(name)), r"[()/\[\]]", " ")), r"(?U)\s+")
    return F.transform(words, lambda w: F.btrim(w, F.lit(PUNCTUATION)))


def informative_words(name: Column) -> Column:
    """The words that could say which site it is, in order; null and blank names have none.

    Longer words count unless they are kinds or states of sites. Of words of one or two letters count initials and route
    codes, and what `&` joins; numbers and Roman numerals don't.
    """
    words = word_list(name)

    def tells(word: Column, i: Column) -> Column:
        joined = F.coalesce(F.get(words, i - 1) == "&", F.lit(False)) | F.coalesce(F.get(words, i + 1) == "&", F.lit(False))
        initials = word.rlike(r"^\p{L}{1,2}$") & ~word.rlike(ROMAN) & (joined | (F.char_length(word) == 2) & ~word.isin(SHORT))
        return (word != "") & ~word.isin([*KINDS, *STATES]) & ((F.char_length(word) > 2) | initials)

    return F.filter(words, tells)


def generic_name(name: Column) -> Column:
    """Whether a name says what kind of site it is and not which; a blank one does."""
    lower = F.lower(said(name))
    kind = F.exists(word_list(name), lambda w: w.isin(KINDS))
    return (lower == "") | lower.isin(LABELS) | kind & (F.size(informative_words(name)) == 0)


def first_rule(name: Column, original: Column) -> Column:
    """(class, reason) of the first rule that holds, without a look at the original for names that are blank."""
    text, lower, other = said(name), F.lower(said(name)), F.lower(said(original))
    any_of = lambda words: "|".join(words)
    heap = lambda t: t.rlike(any_of(SPOIL_ELSEWHERE)) | t.rlike(r"(?U)(?<!müll)halde\b") | t.isin(SPOIL_ALONE)
    rules = [
        (NO_NAME, "empty name", text == ""),
        (NO_NAME, "a filler for an unnamed polygon", lower.isin(FILLERS)),
        (NO_NAME, "says it has no name", lower.isin(NAMELESS)),
        (NOT_A_NAME, "a link", lower.rlike(r"https?://|www\.")),
        (NOT_A_NAME, "a bare number", text.rlike(r"(?U)^[\d\s.,;:/#№-]+$")),
        (NOT_A_NAME, "a survey note", lower.rlike(any_of(NOTES)) | text.contains("?")),
        (NOT_A_NAME, "a single letter", text.rlike(r"(?U)^\w$")),
        (NOT_A_NAME, "a numbered part of a site", lower.rlike(rf"(?U)^(?:{any_of(PARTS)})\s*(?:no\.?|№|#)?\s*\d+$")),
        (NOT_A_NAME, "a street", lower.rlike(rf"(?U){any_of(STREETS)}|\b{STREET_SHORT[:-1]}\.")),
        (MINING, "a mining word", lower.rlike(rf"(?U)\b(?:{any_of(SPOIL)})\b")),
        (MINING, "a mining word in the original name", heap(other) | heap(lower)),
        (GENERIC, "a listed label", lower.isin(LABELS)),
        (GENERIC, "only words for a kind of site", generic_name(name)),
    ]
    out = F.lit(None)
    for kind, reason, holds in reversed(rules):
        out = F.when(holds, F.struct(F.lit(kind).alias("class"), F.lit(reason).alias("reason"))).otherwise(out)
    return F.coalesce(out, F.struct(F.lit(NAMED).alias("class"), F.lit("").alias("reason")))


def name_class(name: Column, original: Column | None = None, sources: Column | None = None) -> Column:
    """(class, reason) of a name, the source's own spelling and the datasets (joined by +) that know the site.

    Where the name is blank or filler, an original that is itself named keeps the site named. A site that only datasets of
    addresses know is `address only` whatever its name says. Null is blank; named sites have the reason "".
    """
    original = F.lit("") if original is None else original
    lower, own = F.lower(said(name)), F.lower(said(original))
    rescued = lower.isin(["", *FILLERS, *NAMELESS]) & (own != "") & (own != lower) & (first_rule(original, original)["class"] == NAMED)
    out = F.when(rescued, F.struct(F.lit(NAMED).alias("class"), F.lit("").alias("reason"))).otherwise(first_rule(name, original))
    if sources is None:
        return out
    only = F.forall(F.split(F.coalesce(sources, F.lit("")), r"\+"), lambda s: said(s).isin(ADDRESS_SOURCES))
    return F.when(only, F.struct(F.lit(ADDRESS).alias("class"), F.lit("only a dataset of addresses records it").alias("reason"))).otherwise(out)


def looks_closed(status: Column, name: Column) -> Column:
    """Whether the status or a part of the name says that the site is closed."""
    lower = F.lower(said(name))
    hinted = F.lit(False)
    for hint in CLOSED_HINTS:
        hinted = hinted | lower.contains(hint)
    return (F.lower(said(status)) == "inactive") | hinted


def operator_like(name: Column) -> Column:
    """Whether a name holds a legal form or body that runs sites; case, accents and punctuation don't count."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(folded(said(name)), r"[^\x00-\x7F]", ""), "[^a-z0-9]+", " "))
    return plain.rlike(rf"\b(?:{'|'.join(OPERATORS)})\b")


def operator_named(original: Column, name: Column) -> Column:
    """Which of a site's names is an operator's: the original, else the name, else ""."""
    return F.when(operator_like(original), "original").when(operator_like(name), "name").otherwise("")


def tool_failed(notes: Column) -> Column:
    """Whether notes say that the search tool broke, not that it found nothing."""
    return F.coalesce(notes, F.lit("")).rlike(f"(?i){TOOL_FAILED}")
