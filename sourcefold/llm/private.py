"""Personal data: patterns, and terms that reveal whom they stand beside.

Base: four kinds of identifiers are matched and checked. Each valid match is a protected entity. Information-theoretic
part: the corpus tells how strongly a term in the documents of an entity reveals it. With N documents, n_t of them
holding the term, n_e the entity and n_te both, disclosure is

    PMI(t; e) / IC(e) = log(N * n_te / (n_t * n_e)) / log(N / n_e),

1 when the term never stands in a document without the entity. Terms at or over a threshold are generalised, those at
1 removed, wherever they stand in documents that hold the entity; pairs seen in too few different documents are left
alone, so a document that was merely copied reveals nothing. Copies are documents of equal entities and text, but for
case and white space. Everything is column expressions, joins and aggregates.

Defined cases: a null text is empty; an empty table or a corpus of one document discloses no terms; rows with equal
id and text are copies, count in N, n_t, n_e and n_te alike, and each get their spans; ids may be null; a word that
overlaps an entity is no term; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_ROWS, few, stored, without

KINDS = ["email", "ip", "card", "phone"]
#: The contract's patterns. Possessive quantifiers and the checks of what stands before change no match: a run of
#: characters that can begin a match is tried at its start, or where the match before it ended, and only there.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text needs to hold for a match, so that most texts aren't searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
WORD = r"\p{L}[\p{L}\p{M}'-]*+"
#: Stands for each letter of an entity while words are sought, so that a word that overlaps one is known by it.
MARK = "\U0010FFFF"
TOKEN = rf"[\p{{L}}{MARK}][\p{{L}}\p{{M}}'{MARK}-]*+"
#: Spans that are worked on one by one in one go.
CHUNK = 256
#: Disclosure from which a term goes, and different documents that a term and an entity need together.
DISCLOSURE, CONTEXTS = 0.9, 3
ADDED = ["spans", "clean_text"]


SPANS = "ARRAY<STRUCT<start: INT, kind: INT, end: INT, value: STRING>>"


def let(name: str, value: str, body: str) -> str:
    """SQL for body with a name for value, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def chunks(items: str) -> str:
    """SQL for the array `items` in arrays of CHUNK: what is appended to one by one stays short, so work grows with the array, not with its square."""
    return let("_i", items, f"IF(size(_i) = 0, array(slice(_i, 1, 0)), transform(sequence(0, (size(_i) - 1) div {CHUNK}), _c -> slice(_i, _c * {CHUNK} + 1, {CHUNK})))")


def placed(found: str, gaps: str, kept: str, made: str, kind: str) -> str:
    """SQL for an array of type `kind`: `made` of those matches x that are `kept`, in order.

    x has m (the match), start and end, in code points; gaps: what stands before each match.
    """
    inner = f"""aggregate(c, struct(aggregate(slice(sums, 1, i), 0, (a, t) -> a + t) AS at, CAST(array() AS {kind}) AS all),
        (acc, y) -> struct(acc.at + y.g + y.l AS at, {let("x", "struct(y.m AS m, acc.at + y.g AS start, acc.at + y.g + y.l AS end)", f"IF({kept}, array_append(acc.all, {made}), acc.all)")} AS all), acc -> acc.all)"""
    sizes = f"zip_with({found}, slice({gaps}, 1, size({found})), (m, g) -> struct(m AS m, length(g) AS g, length(m) AS l))"
    sums = "transform(parts, c -> aggregate(c, 0, (a, y) -> a + y.g + y.l))"
    return f"IF(size({found}) = 0, CAST(array() AS {kind}), {let('parts', chunks(sizes), let('sums', sums, f'flatten(transform(parts, (c, i) -> {inner}))'))})"


def replaced(text: str, spans: str, counts: str, instead: str) -> str:
    """SQL for text with `instead` in place of each span x, in order, that `counts`; at: where the span before ended.

    Each chunk of spans is worked on within its own stretch of the text, and the stretches are joined at the end.
    """
    own = let("e", "greatest(acc.at, array_max(transform(c, x -> x.end)))", let("seg", f"substring({text}, acc.at + 1, e - acc.at)", f"""struct(e AS at, array_append(acc.out, aggregate(c, struct(acc.at AS at, '' AS out),
            (b, x) -> {let("at", "b.at", let("cut", "b.at - acc.at", f"IF({counts}, struct(greatest(at, x.end) AS at, concat(b.out, substring(seg, cut + 1, greatest(x.start - at, 0)), {instead}) AS out), struct(greatest(at, x.end) AS at, b.out AS out))"))},
            b -> concat(b.out, substring(seg, b.at - acc.at + 1)))) AS out)"""))
    return f"IF(size({spans}) = 0, {text}, aggregate({chunks(spans)}, struct(0 AS at, CAST(array() AS ARRAY<STRING>) AS out), (acc, c) -> {own}, acc -> concat(array_join(acc.out, ''), substring({text}, acc.at + 1))))"


VALID = {
    "email": "true",
    "ip": r"forall(split(x.value, r'\.'), p -> p rlike r'^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$')",
    "card": """(length(regexp_replace(x.value, '[^0-9]', '')) BETWEEN 14 AND 19) AND aggregate(
        transform(split(reverse(regexp_replace(x.value, '[^0-9]', '')), ''), (d, i) -> IF(i % 2 = 0, int(d), IF(int(d) > 4, 2 * int(d) - 9, 2 * int(d)))), 0, (a, d) -> a + coalesce(d, 0)) % 10 = 0""",
    "phone": "length(regexp_replace(x.value, '[^0-9]', '')) BETWEEN 10 AND 15",
}


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """docs with _text (never null) and _base: valid matches as structs (start, kind, end, value), by start, then kind (its number)."""
    out = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        search = F.expr(f"regexp_extract_all(_text, r'{PATTERNS[kind]}', 0)")
        none = F.expr("CAST(array() AS ARRAY<STRING>)")
        some = F.contains("_text", F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
        out = out.withColumn(f"_m_{kind}", F.when(some, search).otherwise(none))
    simple = "ARRAY<STRUCT<start: INT, end: INT, value: STRING>>"
    for kind in KINDS:
        gaps = f"split(_text, r'{PATTERNS[kind]}', -1)"
        valid = VALID[kind].replace("x.value", "x.m")
        out = out.withColumn(f"_s_{kind}", F.expr(placed(f"_m_{kind}", gaps, valid, "struct(x.start AS start, x.end AS end, x.m AS value)", simple)))
    every = ", ".join(f"transform(_s_{kind}, x -> struct(x.start AS start, {k} AS kind, x.end AS end, x.value AS value))" for k, kind in enumerate(KINDS))
    return out.withColumn("_base", F.expr(f"array_sort(concat({every}))")).drop(*(f"_{x}_{kind}" for kind in KINDS for x in "ms"))


def marked(text: str, base: str) -> str:
    """SQL for text with MARK for each letter of its entities; all else keeps its place."""
    letters = f"regexp_replace(substring(seg, cut + greatest(x.start - at, 0) + 1, x.end - greatest(x.start, at)), '[A-Za-z]', '{MARK}')"
    return replaced(text, base, "x.end > at", letters)


def examined(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, th, base) of each document; and of each with spans (id, th, marked, copy, entities, words): its text with marks, a hash that copies share, and its different entities and words."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("th"), F.col(text).alias("text"))
    based = with_base(slim, "text")
    # distinct as texts, which are hashed; structs would be compared one by one with all others
    entities = "transform(array_sort(array_distinct(transform(_base, x -> concat(x.kind, IF(x.kind = 0, lower(x.value), regexp_replace(x.value, '[^0-9.]', '')))))), e -> struct(int(substring(e, 1, 1)) AS kind, substring(e, 2) AS entity))"
    held = based.where("size(_base) > 0").withColumns({"entities": F.expr(entities), "marked": F.expr(marked("_text", "_base"))})
    words = f"""array_distinct(transform(filter(regexp_extract_all(marked, r"{TOKEN}", 0), w -> NOT contains(w, '{MARK}')), w -> lower(w)))"""
    copy = F.xxhash64(F.lower(F.regexp_replace("_text", r"\s+", " ")), "entities")
    return based.select("id", "th", F.col("_base").alias("base")), held.select("id", "th", "marked", copy.alias("copy"), "entities", F.expr(words).alias("words"))


#: What stands in the same copies is one class: two sums of hashes over the copies, and the rows that they stand for.
CLASS = {"entity": ["ea", "eb", "n_e"], "term": ["ta", "tb", "n_t"]}


def classed(rows: DataFrame, of: list[str], names: list[str]) -> DataFrame:
    """`of`, with its class and number of rows (names), and the number of copies that hold it (seen). rows: (copy, w, *of), each once."""
    sides = [F.bit_xor(F.xxhash64("copy", F.lit(k))).alias(name) for k, name in enumerate(names[:2])]
    return rows.groupBy(*of).agg(*sides, F.sum("w").alias(names[2]), F.count("*").alias("seen"))


def disclosing_classes(docs: DataFrame, held: DataFrame, text: str, disclosure: float, contexts: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(entities, terms, levels, best): classes of (kind, entity), classes of (term), (class, class, level) of those over the threshold, and (copy, term, level), the highest level of a term in a copy.

    Entities that stand in the same copies disclose alike, and so do terms that also have equal document frequencies:
    levels are worked out for pairs of classes, of which a log or a list that was copied has few, however many entities
    and words it holds.
    """
    n = float(docs.count())
    # a row for each text, with the number of its copies
    copies = stored(held.groupBy("copy").agg(F.count("*").alias("w"), F.first("entities").alias("entities"), F.first("words").alias("words")))
    entities = copies.select("copy", "w", F.explode("entities").alias("x")).select("copy", "w", "x.*")
    known = stored(classed(entities, ["kind", "entity"], CLASS["entity"]).where((F.col("seen") >= contexts) & (F.col("n_e") < n)).drop("seen"))
    least, most = known.agg(F.min("n_e"), F.max("n_e")).first()
    if least is None:
        none = known.select("kind", "entity", *CLASS["entity"], F.lit(0).cast("long").alias("copy"), F.lit("").alias("term"), *(F.lit(0).cast("long").alias(c) for c in CLASS["term"]), F.lit(0.0).alias("level")).limit(0)
        return known, none.select("term", *CLASS["term"]), none.select(*CLASS["entity"], *CLASS["term"], "level"), none.select("copy", "term", "level")
    of_entities = stored(entities.join(few(known), ["kind", "entity"]).select("copy", *CLASS["entity"]).distinct())
    sharing = copies.join(of_entities.select("copy").distinct(), "copy", "left_semi").select("copy", "w", F.explode("words").alias("term"))
    # the level can reach the threshold only if n_te / n_t >= (n_e / n) ** (1 - disclosure), and n_t <= n ** (1 - disclosure) * n_e ** disclosure
    slack = 1 - 1e-9
    within = classed(sharing, ["term"], ["ta", "tb", "n_tf"]).where(F.col("seen") >= contexts)
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))).alias("term"))
    # every word's document frequency, summed within tasks first, so that no join sees a row for each occurrence
    n_t = words.groupBy("term").agg(F.count("*").alias("n_t"))
    possible = (F.col("n_tf") >= F.col("n_t") * (slack * (least / n) ** (1 - disclosure))) & (F.col("n_t") * slack <= n ** (1 - disclosure) * most**disclosure)
    rare = stored(n_t.join(within, "term").where(possible).select("term", *CLASS["term"]))
    of_terms = stored(sharing.join(few(rare), "term").select("copy", "w", "term", *CLASS["term"]))
    together = of_terms.drop("term").distinct().join(of_entities, "copy").where(F.col("n_t") * slack <= n ** (1 - disclosure) * F.pow("n_e", F.lit(disclosure)))
    pairs = together.groupBy(*CLASS["entity"], *CLASS["term"]).agg(F.sum("w").alias("n_te"), F.count("*").alias("seen"))
    level = F.log(F.lit(n) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / F.log(F.lit(n) / F.col("n_e"))
    levels = stored(pairs.where(F.col("seen") >= contexts).withColumn("level", level).where(F.col("level") >= disclosure).select(*CLASS["entity"], *CLASS["term"], "level"))
    best = together.join(few(levels), [*CLASS["entity"], *CLASS["term"]]).groupBy("copy", *CLASS["term"]).agg(F.max("level").alias("level"))
    return known, rare, levels, stored(of_terms.join(best, ["copy", *CLASS["term"]]).select("copy", "term", "level"))


def disclosing(docs: DataFrame, held: DataFrame, text: str, disclosure: float, contexts: int) -> DataFrame:
    """(kind, entity, term, level): terms over the threshold for an entity; level is PMI / IC. A row for each pair, for reports: spans are found from the classes."""
    entities, terms, levels, _ = disclosing_classes(docs, held, text, disclosure, contexts)
    return levels.join(entities, CLASS["entity"]).join(terms, CLASS["term"]).select("kind", "entity", "term", "level")


def term_spans(held: DataFrame, best: DataFrame) -> DataFrame:
    """(id, th, terms): all places of disclosing terms in documents that hold their entities, as structs (start, kind, end, value); value is what stands there instead.

    held: rows of `examined`; best: (copy, term, level). The words of documents with such terms are joined with these one by one.
    """
    rows = held.dropDuplicates(["id", "th"]).join(few(stored(best.select("copy").distinct())), "copy", "left_semi")
    places = placed(f'regexp_extract_all(marked, r"{TOKEN}", 0)', f'split(marked, r"{TOKEN}", -1)', f"NOT contains(x.m, '{MARK}')", "struct(x.start AS start, x.end AS end, x.m AS value)", "ARRAY<STRUCT<start: INT, end: INT, value: STRING>>")
    tokens = rows.select("id", "th", "copy", F.explode(F.expr(places)).alias("x")).select("id", "th", "copy", "x.*", F.lower("x.value").alias("term"))
    instead = F.when(F.col("level") >= 1 - 1e-9, "").when(F.col("value").rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
    found = tokens.join(few(best), ["copy", "term"]).select("id", "th", F.struct("start", F.lit(len(KINDS)).alias("kind"), "end", instead.alias("value")).alias("x"))
    return found.groupBy("id", "th").agg(F.collect_list("x").alias("terms"))


def with_terms(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """rows (id, th, ...) with `terms`. The spans are broadcast when few, else both sides shuffle."""
    spans = stored(spans).select(F.col("id").alias("_i"), F.col("th").alias("_t"), "terms")
    if spans.limit(BROADCAST_ROWS // 4 + 1).count() <= BROADCAST_ROWS // 4:
        spans = F.broadcast(spans)
    return rows.join(spans, rows["id"].eqNullSafe(spans["_i"]) & (rows["th"] == spans["_t"]), "left").drop("_i", "_t")


def written(spans: str, kinds: list[str]) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')")


def every_span() -> Column:
    return F.expr(f"array_sort(concat(base, coalesce(terms, CAST(array() AS {SPANS}))))")


def found_spans(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, contexts: int = CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """(id, th, base) and (id, th, terms) of docs."""
    base, held = examined(docs, id_col, text)
    held = stored(held)
    return base, term_spans(held, disclosing_classes(docs, held, text, disclosure, contexts)[3])


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, contexts: int = CONTEXTS) -> DataFrame:
    """docs with spans (array of structs start, kind, end, value) and clean_text, in which labels stand for the spans."""
    docs = without(docs, ADDED)
    _, terms = found_spans(docs, id_col=id_col, text=text, disclosure=disclosure, contexts=contexts)
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row")).select("_row", F.col("_row").getField(id_col).alias("id"), F.coalesce(F.xxhash64(F.col("_row").getField(text)), F.lit(0)).alias("th"), F.col("_row").getField(text).alias("text"))
    rows = with_terms(with_base(rows, "text").withColumnRenamed("_base", "base"), terms).withColumn("_spans", every_span())
    labels = ", ".join(f"'{LABELS[k]}'" for k in KINDS)
    label = f"IF(x.kind < {len(KINDS)}, element_at(array({labels}, ''), x.kind + 1), x.value)"
    clean = f"IF(size(_spans) = 0, text, {replaced('_text', '_spans', 'x.start >= at', label)})"
    return rows.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns), F.col("_spans").alias("spans"), F.expr(clean).alias("clean_text"))


def op3_private_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base, terms = found_spans(docs)
    rows = with_terms(base, terms).withColumn("every", every_span())
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = {k})) AS BIGINT)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return rows.select(F.col("id").alias("doc_id"), *counts, F.sha2(written("base", KINDS), 256).alias("base_sha256"), written("every", [*KINDS, "term"]).alias("spans"))
