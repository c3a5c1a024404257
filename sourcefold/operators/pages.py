"""Pages: visible text, kinds, and whether a quote stands on a page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import fold

# Elements whose text isn't seen, and those that begin a line.
HIDDEN = {"script", "style", "noscript", "template", "head", "svg"}
BLOCKS = set("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th tr ul".split())
LITTLE, MENU, MENU_LINE = 200, 1000, 100
SHARE, LEAST_WORDS = 0.8, 3
# Abbreviations in addresses, countries that an address may leave out, and scripts without spaces between words.
ABBREVIATIONS = {"rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "hwy": "highway", "dr": "drive", "ln": "lane", "blvd": "boulevard", "cres": "crescent", "ct": "court", "pl": "place", "tce": "terrace", "pkwy": "parkway", "rte": "route", "mt": "mount", "nth": "north", "sth": "south"}
COUNTRIES = "united kingdom uk england scotland wales northern ireland canada australia zealand nz aotearoa".split()
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
ELLIPSIS = re.compile(r"\.\s?\.\s?\.|…")
#: A word that a line end parts.
HYPHEN = re.compile(r"(\w)[-\u2010\u2011\u00ad]\s*\n\s*(\w)")


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in HIDDEN:
            self.hidden += 1
        elif tag in BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def visible_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Visible()
    parser.feed(html)
    parser.close()
    lines = (" ".join(line.split()) for line in "".join(parser.out).split("\n"))
    return "\n".join(line for line in lines if line)


def page_texts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, text, note) of each page: what a reader sees, and `little text` for pages that hold next to none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "text": frame[html].map(visible_text)})

    text = pages.select(key, html).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, text string")
    return text.withColumn("note", F.when(F.length("text") < LITTLE, "little text").otherwise(""))


def page_kind(body: Column, url: Column) -> Column:
    """pdf, html or text, by how a body begins, else by the link's suffix."""
    start = F.lower(F.trim(F.substring(body, 1, 200)))
    return F.when(start.startswith("%pdf"), "pdf").when(start.rlike(r"^(<!doctype html|<html|<head|<body)"), "html").when(F.lower(url).rlike(r"\.pdf([?#]|$)"), "pdf").when(start.rlike(r"<[a-z][^>]*>"), "html").otherwise("text")


def menu_only(text: Column) -> Column:
    """Whether a short text has no line longer than a menu's."""
    return (F.length(text) < MENU) & F.forall(F.split(text, "\n"), lambda x: F.length(x) <= MENU_LINE)


TEXTS = T.ArrayType(T.StringType())
FORMS = T.StructType([T.StructField(x, T.StringType()) for x in ("plain", "whole", "joined", "compact")])
PART = T.StructType([*(T.StructField(x, T.StringType()) for x in ("plain", "joined", "compact")), T.StructField("unspaced", T.BooleanType())])
QUOTE = T.StructType([T.StructField("parts", T.ArrayType(PART)), T.StructField("said", TEXTS), T.StructField("pairs", TEXTS), T.StructField("words", T.IntegerType())])


def joined(plain_text: str) -> str:
    """Plain text compared another way: numbers whole, units apart from them, abbreviations written out."""
    text = re.sub(r"(?<=\d) (?=\d)", "", plain_text)
    text = re.sub(r"(?<=\d)(?=[^\W\d_])|(?<=[^\W\d_])(?=\d)", " ", text)
    return " ".join(ABBREVIATIONS.get(w, w) for w in text.split())


def plain_text(text: str) -> str:
    return re.sub(r"[\W_]+", " ", fold(text).replace("per cent", "percent")).strip()


@F.pandas_udf(FORMS)
def page_forms(texts: pd.Series) -> pd.DataFrame:
    """The forms in which a page is compared: its words, with those that a line end parts put together, with numbers whole, and without spaces."""

    def one(text):
        if text is None:
            return None, None, None, None
        plain = plain_text(text)
        mended = HYPHEN.sub(r"\1\2", text)
        whole = plain if mended == text else plain_text(mended)
        return plain, whole, joined(whole), whole.replace(" ", "")

    return pd.DataFrame([one(t) for t in texts], columns=["plain", "whole", "joined", "compact"])


@F.pandas_udf(QUOTE)
def quote_forms(texts: pd.Series) -> pd.DataFrame:
    """A quote's parts between ellipses in the forms of a page, the words of all of it, and its pairs of characters if its script has no spaces."""

    def one(text):
        parts = [p for p in map(plain_text, ELLIPSIS.split(text or "")) if p]
        every = " ".join(parts)
        compact = every.replace(" ", "")
        dense = bool(UNSPACED.search(every))
        said = joined(every).split()
        return [{"plain": p, "joined": joined(p), "compact": p.replace(" ", ""), "unspaced": bool(UNSPACED.search(p))} for p in parts], said, [compact[k : k + 2] for k in range(len(compact) - 1)] if dense else None, len(said)

    return pd.DataFrame([one(t) for t in texts], columns=["parts", "said", "pairs", "words"])


def fold_pages(pages: DataFrame) -> DataFrame:
    """pages with the forms that quotes are compared in, computed once per page."""
    out = pages.withColumn("_f", page_forms("text")).withColumns({f"_{x}": F.col("_f")[x] for x in ("plain", "whole", "joined", "compact")}).drop("_f")
    return out.withColumn("_words", F.array_distinct(F.concat(*[F.split(x, " ") for x in ("_plain", "_whole", "_joined")])))


def quote_results(quotes: DataFrame, pages: DataFrame, key: str, least_words: int = LEAST_WORDS) -> DataFrame:
    """quotes with `result`: found, partly, not found, not in the part read, or no page text; null for quotes of under three words.

    Parts between ellipses must each stand on the page; else four fifths of the words and every number. In scripts without
    spaces a part stands anywhere, and pairs of characters are counted in place of words. Only pages that are quoted
    are folded. Where pages say so in a boolean column `partial`, what isn't found is not in the part that was read.
    """
    asked = pages.join(quotes.select(key).distinct(), key, "left_semi")
    partial = F.coalesce("_partial", F.lit(False))
    held = fold_pages(asked.select(key, "text", (F.col("partial") if "partial" in pages.columns else F.lit(False)).alias("_partial")))
    both = quotes.withColumn("_q", quote_forms("quote")).join(held.drop("text"), key, "left")
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    stands = lambda p: F.contains(pad(F.col("_plain")), pad(p["plain"])) | F.contains(pad(F.col("_whole")), pad(p["plain"])) | F.contains(pad(F.col("_joined")), pad(p["joined"]))
    on_page = F.forall("_q.parts", lambda p: F.when(p["unspaced"], F.contains(F.col("_compact"), p["compact"])).otherwise(stands(p)))
    numbers = F.filter("_q.said", lambda w: w.rlike(r"\d"))
    counted = F.filter("_q.said", lambda w: ((F.length(w) > 2) | w.rlike(r"^\d+$")) & ~w.isin(COUNTRIES))
    # on the page's words by one lookup each; a word that is said twice counts twice
    share = lambda c: F.transform(F.array(F.array_intersect(c, F.col("_words"))), lambda hit: F.size(F.filter(c, lambda w: F.array_contains(hit, w))))[0]
    by_words = (F.size(F.array_except(numbers, F.col("_words"))) == 0) & (F.size(counted) > 0) & (share(counted) >= SHARE * F.size(counted))
    by_pairs = (F.size("_q.pairs") > 0) & (F.size(F.filter("_q.pairs", lambda p: F.contains(F.col("_compact"), p))) >= SHARE * F.size("_q.pairs"))
    mostly = F.when(F.col("_q.pairs").isNotNull(), by_pairs).otherwise(by_words)
    short = (F.size("_q.parts") == 0) | (F.col("_q.pairs").isNull() & (F.col("_q.words") < least_words))
    result = F.when(short, F.lit(None)).when(F.col("_plain").isNull(), "no page text").when(on_page, "found").when(mostly, "partly").when(partial, "not in the part read").otherwise("not found")
    return both.withColumn("result", result).select(*quotes.columns, "result")
