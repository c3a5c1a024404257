"""Benchmark decontamination with a generalised suffix automaton.

The test items' normalised words build one automaton. Documents stream through it word by word, tracking the longest
suffix that occurs in any item; a word is hit when a window (`window` consecutive item words, or a whole shorter
item) ends at or after it and begins at or before it.

Defined cases: a null or empty text has no words and is never contaminated; an item without words, or without an id,
has no window; repeated items, or items that share windows, are all named, each id once; an empty benchmark hits
nothing; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import sliced, stored, without

WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
ADDED = ["n_words", "n_hit", "items", "contaminated", "clean_text"]
#: Bytes of item texts in one automaton. A larger benchmark is matched in blocks of about this size.
BLOCK_BYTES = 4_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORDS).split() if text else []


class Automaton:
    """Suffix automaton of many word sequences, with the windows that each state's longest match ends."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.windows: dict[int, dict[int, set[str]]] = {}
        self.found: dict[tuple[int, int], tuple[int, frozenset]] = {}
        coded = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for i, ws in items if ws]
        for _, word_ids in coded:
            self._add(word_ids)
        self.shortest = min((min(window, len(x)) for _, x in coded), default=0)
        base = len(self.vocabulary)
        self.pairs = np.unique(np.array([a * base + b for _, x in coded for a, b in zip(x, x[1:])], np.int64))
        for item, word_ids in coded:
            size = min(window, len(word_ids))
            state = matched = 0
            for w in word_ids:
                state, matched = self.step(state, matched, w)
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                    matched = self.length[state]
                if matched >= size:
                    self.windows.setdefault(state, {}).setdefault(size, set()).add(item)
        # from now on all moves are in one table, which takes a fraction of the memory of one for each state
        self.moves = {state * base + w: to for state, moves in enumerate(self.next) for w, to in moves.items()}
        self.link, self.length, self.next = array("i", self.link), array("i", self.length), []

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, of: int, w: int, to: int) -> int:
        """The state of the strings that reach `to` from `of` by w, made apart from longer ones if need be."""
        if self.length[of] + 1 == self.length[to]:
            return to
        twin = self._state(self.length[of] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = twin
        while of >= 0 and self.next[of].get(w) == to:
            self.next[of][w] = twin
            of = self.link[of]
        return twin

    def _add(self, word_ids: list[int]) -> None:
        last = 0
        for w in word_ids:
            if w in self.next[last]:
                last = self._split(last, w, self.next[last][w])
                continue
            at, last = last, self._state(self.length[last] + 1, {}, 0)
            while at >= 0 and w not in self.next[at]:
                self.next[at][w] = last
                at = self.link[at]
            if at >= 0:
                self.link[last] = self._split(at, w, self.next[at][w])

    def _to(self, state: int, w: int) -> int | None:
        if self.next:
            return self.next[state].get(w)
        return self.moves.get(state * len(self.vocabulary) + w) if w >= 0 else None

    def step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        to = self._to(state, w)
        while state and to is None:
            state = self.link[state]
            matched = self.length[state]
            to = self._to(state, w)
        return (to, matched + 1) if to is not None else (0, 0)

    def ends(self, state: int, matched: int) -> tuple[int, frozenset]:
        """The longest window that ends here, and the items of all windows that do."""
        key = (state, matched)
        if key not in self.found:
            longest, items = 0, set()
            while state > 0:
                for size, of in self.windows.get(state, {}).items():
                    if size <= matched:
                        longest = max(longest, size)
                        items |= of
                state = self.link[state]
                matched = self.length[state]
            if len(self.found) > 1_000_000:
                self.found.clear()
            self.found[key] = longest, frozenset(items)
        return self.found[key]

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (start, end exclusive, in order, apart) and the items behind them."""
        n = len(words)
        if not self.shortest or n < self.shortest:
            return [], set()
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, n)
        # only stretches whose neighbouring words are neighbours in some item can hold a window
        if self.shortest > 1:
            both = (ids[:-1] >= 0) & (ids[1:] >= 0)
            code = np.where(both, ids[:-1] * len(self.vocabulary) + ids[1:], -1)
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            fits = np.concatenate(([0], (self.pairs[at] == code).astype(np.int8), [0]))
        else:
            fits = np.concatenate(([0], (ids >= 0).astype(np.int8), [0]))
        edges = np.diff(fits)
        begins, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        more = 1 if self.shortest > 1 else 0
        long = stops - begins + more >= self.shortest
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for begin, stop in zip(begins[long].tolist(), (stops[long] + more).tolist()):
            state = matched = 0
            for i, w in enumerate(ids[begin:stop].tolist(), begin):
                state, matched = self.step(state, matched, w)
                if matched >= self.shortest:
                    size, of = self.ends(state, matched)
                    if size:
                        items |= of
                        start = i + 1 - size
                        while spans and spans[-1][1] >= start:
                            start = min(start, spans.pop()[0])
                        spans.append((start, i + 1))
        return spans, items


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans, nor what lies between them inside a span."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORDS))]
    out, done = [], 0
    for start, end in spans:
        out.append(raw[done : at[start][0]])
        done = at[end - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, coverage: tuple[int, int] = (1, 20), max_span: int = 0, clean: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, n_hit, items (array of ids as strings, sorted), contaminated, and clean_text.

    contaminated: at least coverage[0]/coverage[1] of the words are hit. clean_text: the text without the hit spans
    of more than max_span words. The benchmark is a query set: it is dealt by hash into blocks of about block_bytes, each held by
    the driver one at a time and broadcast as an automaton, and all documents stream through each block.
    """
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs = without(docs, [*ADDED, "_hit_spans", "_hit_items"])
    kept = list(docs.schema)
    between = T.StructType([*kept, T.StructField("_hit_spans", T.ArrayType(T.IntegerType())), T.StructField("_hit_items", T.ArrayType(T.StringType()))])
    final = T.StructType([*kept, *(T.StructField(n, t) for n, t in (("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.StringType())), ("clean_text", T.StringType())))])
    for block in range(blocks):
        if block:  # one automaton at a time is in a worker's memory
            out = stored(out)
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        automaton = spark.sparkContext.broadcast(Automaton([(r.i, words_of(r.t)) for r in own.sort("i", "t").collect()], window))
        last = block == blocks - 1
        out = out.mapInArrow(_pass(automaton, text, [f.name for f in kept], last, clean, max_span), final if last else between)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage[1] >= F.col("n_words") * coverage[0]))


def _pass(automaton, text: str, kept: list[str], last: bool, clean: bool, max_span: int):
    """Adds what one block of the benchmark hits to what earlier blocks did; the last pass gives the results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = automaton.value.stream
        for batch in sliced(batches):
            named = dict(zip(batch.schema.names, batch.columns))
            n = batch.num_rows
            before = named["_hit_spans"].to_pylist() if "_hit_spans" in named else [[]] * n
            earlier = named["_hit_items"].to_pylist() if "_hit_items" in named else [[]] * n
            flats, items, sizes, hits, texts = [], [], [], [], []
            for value, old, of in zip(named[text], before, earlier):
                said = value.as_py()
                words = words_of(said)
                found, more = match(words)
                flat = [*old, *(x for s in found for x in s)]
                items.append(sorted({*of, *more}))
                if not last:
                    flats.append(flat)
                    continue
                spans = merged(flat)
                sizes.append(len(words))
                hits.append(sum(b - a for a, b in spans))
                over = [s for s in spans if s[1] - s[0] > max_span] if clean else []
                texts.append((cut_words(said, over) if over else said) if clean else None)
            if last:
                own = {"n_words": pa.array(sizes, pa.int64()), "n_hit": pa.array(hits, pa.int64()), "items": pa.array(items, pa.list_(pa.string())), "clean_text": pa.array(texts, pa.string())}
            else:
                own = {"_hit_spans": pa.array(flats, pa.list_(pa.int32())), "_hit_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([*(named[c] for c in kept), *own.values()], names=[*kept, *own])

    return run


def merged(flat: list[int]) -> list[tuple[int, int]]:
    """Spans given as start, end, start, end ... as ordered spans that don't touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(flat[::2], flat[1::2])):
        if out and out[-1][1] >= start:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def op1_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), clean=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


OP1_SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, len(s) AS size, array_to_string(s, ' ') AS win
  FROM (SELECT item_id, unnest(list_transform(range(0, greatest(len(w) - 12, 1)), lambda i: list_slice(w, i + 1, i + 13))) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
gram AS (
  SELECT doc_id, size, unnest(range(0, len(w) - size + 1)) AS p, unnest(list_transform(range(0, len(w) - size + 1), lambda i: array_to_string(list_slice(w, i + 1, i + size), ' '))) AS win
  FROM doc, sizes WHERE len(w) >= size),
hit AS (SELECT g.doc_id, g.p, g.size, v.item_id FROM gram g JOIN win v ON g.size = v.size AND g.win = v.win),
words AS (SELECT doc_id, count(DISTINCT p + k) AS n_hit FROM hit, range(0, 13) r(k) WHERE k < size GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""
