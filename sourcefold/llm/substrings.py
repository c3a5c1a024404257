"""Substring dedup by level-wise doubling.

Repeated windows are found length by length: only what is repeated at one length is extended to twice that length,
up to the window asked for. At the shorter lengths one run of words stands for each window that is still open: of
the runs inside it, the one with the smallest hash. The choice depends on the window's words alone, so two equal
windows choose equal runs and a window whose run is found once can't be repeated. At the last length the windows
themselves are counted, and the words that repeated ones cover go.

Equal runs of one batch (of up to 64 MB of text) are counted on the spot; a run that is repeated there is announced
once, whatever the number of its occurrences, so no key gathers more rows than there are batches: at 100 TB about as
many as one task can count. Runs are told apart by 64-bit hashes of sequences of 64-bit word hashes, windows at the
last length by 96 bits.

Defined cases: a null or empty text has no words; a text of fewer words than a window loses none; rows with a null
id, and rows that repeat an id, count as documents of their own (equal ones repeat each other's windows), told apart
by a hash of the text, which only their places bear;
an empty table gives an empty result; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import BROADCAST_ROWS, ODD, gram_hashes, hashed, mix, sliced_by_size, without, word_hashes

WINDOW, FIRST = 35, 9
_memo = word_hashes()


def lengths(window: int, first: int) -> list[int]:
    """first, its doubles, and the window: each at most twice the one before."""
    found = [window]
    while found[0] > first:
        found.insert(0, max(first, -(-found[0] // 2)))
    return found


def chosen(words: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `length` words, and for each window the place of the run that stands for it."""
    grams = gram_hashes(words, length)
    inside = window - length + 1
    if inside == 1:
        return grams, np.arange(len(grams))
    view = np.lib.stride_tricks.sliding_window_view(grams, inside)
    place = np.empty(len(view), np.int64)
    for at in range(0, len(view), 65536):
        place[at : at + 65536] = view[at : at + 65536].argmin(1)
    return grams, place + np.arange(len(view))


def _candidates(length: int, before: int | None, window: int):
    """Rows (h, id, th, pos, at) from (id, th, text[, pos, at: places found repeated at the length before]).

    h, id, th and pos: a run that its batch holds once; h and pos alone: one that it holds several times, whose places
    in each document are packed into `at` of a row without h. The lower half of pos holds 32 more bits of the hash, at
    the last length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_size(batches, 2):
            hashes, tails, owners, places = [], [], [], []
            for k, value in enumerate(batch.column(2)):
                text = value.as_py()
                raw = text.encode().split() if text else []
                if len(raw) < window:
                    continue
                words = hashed(raw, _memo)
                grams, place = chosen(words, length, window)
                if before:
                    alive = np.zeros(len(words), bool)
                    alive[_places(batch.column(3)[k], batch.column(4)[k])] = True
                    place = place[alive[chosen(words, before, window)[1]]]
                place = np.unique(place)
                hashes.append(grams[place])
                tails.append(gram_hashes(mix(words ^ ODD), length)[place] >> np.uint64(32) if length == window else np.zeros(len(place), np.uint64))
                places.append(place)
                owners.append(np.full(len(place), k, np.int64))
            if not hashes:
                continue
            h, tail, at, owner = np.concatenate(hashes).view(np.int64), np.concatenate(tails).view(np.int64), np.concatenate(places).astype(np.int32), np.concatenate(owners)
            order = np.lexsort((tail, h))
            new = np.concatenate(([True], (h[order[1:]] != h[order[:-1]]) | (tail[order[1:]] != tail[order[:-1]])))
            single = np.zeros(len(h), bool)
            single[order[new & np.concatenate((new[1:], [True]))]] = True
            told = order[new & ~single[order]]
            row, at_known = owner[~single], at[~single]
            cuts = np.flatnonzero(np.diff(row)) + 1
            packed = [x.tobytes() for x in np.split(at_known, cuts)] if len(row) else []
            n, m, k = int(single.sum()), len(told), len(packed)
            of = pa.array(np.concatenate((owner[single], np.zeros(m, np.int64), row[np.concatenate(([0], cuts))] if k else row)), mask=np.concatenate((np.zeros(n, bool), np.ones(m, bool), np.zeros(k, bool))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(h[single]), pa.array(h[told]), pa.nulls(k, pa.int64())]),
                    batch.column(0).take(of),
                    batch.column(1).take(of),
                    pa.concat_arrays([pa.array((at[single].astype(np.int64) << 32) | tail[single]), pa.array(tail[told]), pa.nulls(k, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n + m, pa.binary()), pa.array(packed, pa.binary())]),
                ],
                names=["h", "id", "th", "pos", "at"],
            )

    return run


def _places(single, packed) -> np.ndarray:
    return np.concatenate((np.array(single.values, np.int32), np.frombuffer(b"".join(packed.as_py()), "<i4")))


def repeated(rows: DataFrame) -> DataFrame:
    """(id, th, pos, at): the places whose hash occurs again, by document."""
    known = F.col("at").isNotNull()
    key = F.when(known, F.xxhash64("id", "th")).otherwise(F.col("h"))
    tail = F.when(known, F.lit(-1)).otherwise(F.col("pos").bitwiseAND(F.lit(0xFFFFFFFF)))
    # columns, not expressions, to partition by: Spark would shuffle those beside what they are made of
    rows = rows.select(key.alias("h"), tail.alias("tail"), "id", "th", F.shiftright("pos", 32).cast("int").alias("pos"), "at")
    found = rows.withColumn("_n", F.count("*").over(Window.partitionBy("h", "tail"))).where(F.col("th").isNotNull() & (known | (F.col("_n") > 1)))
    return found.groupBy("id", "th").agg(F.collect_list("pos").alias("pos"), F.collect_list("at").alias("at"))


def with_places(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """docs (id, th, ...) with the places found in each; the shuffled texts are the same, and reused, at each length."""
    found = found.select(F.col("id").alias("_i"), F.col("th").alias("_t"), "pos", "at")
    return docs.join(found, docs["id"].eqNullSafe(found["_i"]) & (docs["th"] == found["_t"]), how).drop("_i", "_t")


def repeated_windows(docs: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """(id, th, pos, at) of the windows of (id, th, text) that start more than once."""
    found, before = None, None
    rows = T.StructType([T.StructField("h", T.LongType()), T.StructField("id", docs.schema["id"].dataType), T.StructField("th", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("at", T.BinaryType())])
    for length in lengths(window, first):
        source = docs if found is None else with_places(docs, found, "inner")
        found = repeated(source.mapInArrow(_candidates(length, before, window), rows))
        before = length
    return found


def marks(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, Column]:
    """docs and `th`, which tells apart rows of one id: a hash of the text where the id is null or repeated, else 0.

    Every place that is shuffled bears th, and zeros compress to almost nothing. Where over BROADCAST_ROWS ids are repeated, all rows have hashes.
    """
    own = F.coalesce(F.xxhash64(text), F.lit(0))
    twice = docs.groupBy(F.col(id_col).alias("_repeated")).count().where("count > 1 AND _repeated IS NOT NULL").select("_repeated")
    n = twice.limit(BROADCAST_ROWS + 1).count()
    if n > BROADCAST_ROWS:
        return docs, own
    if not n:
        return docs, F.when(F.col(id_col).isNull(), own).otherwise(F.lit(0).cast("long"))
    known = docs.join(F.broadcast(twice), F.col(id_col) == F.col("_repeated"), "left")
    return known, F.when(F.col(id_col).isNull() | F.col("_repeated").isNotNull(), own).otherwise(F.lit(0).cast("long"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST, texts: bool = True) -> DataFrame:
    """docs with n_words, n_removed, kept_sha256 and, if texts, kept_text (the kept words joined by one space)."""
    docs = without(docs, ["n_words", "n_removed", "kept_sha256", "kept_text"])
    more = [c for c in docs.columns if c not in (id_col, text)]
    keep = docs.columns
    marked, mark = marks(docs, id_col, text)
    slim = marked.select(F.col(id_col).alias("id"), mark.alias("th"), F.col(text).alias("text"))
    found = repeated_windows(slim, window, first)
    fields = T.StructType([*docs.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept_text", T.StringType())] if texts else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced_by_size(batches, keep.index(text)):
            sizes, gone, digests, left = [], [], [], []
            pos, at = batch.column(len(keep)), batch.column(len(keep) + 1)
            for k, value in enumerate(batch.column(batch.schema.names.index(text))):
                words = (value.as_py() or "").encode().split()
                n = len(words)
                if at[k].is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    places = np.unique(_places(pos[k], at[k]))
                    edge[places] += 1
                    edge[places + window] -= 1
                    keep_it = np.cumsum(edge[:-1]) == 0
                    words = [w for w, stays in zip(words, keep_it.tolist()) if stays]
                kept = b" ".join(words)
                sizes.append(n)
                gone.append(n - len(words))
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept.decode() if texts else None)
            own = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), *([pa.array(left, pa.string())] if texts else [])]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in keep), *own], names=fields.names)

    own = slim if not more else marked.select(F.col(id_col).alias("id"), mark.alias("th"), F.col(text).alias("text"), F.struct(*[f"`{c}`" for c in more]).alias("more"))
    out = with_places(own, found, "left")
    named = {id_col: F.col("id"), text: F.col("text")} | {c: F.col("more").getField(c) for c in more}
    return out.select(*(named[c].alias(c) for c in keep), F.col("pos").alias("_pos"), F.col("at").alias("_at")).mapInArrow(run, fields)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP2_SQL = r"""
WITH doc AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, unnest(range(0, len(w) - 34)) AS p, unnest(list_transform(range(0, len(w) - 34), lambda i: md5(array_to_string(list_slice(w, i + 1, i + 35), ' ')))) AS h FROM doc WHERE len(w) >= 35),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS i FROM rep, range(0, 35) r(k)),
word AS (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS x FROM doc),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM doc LEFT JOIN kept USING (doc_id)
"""
