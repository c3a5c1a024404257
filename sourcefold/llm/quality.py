"""Quality rules per document and per host.

Each document gets its own counts and a base verdict. Failures are aggregated by host, every host's failure rate is
shrunk towards the corpus by a beta prior estimated from all hosts (method of moments), and the host verdicts are
joined back: a document stays if it passes the base rules and its host's shrunken rate is at most `max_rate`.

Defined cases: a null or empty text has no words and fails; a document whose host is null is judged by itself alone;
repeated rows are judged and counted one by one; empty tables give empty results; columns of the input that bear an
added column's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import BROADCAST_ROWS, sliced, stored, without

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, (50, 100)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Smallest and largest weight of the prior, in documents.
PRIOR = 1.0, 1e6


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) >= 2_000_000:  # three ids no longer fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    again[hit] = again[hit + 1] = again[hit + 2] = True
    return int(again.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACE))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    return len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def rule_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns of docs (all by default) with the five counts and base_failed."""
    docs = without(docs, [*COUNTS, "base_failed"])
    keep = docs.columns if keep is None else keep
    fields = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [counts(v.as_py()) for v in batch.column(batch.schema.names.index(text))]
            own = [pa.array(x, pa.int64()) for x in zip(*found)] if found else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in keep), *own], names=[*keep, *COUNTS])

    out = docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, fields)
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (MAX_REPEATED[1] * F.col("n_repeat_words") > MAX_REPEATED[0] * F.col("n_words")))


def host_verdicts(counted: DataFrame, host: str, max_rate: float) -> DataFrame:
    """A row per host: host_docs, host_failed, host_rate (shrunken) and host_rejected."""
    hosts = counted.where(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    every = hosts.agg(F.sum("host_docs").alias("_n"), F.sum("host_failed").alias("_f"), F.count("*").alias("_m"), F.sum(F.col("host_failed") * F.col("host_failed") / F.col("host_docs")).alias("_q"))
    mean = F.col("_f") / F.col("_n")
    between = F.col("_q") / F.col("_n") - mean * mean - mean * (1 - mean) * F.col("_m") / F.col("_n")
    weight = F.when(between > 0, F.greatest(F.lit(PRIOR[0]), F.least(F.lit(PRIOR[1]), mean * (1 - mean) / between - 1))).otherwise(F.lit(PRIOR[1]))
    prior = every.select(mean.alias("_mean"), weight.alias("_weight"))
    rate = (F.col("host_failed") + F.col("_mean") * F.col("_weight")) / (F.col("host_docs") + F.col("_weight"))
    return hosts.join(F.broadcast(prior)).withColumn("host_rate", rate).drop("_mean", "_weight").withColumn("host_rejected", F.col("host_rate") > max_rate)


def with_verdicts(counted: DataFrame, hosts: DataFrame, host: str) -> DataFrame:
    """counted with `kept`. Hosts are broadcast when few; else a salted join spreads the rows of a large host."""
    few = hosts.where("host_rejected").select(F.col(host).alias("_host"))
    if few.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        out = counted.join(F.broadcast(few), F.col(host) == F.col("_host"), "left")
    else:
        salts = 64
        spread = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = counted.withColumn("_salted", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).join(spread, (F.col(host) == F.col("_host")) & (F.col("_salted") == F.col("_salt")), "left").drop("_salt", "_salted")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("_host").isNull()).drop("_host")


def judge(docs: DataFrame, *, text: str = "text", host: str = "source", max_rate: float = 0.9, keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all by default) with the counts, base_failed and kept. Texts are read and counted once, and not shuffled."""
    keep = [c for c in docs.columns if c.lower() != "kept"] if keep is None else keep
    counted = stored(rule_counts(docs, text, list(dict.fromkeys([*keep, host]))))
    found = with_verdicts(counted, stored(host_verdicts(counted, host, max_rate)), host)
    return found.select(*[f"`{c}`" for c in found.columns if c != host or host in keep])


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    counted = stored(rule_counts(docs, keep=["doc_id", "source"]))
    found = with_verdicts(counted, stored(host_verdicts(counted, "source", 0.9)), "source")
    return found.select("doc_id", *COUNTS, "base_failed", "kept")


OP6_SQL = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
tri AS (
  SELECT doc_id, unnest(range(0, len(w) - 2)) AS p, unnest(list_transform(range(0, len(w) - 2), lambda i: array_to_string(list_slice(w, i + 1, i + 3), ' '))) AS g FROM doc WHERE len(w) > 2),
rep AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri),
words AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM rep, range(0, 3) r(k) WHERE n > 1 GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM doc),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(words.n, 0)::BIGINT AS n_repeat_words
  FROM doc d LEFT JOIN words USING (doc_id) LEFT JOIN dup USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
host AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM failed WHERE source IS NOT NULL GROUP BY source),
allof AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS m, sum(f * f / n) AS q FROM host),
moment AS (SELECT f / n AS mu, q / n - (f / n) * (f / n) - (f / n) * (1 - f / n) * m / n AS b FROM allof),
prior AS (SELECT mu, CASE WHEN b > 0 THEN greatest(1.0, least(1e6, mu * (1 - mu) / b - 1)) ELSE 1e6 END AS k FROM moment),
bad AS (SELECT source FROM host, prior WHERE (f + mu * k) / (n + k) > 0.9)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.source IS NULL AS kept
FROM failed LEFT JOIN bad ON failed.source = bad.source
"""
