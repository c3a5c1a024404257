"""Helpers that the text operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows of a skinny table (ids, verdicts) up to which it may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000

M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
ODD = np.uint64(0x9E3779B97F4A7C15)
S33, S29 = np.uint64(33), np.uint64(29)

_made: dict[str, str] = {}
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Memo(dict):
    """key -> make(key), in two generations of up to `limit` entries: what wasn't asked for during one is forgotten."""

    def __init__(self, make, limit: int = 100_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def word_hashes() -> Memo:
    """64-bit hashes of byte strings, the same in every process."""
    return Memo(xxhash.xxh64_intdigest, 50_000)


def hashed(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> S33)) * M1
    x = (x ^ (x >> S29)) * M2
    return x ^ (x >> S33)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a sequence from the hashes of its two parts."""
    return mix(a * ODD + b)


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` words, by doubling: a run of 2k words is two runs of k."""
    part, k, done, out = words, 1, 0, None
    while True:
        if length & k:
            out = part if out is None else joined(out[: len(part) - done], part[done:])
            done += k
        if done == length:
            return out[: len(words) - length + 1]
        part = joined(part[: len(part) - k], part[k:])
        k *= 2


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sliced_by_size(batches: Iterator[pa.RecordBatch], column: int, most: int = 64_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts, in the numbered column, have about so many bytes at most."""
    for batch in batches:
        done = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Smaller Arrow batches where the session has Spark's own size: texts can be long, and batches stand in memory on both sides."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def batches_by_size(spark: SparkSession) -> None:
    """Arrow batches of some 16 MB at most: rows that carry texts or whole sets are large, and batches of skinny rows keep Spark's number."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 * 2**20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, as in tests, gets one made where that is unset."""
    context = spark.sparkContext
    if context.applicationId not in _made:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        _made[context.applicationId] = (found or tempfile.mkdtemp(prefix="sourcefold-")).rstrip("/")
    return _made[context.applicationId]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed at the application's end: results are lazy, so no sooner."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame) -> DataFrame:
    """The same rows read from a Parquet table in the shared folder, so that lost executors cost no recomputation.

    Unlike a checkpoint's, its size is known to the planner: estimates don't multiply from round to round of a loop.
    """
    path = scratch(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame) -> DataFrame:
    """df, broadcast when its rows are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def join_counted(rows: DataFrame, keys: DataFrame, on: list[str], n: str) -> DataFrame:
    """rows joined with keys, a table of one row per key that holds the number n of its rows.

    Where the keys are many, those with over a thousandth of all rows, at most 1,000 therefore, are broadcast, so that
    no task gets all rows of a frequent key.
    """
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), on)
    often = F.col(n) * 1000 > (keys.agg(F.sum(n)).first()[0] or 0)
    many = keys.where(often)
    rare = rows.join(F.broadcast(many.select(*on)), on, "left_anti").join(keys.where(~often), on)
    return rows.join(F.broadcast(many), on).unionByName(rare)


def without(docs: DataFrame, names: list[str]) -> DataFrame:
    """docs less the columns that an operator is about to add; names match as Spark matches them, without case."""
    taken = {n.lower() for n in names}
    return docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in taken])
