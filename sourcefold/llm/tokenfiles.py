"""Token ids in binary files: frequency-ranked, byte-aligned, with separate control bytes.

Ids are renumbered by falling corpus frequency, so that common ids are small. A number takes one to four bytes; the
lengths stand apart, four to a control byte. Blocks of documents in ascending key order are rows of Parquet files
(Spark's committer makes retries harmless on any store), each with its keys, sizes, control bytes and data bytes;
a reader gets lengths and places of all numbers of a block by table lookup and a running sum in numpy.

Layout below the output path: `blocks/` (part, seq, first: ids of the part before this block, keys, sizes, control,
data) and `ranks/` (rank, id). Parts are in ascending key order.

Defined cases: a null or empty text holds the end id alone; null keys come first; rows with equal keys stand next to
each other, ordered by their ids; an empty table gives files without blocks.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .bpe import BYTES, LETTERS, NUMBERS, OTHER, WHITE
from .common import Memo, scratch, sliced, stored

#: Lengths of the four numbers behind each control byte.
LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], 1).astype(np.uint8)
BLOCK_IDS = 1_000_000
_loaded: dict = {}


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    size = (1 + (numbers > 0xFF) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)).astype(np.uint8)
    four = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    four[: len(size)] = size - 1
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    each = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), each[np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers that pack() wrote."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)))
    at = np.cumsum(size, dtype=np.int64) - size
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class Encoder:
    """Encodes with the tokenizers library, remembering stretches of text.

    No token of a byte-level tokenizer with the usual word split crosses from one stretch (an optional space and the
    non-space characters after it, or a run of white space) into the next, so each stretch is encoded once.
    """

    def __init__(self, source: str, kind: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.library.no_padding()
        self.library.no_truncation()
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.stretch = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.kind = kind
        self.memo = Memo(self._stretch, 50_000)
        self.model = None
        spec = json.loads(source)
        plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": spec["pre_tokenizer"].get("trim_offsets"), "use_regex": True}
        if plain and spec["model"]["type"] == "BPE" and not spec["normalizer"]:
            # the word split of such files; text of simple characters then needs no more of the library than its model
            self.model = self.library.model
            self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
            self.pieces = Memo(self._piece, 350_000)

    def _piece(self, piece: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(BYTES))], self.kind).tobytes()

    def _stretch(self, stretch: str) -> bytes:
        return np.array(self.library.encode(stretch, add_special_tokens=False).ids, self.kind).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        out: list[bytes] = []
        for text in texts:
            if self.special.search(text):  # what surrounds an added token is split apart from it
                out.append(self._stretch(text))
            elif self.model and not OTHER.search(text):
                out.append(b"".join(map(self.pieces.__getitem__, self.split.findall(text))))
            else:
                out.append(b"".join(map(self.memo.__getitem__, self.stretch.findall(text))))
        return out


def encoder(source: str, kind: str) -> Encoder:
    key = hashlib.sha1(source.encode()).hexdigest() + kind
    if key not in _loaded:
        _loaded[key] = Encoder(source, kind)
    return _loaded[key]


def tokenised(docs: DataFrame, tokenizer_path: str, *, key: str, text: str, end_id: int) -> tuple[DataFrame, str]:
    """(key, ids): the ids of each text and the end id, as little-endian bytes of the numpy type also returned."""
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    kind = "<u2" if max(end_id + 1, Tokenizer.from_str(content).get_vocab_size(True)) <= 0x10000 else "<u4"
    source = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(source.value, kind), np.array([end_id], kind).tobytes()
        for batch in sliced(batches):
            ids = own.encode_all([v or "" for v in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x + end for x in ids], pa.binary())], names=["key", "ids"])

    fields = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("ids", T.BinaryType())])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, fields), kind


def frequency_ranks(tokens: DataFrame, kind: str) -> DataFrame:
    """(rank, id): the ids that occur, by falling frequency, then id. At most as many rows as the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            total, found = (total, found) if len(total) >= len(found) else (found, total)
            total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counted = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counted.select((F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1).cast("long").alias("rank"), "id")


def write(docs: DataFrame, path: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text", end_id: int = 2) -> None:
    """Encodes all documents once and writes blocks and ranks below path."""
    spark = docs.sparkSession
    tokens, kind = tokenised(docs, tokenizer_path, key=key, text=text, end_id=end_id)
    tokens = stored(tokens)
    frequency_ranks(tokens, kind).coalesce(1).write.parquet(f"{path}/ranks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    table = np.zeros(1 + max((r.id for r in ranks), default=0), np.uint32)
    table[[r.id for r in ranks]] = [r["rank"] for r in ranks]
    table = spark.sparkContext.broadcast(table)
    kind_of_key = tokens.schema["key"].dataType

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, first, keys, ids = TaskContext.get().partitionId(), 0, 0, [], []

        def block() -> pa.RecordBatch:
            control, data = pack(table.value[np.frombuffer(b"".join(ids), kind)])
            width = np.dtype(kind).itemsize
            row = {"part": part, "seq": seq, "first": first, "keys": keys, "sizes": [len(x) // width for x in ids], "control": control, "data": data}
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

        size = 0
        for batch in batches:
            arrow = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("first", pa.int64()), ("keys", pa.list_(batch.schema.field("key").type)), ("sizes", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(k)
                ids.append(x)
                size += len(x) // np.dtype(kind).itemsize
                if size >= BLOCK_IDS:
                    yield block()
                    seq, first, size, keys, ids = seq + 1, first + size, 0, [], []
        if keys:
            yield block()

    fields = T.StructType([T.StructField(n, t) for n, t in (("part", T.LongType()), ("seq", T.LongType()), ("first", T.LongType()), ("keys", T.ArrayType(kind_of_key)), ("sizes", T.ArrayType(T.LongType())), ("control", T.BinaryType()), ("data", T.BinaryType()))])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = tokens.repartitionByRange(parts, "key", F.xxhash64("ids")).sortWithinPartitions("key", "ids")
    dealt.mapInArrow(blocks, fields).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """key, start, n_tokens, ids (array<int>; null if digest_only) and ids_crc32 of every document in the files."""
    found = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    table = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        table[r["rank"]] = r.id
    table = spark.sparkContext.broadcast(table)
    sizes = found.groupBy("part").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    # one row per part, that is per file
    offsets = sizes.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_offset"))
    fields = T.StructType([T.StructField("key", found.schema["keys"].dataType.elementType), *(T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i] for k, n in enumerate(batch.schema.names)}
                counts = np.array(row["sizes"].as_py(), np.int64)
                ids = table.value[unpack(row["control"].as_py(), row["data"].as_py(), int(counts.sum()))].astype("<u4")
                ends = np.cumsum(counts)
                each = [ids[a:b] for a, b in zip((ends - counts).tolist(), ends.tolist())]
                crc = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())
                lists = pa.nulls(len(each), pa.list_(pa.int32())) if digest_only else pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
                start = pa.array(ends - counts + row["first"].as_py() + row["_offset"].as_py())
                yield pa.RecordBatch.from_arrays([row["keys"].values, start, pa.array(counts), crc, lists], names=["key", "start", "n_tokens", "ids_crc32", "ids"])

    return found.join(F.broadcast(offsets), found.part == offsets._part).select("keys", "sizes", "control", "data", "first", "_offset").mapInArrow(run, fields)


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "tokens")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path, digest_only=True).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")
