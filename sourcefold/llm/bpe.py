"""BPE encoding and decoding with forced boundaries.

A merge can only ever join symbols that stand side by side inside some vocabulary token. Two neighbouring bytes that
no token holds side by side therefore mark a certain cut: the word is split there, the fragments are encoded
independently, and their ids are concatenated. Words are remembered, since few words make up most text.

Normalising and splitting into words follow the tokenizer's own file: special tokens are taken out of the raw text
first; white space never joins two words, so each run of other characters can be normalised and split alone. Text of
simple characters (below U+0180) is its own normal form and is split by a pattern without the library.

Defined cases: null and empty texts have no tokens and decode to the empty text; repeated rows are encoded alike;
the strings of special tokens inside a text give the special ids, as the library does; empty tables give empty
results; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import Memo, sliced, without

#: The characters with the Unicode property White_Space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The letters and numbers below U+0180, and whatever lies beyond.
LETTERS, NUMBERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc\xbd\xbe"
OTHER = re.compile("[^\x00-\u017f]")
#: Byte-level tokenizers write each byte as a printable character: itself where it is one, else the next from U+0100 on.
_printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = dict(zip([b for b in range(256) if b not in _printable], map(chr, range(256, 512))))
CHARS = {ord(c): b for b, c in BYTES.items()}
_loaded: dict = {}


class Codec:
    """A word-level BPE tokenizer (library file contents) that encodes fragment by fragment."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        spec = json.loads(source)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError("a plain BPE model is needed")
        library = Tokenizer.from_str(source)
        self.normalise, self.split = library.normalizer, library.pre_tokenizer
        vocab, merges = model["vocab"], [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        self.last = BPE(vocab, merges, end_of_word_suffix=self.suffix or None)
        self.inner = BPE(vocab, merges)
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that depend on their surroundings aren't supported")
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.strings = np.empty(max([*vocab.values(), *self.specials.values()]) + 1, object)
        for content, number in [*vocab.items(), *self.specials.items()]:
            self.strings[number] = content
        #: Neighbours inside some token: apart from the word's last symbol, and with it.
        self.beside, self.beside_last = set(), set()
        for token in vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            letters = token[: -len(self.suffix)] if ends else token
            pairs = [letters[i : i + 2] for i in range(len(letters) - 1)]
            if pairs:
                self.beside.update(pairs[:-1] if ends else pairs)
                self.beside_last.update(pairs[-1:] if ends or not self.suffix else [])
        self.split_simple = self._simple_split(spec)
        self.words = Memo(self._word, 150_000)
        self.pieces = Memo(self._piece, 20_000)
        self.chunks = Memo(self._chunk, 20_000)
        self.chunk = re.compile(f"[^{WHITE}]+")
        self.decimal = np.array([str(i) for i in range(len(self.strings))], object)

    @staticmethod
    def _simple_split(spec: dict):
        """The word pattern for lower-cased simple text, for files of the usual form."""
        split, *rest = (spec["pre_tokenizer"] or {}).get("pretokenizers", [None])
        usual = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        if not usual or split is None or split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] or [(r["type"], r["use_regex"], r["add_prefix_space"]) for r in rest] != [("ByteLevel", False, False)]:
            return None
        pattern = split["pattern"]["Regex"]
        for written, simple in (("[^\\s\\p{L}\\p{N}]", f"[^{WHITE}{LETTERS}{NUMBERS}]"), ("[\\p{L}]", f"[{LETTERS}]"), ("[\\p{N}]", f"[{NUMBERS}]")):
            pattern = pattern.replace(written, simple)
        return None if "\\" in pattern.replace(WHITE, "") else re.compile(pattern)

    def fragments(self, word: str) -> list[str]:
        """The word cut wherever two neighbours never stand side by side inside a token."""
        beside, end = self.beside, len(word) - 1
        cuts = [i for i in range(1, end) if word[i - 1 : i + 1] not in beside]
        if end > 0 and word[end - 1 :] not in self.beside_last:
            cuts.append(end)
        if not cuts:
            return [word]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, end + 1])]

    def _piece(self, key: tuple[str, bool]) -> list[int]:
        fragment, last = key
        return [t.id for t in (self.last if last else self.inner).tokenize(fragment)]

    def _word(self, word: str) -> bytes:
        """Packed ids of a normalised word."""
        *parts, end = self.fragments(word.encode().decode("latin-1").translate(BYTES))
        ids = [x for part in parts for x in self.pieces[part, False]]
        return np.array(ids + (self.pieces[end, True] if parts else self._piece((end, True))), "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Packed ids of characters between white space, without special tokens."""
        if self.split_simple and not OTHER.search(chunk):
            return self._simple(chunk)
        words = self.split.pre_tokenize_str(self.normalise.normalize_str(chunk))
        return b"".join([self.words[w.translate(CHARS).encode("latin-1").decode()] for w, _ in words])

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split_simple.findall(text.lower())))

    def _plain(self, text: str) -> bytes:
        """Packed ids of text without special tokens."""
        if self.split_simple and not OTHER.search(text):
            return self._simple(text)
        return b"".join(map(self.chunks.__getitem__, self.chunk.findall(text)))

    def encode(self, text: str | None) -> np.ndarray:
        out, done = [], 0
        for m in self.special.finditer(text or ""):
            out += [self._plain(text[done : m.start()]), np.array([self.specials[m[0]]], "<u4").tobytes()]
            done = m.end()
        out.append(self._plain(text[done:] if done else text or ""))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings joined by one space: the file names no decoder."""
        return " ".join(self.strings[ids])


def codec(source: str) -> Codec:
    """The codec of this worker for a tokenizer file's contents."""
    key = hashlib.sha1(source.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Codec(source)
    return _loaded[key]


def encode(docs: DataFrame, tokenizer_path: str, *, text: str = "text", keep: list[str] | None = None, digests: bool = False, ids: bool = True, decoded: bool = True) -> DataFrame:
    """The kept columns of docs (all by default) with ids (array<int>) and decoded (string).

    ids, decoded: whether to give each of the two. digests: give n_tokens, ids_sha256 and decoded_sha256 of them. The
    tokenizer file (a few MB, whatever the corpus) is read by the driver and broadcast.
    """
    docs = without(docs, ["ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"])
    keep = docs.columns if keep is None else keep
    with open(tokenizer_path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = [*(docs.schema[c] for c in keep)]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []
    fields += [T.StructField("decoded", T.StringType())] if decoded else []
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())] if digests else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(source.value)
        for batch in sliced(batches):
            found, back, sizes, a, b = [], [], [], [], []
            for value in batch.column(batch.schema.names.index(text)):
                codes = own.encode(value.as_py())
                if ids:
                    found.append(codes.astype(np.int32))
                if decoded or digests:
                    told = own.decode(codes)
                    back.append(told if decoded else None)
                if digests:
                    sizes.append(len(codes))
                    a.append(hashlib.sha256(" ".join(own.decimal[codes]).encode()).hexdigest())
                    b.append(hashlib.sha256(told.encode()).hexdigest())
            more = {"ids": pa.array(found, pa.list_(pa.int32()))} if ids else {}
            more |= {"decoded": pa.array(back, pa.string())} if decoded else {}
            more |= {"n_tokens": pa.array(sizes, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())} if digests else {}
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(c)) for c in keep), *more.values()], names=[*keep, *more])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, T.StructType(fields))


def op9_forced_boundary_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"], digests=True, ids=False, decoded=False)
