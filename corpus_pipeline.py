"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of docs with the columns of documents; the last one
returns ids. Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sourcefold.llm import bpe, decontamination, neardup, private, quality
from sourcefold.llm.common import small_batches, stored
from sourcefold.shipping import ship


def prepare(spark: SparkSession) -> None:
    """The stages share executors, whose Python workers keep what each has loaded."""
    ship(spark)
    small_batches(spark)


#: What the operators read; all other columns are carried along out of the way of the columns that operators add.
BASE = ["doc_id", "text", "source"]


def packed(docs: DataFrame) -> DataFrame:
    return docs.select(*BASE, F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in docs.columns if c not in BASE]).alias("_rest"))


def unpacked(docs: DataFrame, found: DataFrame, clean: str = "text") -> DataFrame:
    """The columns of docs from what an operator made of packed(docs), with the cleaned text as text; n_chars follows a cleaned text."""
    own = {c: F.col(c) if c in BASE else F.col("_rest").getField(c) for c in docs.columns} | {"text": F.col(clean)}
    if clean != "text" and "n_chars" in own:
        own["n_chars"] = F.length(clean).cast(docs.schema["n_chars"].dataType)
    return found.select(*(column.alias(c) for c, column in own.items()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that do."""
    prepare(spark)
    return unpacked(docs, quality.judge(packed(docs)).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate class (5-word shingles, similarity 0.8)."""
    prepare(spark)
    return neardup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text, without that text."""
    prepare(spark)
    found = decontamination.decontaminate(packed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return unpacked(docs, found.where("NOT contaminated"), "clean_text")


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with labels in place of personal data."""
    prepare(spark)
    return unpacked(docs, private.sanitise(packed(docs)), "clean_text")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens."""
    prepare(spark)
    found = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "lang", "source"], decoded=False)
    return found.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("private_data", private_data),
    ("token_ids", token_ids),
]

#: SQL can express neither the BPE nor the labels beside entities; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
