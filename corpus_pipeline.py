"""The training-text pipeline: each stage works on all documents its predecessor kept.

Texts that read unlike trusted text go; of documents that say the same one stays; what holds benchmark passages
goes; secrets are struck out; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.llm import bpe, decontaminate, jaccard, kneser_ney, secrets
from veriledger.llm.frames import SLICE_BYTES, in_batches, stored, table

#: Bytes of an Arrow batch for stages that take smaller slices of text than SLICE_BYTES.
BATCH_BYTES = 2 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is beyond their language's quantile go, and those without text."""
    in_batches(spark, BATCH_BYTES)
    return kneser_ney.filtered(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    in_batches(spark, BATCH_BYTES)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    in_batches(spark, SLICE_BYTES)
    return decontaminate.removed(docs, table(spark, sf_dir, "benchmark"))


def secret_marks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark, and the length in characters follows the text."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens as little-endian 32-bit numbers, and how many there are."""
    in_batches(spark, BATCH_BYTES)
    return bpe.encode(docs).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_marks),
    ("byte-level BPE", encoding),
]

#: The stages are a trained model, set joins, suffix arrays and merges, which SQL does not express; the tests
#: hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "-".join(name.lower().split()))
    return docs
