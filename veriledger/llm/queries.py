"""The numbered queries over the given tables and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriledger.llm import (
    bpe,
    centroids,
    chunks,
    decontaminate,
    hard_negatives,
    html_text,
    jaccard,
    kneser_ney,
    oracle,
    rules,
    secrets,
    shards,
    superminhash,
    toxicity,
)
from veriledger.llm.frames import table


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.placements(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.pages(table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings").withColumn("label", label), "key % 100 = 0")


def op12_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.report(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings")).withColumnRenamed("key", "vec_id")


QUERIES = {f.__name__: f for f in (
    op1_shards, op2_decontamination, op3_kneser_ney, op4_quality_rules, op5_secrets, op6_toxicity, op7_html_text,
    op8_byte_bpe, op9_jaccard, op10_chunks, op11_hard_negatives, op12_superminhash, op13_centroids)}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": oracle.decontamination(),
    "op5_secrets": oracle.secret_scan(),
    "op9_jaccard": oracle.jaccard(),
    "op11_hard_negatives": oracle.hard_negatives(),
    "op12_superminhash": oracle.jaccard(80, ", doc_id = min(r.b) as kept"),
    "op13_centroids": oracle.centroids(),
}
