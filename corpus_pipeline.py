"""From raw documents to token ids: filter, deduplicate, redact, mix, encode.

Each stage takes the documents that the one before kept, written as a table and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import bpe, jaccard_join, mixing, quality, secret_scan
from clickweave.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the likelihood ratio."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_rules(docs, labels).where("kept").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group; repeated rows become one.

    Documents without id stay, as nothing is known of their groups.
    """
    groups = jaccard_join.near_duplicates(docs)
    first = groups.where("component_id = doc_id").select("doc_id").distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.struct("*").alias("row"))
    kept = rows.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text_key"])
    return kept.select("row.*").unionAll(docs.where(F.col("doc_id").isNull()))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return secret_scan.redact(docs, vocabulary, public_tokenizers.PATTERN)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, as many tokens as come in; a rare cell's documents repeat."""
    return mixing.repeated(mixing.mix(docs))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")).drop("decoded")


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("secret scan", secret_stage),
    ("source mixing", mixing_stage),
    ("bpe encoding", encode_stage),
]

# The likelihood ratio, proportional fitting and BPE have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
