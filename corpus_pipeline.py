"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronojoin.llm import bagminhash, bpe_words, pfair_mix, quality_rda, secret_forest
from chronojoin.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its labels come from the table ``labels``."""
    return quality_rda.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return bagminhash.without_near_duplicates(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets replaced in text (n_chars follows)."""
    return secret_forest.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the source mixture."""
    return pfair_mix.in_order(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document, with its place in the mixture.

    mix_slot and mix_order depend on the set of rows only, so they are the ones
    by which the mixing stage ordered its files.  mix_order is unique and takes
    the place of the id while texts are tokenised: doc_ids may repeat or be null.
    """
    placed = pfair_mix.mixed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "mix_slot", "mix_order")
    placed = stored(placed, "pipeline-places")
    tokens = bpe_words.tokenised(placed.select(F.col("mix_order").alias("doc_id"), "text")).withColumnRenamed("doc_id", "mix_order")
    return tokens.join(placed.drop("text"), "mix_order").select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "mix_slot", "mix_order"
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# models, signatures and schedules are not SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
