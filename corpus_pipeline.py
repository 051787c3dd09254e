"""A training corpus from ``documents``: rules, near copies, secrets, mix, tokens.

Each stage takes the documents that its predecessor kept, as a stored table, and works on all of
them. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laneforge.llm import mixing, near_copies, quality, secrets, tokens
from laneforge.sources.shared import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failed lines."""
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies (five words, 0.8)."""
    return near_copies.keep_one(docs, is_table=True)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by markers."""
    return secrets.redact(docs, is_table=True)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs, is_table=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with where each token ends in the text, and a round trip's verdict."""
    out = tokens.encode(docs)
    return out.selectExpr("doc_id", "source", "lang", "size(ids) AS n_tokens", "ids", "ends", "decoded = cast(coalesce(text, '') AS binary) AS exact")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing", source_mix),
    ("byte-level BPE", token_ids),
]

#: Fingerprints, balanced samples and merges of bytes are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
