"""One query for each operator, over its whole table, in the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laneforge.llm import conversations, kneser_ney, licenses, matroska, mixing, neighbours, periodic, quality, secrets, sharding, simhash, tokens
from laneforge.llm.common import documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.scored(documents(spark, sf_dir))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.found_secrets(documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.clusters(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op8_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media_digests(documents(spark, sf_dir))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(documents(spark, sf_dir).select("doc_id", "text"), digests_only=True).drop("text")


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.found_licenses(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(conversations.texts(conversations.conversations(spark, sf_dir)))
    return conversations.audits(rows)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(documents(spark, sf_dir))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(neighbours.embeddings(spark, sf_dir), is_table=True)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_secret_scans": op3_secret_scans,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_matroska": op8_matroska,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_license_scans": op10_license_scans,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

#: The others are beyond SQL; tests hold them against brute force.
ORACLES = {"op3_secret_scans": secrets.oracle(), "op6_quality_rules": quality.oracle(), "op11_conversation_repair": conversations.oracle()}
