"""The queries of this package, by the names the driver knows, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetmatch.llm import (bpe, decontaminate, divergence, html, langid, licenses, minhash, neighbours, packing, pii, repair,
                            shards, tokens)
from fleetmatch.llm.common import read_table


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(read_table(spark, sf_dir, "documents"))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_digest(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(read_table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.page_digest(read_table(spark, sf_dir, "pages"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_digest(read_table(spark, sf_dir, "documents"))


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicate_digest(read_table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_digest(read_table(spark, sf_dir, "embeddings"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(read_table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digest(read_table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_html": op3_html,
    "op4_token_files": op4_token_files,
    "op5_shards": op5_shards,
    "op6_language": op6_language,
    "op7_neighbours": op7_neighbours,
    "op8_leaks": op8_leaks,
    "op9_pii": op9_pii,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_packing": op11_packing,
    "op12_conversations": op12_conversations,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {"op13_divergence": divergence.ORACLE}
