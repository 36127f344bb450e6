"""The corpus pipeline: documents to token ids, each stage on all that its predecessor kept.

1. ``language_id``: documents whose language is not found go.
2. ``near_dedup``: one document of each class of near copies stays, the one with the smallest id.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``pii``: personal data in the texts is replaced by its kind; ``n_chars`` follows.
5. ``byte_bpe``: the texts become token ids (``ids``, packed unsigned 32-bit integers).

All stages but the last return the columns of their input. A null or empty text
has no language and goes with the first stage. An empty table gives an empty
result; repeated rows are near copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetmatch.llm import bpe, decontaminate, langid, minhash, pii
from fleetmatch.llm.common import read_table, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", without_benchmark),
          ("pii", without_pii), ("byte_bpe", encoded)]

#: Not for SQL: learned, sampled and edited. The tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
