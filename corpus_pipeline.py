"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm import bpe, decontamination, near_dup, quality, secrets
from nightaudit.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the outlier test rejects go."""
    return quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return near_dup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; n_chars follows the text."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes decoded from them."""
    return bpe.encode_checked(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("encode", encode)]

#: The outlier estimate has no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
