"""Stages from raw documents to token ids; each reads what the one before wrote.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
documents, whatever further columns those have. Null texts count as empty, empty
tables pass through, and rows with equal ids are defined in each operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, exact_dedup, mixing, qda, simhash
from quayside.llm.spread import on_workers
from quayside.sources.relations import written

#: No SQL: fingerprint links, tilted rates and byte pairs are not expressible.
ORACLE_SQL = None

BPE = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    on_workers(spark)
    return qda.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text stays, that with the largest doc_id."""
    index = exact_dedup.fresh_index(spark)
    kept = exact_dedup.keep_one(docs, index)
    index.close()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per component of linked fingerprints stays, that with the smallest doc_id."""
    on_workers(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, not at all to three times."""
    return mixing.copied(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    on_workers(spark)
    return bpe.tokenized(docs, *BPE, keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
