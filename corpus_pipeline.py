"""Documents to token ids, stage by stage: toxic texts go, near copies go, secrets are masked, domains are mixed, texts are encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import bpe, mixing, secrets, simhash, toxicity
from tillwise.llm.common import read
from tillwise.session import new_path

#: Documents from this score on are toxic; the target weights of the domains (None: evened shares).
TOXIC = 0.3
TARGETS: dict[str, float] | None = None


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects; it learns from the labelled ones among ``docs``."""
    return toxicity.clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), TOXIC)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.deduplicate(docs)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or go by their rates, so that the domains' tokens meet their targets."""
    return mixing.mix(docs, read(spark, sf_dir, "labels"), "lang", TARGETS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document."""
    columns = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(columns, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash_dedup", near_copies_out),
    ("secret_scan", secrets_masked),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: SQL can express neither the classifier nor the fingerprints; the tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
