"""From raw documents to token ids, in five stages.

Each stage works on all that the one before it kept, is written as Parquet to the
shared folder and read again. All but the last return the columns they got.

``run`` has no SQL check: SQL does not express the merges of the tokenizer.
``tests/llm/test_pipeline.py`` holds every stage against a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, neardup, rules, secrets
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import frozen

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return rules.kept_documents(docs, rules.POLICIES[rules.CURRENT])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return decontaminate.uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; ``n_chars`` follows."""
    clean = secrets.without_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = docs.select("doc_id", "lang", "source", tokenizer.encode_checked(F.col("text")).alias("e"))
    return encoded.select("doc_id", "lang", "source", F.size("e.ids").cast("long").alias("n_tokens"), "e.ids", "e.decodes")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_level_bpe", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = frozen(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
