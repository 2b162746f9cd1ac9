"""The numbered queries over whole tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    brown,
    chat,
    decontaminate,
    grades,
    importance,
    infill,
    lengths,
    neardup,
    pii,
    rules,
    secrets,
    spans,
    sql,
    suffixes,
)
from tidemark.sources.readers import read_table
from tidemark.sources.scratch import frozen

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql_text: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql_text is not None:
            ORACLE[fn.__name__] = sql_text
        return fn

    return register


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tokenizer_of(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query()
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text to token ids and back."""
    tokenizer = tokenizer_of(spark)
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    checked = docs.select("doc_id", tokenizer.round_trip(F.col("text")).alias("t"))
    return checked.select("doc_id", "t.n_tokens", "t.ids_sha256", F.sha2("t.decoded", 256).alias("decoded_sha256"))


@query(sql.CONTAMINATION)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand in a window shared with a benchmark item."""
    found = decontaminate.contamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(sql.SECRETS)
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every text."""
    found = secrets.secret_spans(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(spans.count(F.col("base"), kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        sha256(spans.listed(F.col("base"))).alias("base_sha256"),
        spans.listed(F.col("spans")).alias("spans"),
    )


@query()
def op4_class_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every document by class bigrams, and by unigrams as a base."""
    return brown.score_held_out(read_table(spark, folder, "documents"), spark)


@query(sql.PERSONAL)
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every text."""
    found = pii.personal_spans(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(spans.count(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        sha256(spans.listed(F.col("base"))).alias("base_sha256"),
        spans.listed(F.col("spans")).alias("spans"),
    )


@query(sql.CHAT)
def op6_chat_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted as prefix trees and read back."""
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    one = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(says).alias("text"),
    )
    tree = chat.PrefixTree(turns.unionByName(one), tokenizer_of(spark))
    # The packed table is written: it is the output that conversations are read back from.
    return tree.digests(frozen(tree.nodes(), "chat-nodes")).withColumnRenamed("conv", "conv_id")


@query()
def op7_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, probability of the top grade and verdict of every document."""
    return grades.classified(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query(sql.RULES)
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements and verdict of every document under the current policy."""
    book = rules.ledger(read_table(spark, folder, "documents"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return book.select(
        "doc_id",
        *(F.col(f"measures.{m}").alias(m) for m in measures),
        (~rules.passes(F.col("failed"), rules.POLICIES[1])).alias("base_failed"),
        rules.passes(F.col("failed"), rules.POLICIES[rules.CURRENT]).alias("kept"),
    )


@query(sql.NEAR_DUPLICATES)
def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Set size, component and verdict of every document."""
    return neardup.near_duplicates(read_table(spark, folder, "documents"))


@query()
def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that share passages of 50 words or more, and where they stand."""
    found = suffixes.repeated_passages(read_table(spark, folder, "documents"))
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", "n_words", "n_repeated", F.array_join(listed, ",").alias("spans"), "others")


@query()
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every text, and whether they exceed 512 tokens."""
    counter = lengths.TokenCounter(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return lengths.token_counts(read_table(spark, folder, "documents"), counter, 512)


@query(sql.IMPORTANCE)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and, if drawn, rank of every document, with the benchmark as target."""
    return importance.resampled(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query(sql.INFILL)
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, half of them cut at two places and reordered, and the text rebuilt from the output."""
    made = infill.infilled(read_table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(F.col("output")).alias("output_sha256"),
        sha256(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
