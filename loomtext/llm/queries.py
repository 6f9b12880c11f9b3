"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import (align, chat, embeddings, manifest, mixing, oracles, packing, quality, rules, search, secrets, simhash,
                          suffix, tokens)
from loomtext.llm.common import columns_of


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(columns_of(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_of(spark, sf_dir, "documents", "doc_id", "text")
    scored = quality.classify_quality(docs, columns_of(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = columns_of(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(2, numPartitions=1).select(
        F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    more = more.select(*[F.col(f.name).cast(f.dataType) for f in turns.schema.fields])
    return chat.digest(chat.format_conversations(turns.union(more)))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(columns_of(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With n_kept and kept_text, what remains (cut characters become U+FFFD)."""
    out = suffix.remove_repeats(columns_of(spark, sf_dir, "documents", "doc_id", "text"))
    return out.withColumn("n_kept", F.octet_length("kept").cast("long")) \
        .withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(columns_of(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(columns_of(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_of(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    return manifest.merkle_manifest(docs).drop("path")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns_of(spark, sf_dir, "documents", "doc_id", "text")
    return rules.quality_rules(docs, columns_of(spark, sf_dir, "labels", "doc_id", "quality"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(columns_of(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_length_buckets": op4_length_buckets,
    "op5_chat_format": op5_chat_format,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_topk_search": op9_topk_search,
    "op10_mix_sources": op10_mix_sources,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_rules": op12_quality_rules,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE: dict[str, str] = oracles.ORACLE
