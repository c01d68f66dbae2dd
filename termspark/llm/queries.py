"""One registered query per operator: the operator with production parameters over its
whole table, and the columns that describe its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, chat, exact_dedup, hard_negatives, langid, mixing, ngram_join, ordinal_quality, packing, quality_rules,
               sharding, token_counts, url_filter)
from .common import documents


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.dedup(documents(spark, sf_dir))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.maximal(turns).select("conv_id", "n_turns", "snapshots", "text")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.plan(documents(spark, sf_dir))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal_quality.rate(documents(spark, sf_dir), labels)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(documents(spark, sf_dir), [1.0] * 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", noisy), F.col("vec_id") % 50 == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", sha.alias("groups_sha256"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return (token_counts.count(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_exact_dedup, op3_chat_format, op4_packing, op5_url_filter, op6_mixing, op7_language_id,
    op8_quality_classifier, op9_quality_rules, op10_sharding, op11_hard_negatives, op12_token_alignment, op13_token_counts)}
