"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .conversation_repair import conversation_repair, damaged
from .decontamination import leaks
from .kd_sharding import kd_shards
from .license_scan import license_scan
from .line_dedup import line_dedup
from .near_dedup import near_duplicates
from .packing import pack
from .quality_rules import quality_rules
from .shared import documents
from .substring_dedup import substring_dedup
from .token_counts import token_counts
from .token_shards import token_shards
from .vector_codes import vector_codes
from .vp_search import nearest


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), 85, 100)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(documents(spark, sf_dir), shards=16)


def op11_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100, k=10)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_decontamination, op3_near_dedup, op4_substring_dedup, op5_packing, op6_license_scan, op7_token_shards, op8_token_counts, op9_line_dedup, op10_kd_sharding, op11_vp_search, op12_conversation_repair, op13_vector_codes)}
