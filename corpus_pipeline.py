"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), where docs are the rows that the stage before it
kept, and calls one operator. The first four return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barforge.llm.decontamination import without_leaks
from barforge.llm.line_dedup import without_repeated_lines
from barforge.llm.near_dedup import without_near_duplicates
from barforge.llm.packing import pack
from barforge.llm.quality_rules import keep_good
from barforge.llm.shared import bounded_batches, discard, stash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict reject."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier one; documents of nothing else go."""
    return without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies at a similarity of 0.8 or more."""
    return without_near_duplicates(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its sequence and place there."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def bounded(stage: Stage) -> Stage:
    """``stage`` in a session whose Arrow batches are small enough for whole documents."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", bounded(quality)),
    ("line_dedup", bounded(lines)),
    ("near_dedup", bounded(near_copies)),
    ("decontamination", bounded(benchmark_free)),
    ("packing", bounded(packed)),
]

#: No SQL: it has neither the tokenizer nor the packer. The tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, before = stash(stage(spark, docs, sf_dir), name), docs
        discard(before)  # its only reader is stored
    return docs
