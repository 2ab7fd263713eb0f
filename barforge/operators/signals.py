"""Top-N equal-weight signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import average_rank


def top_n(features: DataFrame, n: int = 10) -> DataFrame:
    """The symbols whose truncated average rank by score is at most ``n``, each at weight 1 / n.

    Ties can pass together, so a time may have more than n rows; with fewer candidates the
    weights still are 1 / n. Rows that outrank n others cannot pass, and are cut by a plain
    rank first, which Spark limits while it sorts.
    """
    if n < 1:
        raise ValueError("n must be positive")
    at = "feature_available_time_ms"
    rows = features.filter("is_tradable and score is not null").select(at, "symbol", "score")
    rows = rows.withColumn("_least", F.rank().over(Window.partitionBy(at).orderBy(F.desc("score")))).filter(F.col("_least") <= n)
    rank = average_rank(F.col("score"), at, descending=True).cast("long")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n).withColumn("target_weight", F.lit(1.0 / n)).select(at, "symbol", "score", "rank", "target_weight")


def in_order(signals: DataFrame) -> DataFrame:
    return signals.orderBy("feature_available_time_ms", "rank", "symbol")
