"""OHLCV resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.exprs import bucket


def resample(candles: DataFrame, width_ms: int, takers: bool = True, counted: str = "minute_count") -> DataFrame:
    """Bars of ``width_ms`` for each symbol, map-side combined, in one shuffle.

    First open and last close are taken by open time, so row order does not matter. Without
    ``takers`` the trade and taker columns are left out. Incomplete bars stay; ``counted``
    names the column that says how many candles a bar has.
    """
    at = F.col("open_time_ms")
    sums = ["volume", "quote_volume"] + ["trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"] * takers
    return (
        candles.groupBy("symbol", bucket(at, width_ms).alias("ts_ms"))
        .agg(
            F.min_by("open", at).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at).alias("close"),
            *(F.sum(c).alias(c) for c in sums), F.count("*").alias(counted),
        )
        .withColumn("ts", F.timestamp_millis("ts_ms"))
    )
