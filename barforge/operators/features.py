"""Time-series and cross-section features of bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import average_rank, ratio, rows_back
from barforge.functions.timeframes import interval_ms
from barforge.operators.bars import resample

#: Returns over so many bars back.
LAGS = {"ret_1h": 1, "ret_4h": 4, "ret_24h": 24, "ret_7d": 168}
ROLL = 24


def time_series(bars: DataFrame, width_ms: int, expected_rows: int) -> DataFrame:
    """Lagged returns and rolling sums by rows of each symbol: one shuffle, one sort."""
    w = Window.partitionBy("symbol").orderBy("ts_ms")
    day = rows_back(w, ROLL - 1)
    close = F.col("close")
    out = bars.withColumns(
        {"feature_available_time_ms": F.col("ts_ms") + width_ms}
        | {name: F.round(ratio(close, F.lag("close", k).over(w)) - 1, 12) for name, k in LAGS.items()}
        | {"bar_return": ratio(close, F.lag("close", 1).over(w)) - 1, "high_low_range": ratio(F.col("high"), F.col("low")) - 1}
    )
    out = out.withColumns(
        {
            "quote_volume_24h": F.sum("quote_volume").over(day),
            "volatility_24h": F.stddev_samp("bar_return").over(day),
            "high_low_range_24h": F.sum("high_low_range").over(day),
            "atr_24h": F.sum(F.col("high") - F.col("low")).over(day),
        }
    )
    full = (F.col("minute_count") == expected_rows) & F.col("quote_volume_24h").isNotNull()
    return out.withColumn("is_tradable", full).drop("bar_return")


def cross_section(frame: DataFrame) -> DataFrame:
    """Ranks and score at each time. Ranks count all symbols, tradable or not."""
    tradable = F.col("is_tradable")
    ranks = {"momentum_rank": ("ret_24h", True), "liquidity_rank": ("quote_volume_24h", True), "low_vol_rank": ("volatility_24h", False)}
    out = frame.withColumns({name: F.when(tradable, average_rank(F.col(c), "ts_ms", down)) for name, (c, down) in ranks.items()})
    term = lambda weight, c: F.coalesce(F.lit(weight) / F.col(c), F.lit(0.0))
    score = F.lit(1.0) / F.col("liquidity_rank") + term(0.5, "momentum_rank") + term(0.2, "low_vol_rank")
    return out.withColumns({"score": F.when(tradable & F.col("liquidity_rank").isNotNull(), score), "feature_available_time": F.timestamp_millis("feature_available_time_ms")})


def feature_frame(candles: DataFrame, base_interval: str = "1m", feature_interval: str = "1h") -> DataFrame:
    """Bars of ``feature_interval`` with all features; raises if it is no multiple of the base."""
    base, width = interval_ms(base_interval), interval_ms(feature_interval)
    if width < base or width % base:
        raise ValueError("feature_interval must be a positive multiple of base_interval")
    return cross_section(time_series(resample(candles, width), width, width // base))


def in_order(features: DataFrame) -> DataFrame:
    return features.orderBy("ts_ms", F.col("score").desc_nulls_last(), "symbol")
