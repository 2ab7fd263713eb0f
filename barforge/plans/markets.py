"""Candles made from the driver's tables, since these hold none themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.exprs import bucket, epoch_ms

HOUR, DAY, WEEK = 3_600_000, 86_400_000, 604_800_000


def _candles(ticks: DataFrame, interval: str, width: int, order: list[str]) -> DataFrame:
    """Candles of (symbol, at_ms, price, size, quote, taker) ticks."""
    first = F.struct(*order)
    return (
        ticks.groupBy("symbol", bucket("at_ms", width).alias("open_time_ms"))
        .agg(
            F.min_by("price", first).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", first).alias("close"),
            F.round(F.sum("size"), 6).alias("volume"), F.round(F.sum("quote"), 6).alias("quote_volume"), F.count("*").alias("trade_count"),
            F.round(F.sum(F.when(F.col("taker"), F.col("size")).otherwise(0.0)), 6).alias("taker_buy_base_volume"),
            F.round(F.sum(F.when(F.col("taker"), F.col("quote")).otherwise(0.0)), 6).alias("taker_buy_quote_volume"),
        )
        .withColumns({"interval": F.lit(interval), "close_time_ms": F.col("open_time_ms") + (width - 1)})
    )


def events_market(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Hourly candles of each event type, priced by value."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet") if events is None else events
    ticks = rows.select(
        F.upper("event_type").alias("symbol"), epoch_ms(rows, "ts").alias("at_ms"), F.col("value").alias("price"), F.lit(1.0).alias("size"),
        F.col("value").alias("quote"), (F.col("user_id") % 2 == 0).alias("taker"), "ts", "event_id",
    )
    return _candles(ticks, "1h", HOUR, ["ts", "event_id"])


def lineitem_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles of twenty groups of suppliers, priced by the unit."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    ticks = rows.select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 20).cast("string")).alias("symbol"), epoch_ms(rows, "l_shipdate").alias("at_ms"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").cast("double").alias("size"),
        F.col("l_extendedprice").alias("quote"), (F.col("l_linenumber") % 2 == 0).alias("taker"), *order,
    )
    return _candles(ticks, "1d", DAY, order)
