"""Schemas of stored tables."""

from __future__ import annotations

CANDLE = (
    "symbol string, interval string, open_time timestamp, open_time_ms long, open double, high double, low double, close double, "
    "volume double, close_time_ms long, quote_volume double, trade_count long, taker_buy_base_volume double, "
    "taker_buy_quote_volume double, date string"
)
#: Logical primary key of a candle.
KEY = ["symbol", "interval", "open_time_ms"]
VALUES = ["open", "high", "low", "close", "volume", "close_time_ms", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume"]
GAP = "symbol string, interval string, missing_open_time_ms long, previous_open_time_ms long, next_open_time_ms long, detected_at timestamp, status string, reason string"
GAP_KEY = ["symbol", "interval", "missing_open_time_ms"]
CONTRACT = "symbol string, baseAsset string, quoteAsset string, contractType string, status string, onboardDate long, deliveryDate long"
STATE = "symbol string, interval string, last_open_time_ms long, status string"
