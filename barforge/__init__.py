"""Candle analytics on Spark: cleaning, resampling, features, signals, backtests and boards."""
