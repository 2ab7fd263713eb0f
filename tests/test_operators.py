"""Operators on literal candles."""

import math
import random

import pytest
from pyspark.sql import functions as F

from barforge.operators import backtest, bars, features, quality, signals, strength

START = 1_719_792_000_000
MINUTE = 60_000


def candle(symbol, minute, close, o=None, h=None, lo=None, quote=None, interval="1m", step=MINUTE, seq=0):
    at = START + minute * step
    return {
        "symbol": symbol, "interval": interval, "open_time_ms": at, "open": o if o is not None else close - 0.5, "high": h if h is not None else close + 1.0, "low": lo if lo is not None else close - 1.0,
        "close": float(close), "volume": 10.0, "close_time_ms": at + step - 1, "quote_volume": float(quote if quote is not None else close * 10), "trade_count": 5,
        "taker_buy_base_volume": 4.0, "taker_buy_quote_volume": close * 4.0, "seq": seq,
    }


SCHEMA = "symbol string, interval string, open_time_ms long, open double, high double, low double, close double, volume double, close_time_ms long, quote_volume double, trade_count long, taker_buy_base_volume double, taker_buy_quote_volume double, seq long"


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)


def series(symbol, closes, **kw):
    return [candle(symbol, i, c, **kw) for i, c in enumerate(closes)]


def test_first_broken_rule_wins(spark):
    good = candle("A", 0, 100.0)
    rows = [
        good,
        good | {"close_time_ms": good["close_time_ms"] + 1, "volume": -1.0},
        good | {"open_time_ms": START + 1, "close_time_ms": START + MINUTE, "high": 0.0},
        good | {"high": 99.0},
        good | {"close": float("nan")},
        good | {"quote_volume": -1.0, "trade_count": -1},
        good | {"trade_count": -1},
        good | {"taker_buy_quote_volume": -0.1},
    ]
    got = frame(spark, [r | {"seq": i} for i, r in enumerate(rows)]).withColumn("r", quality.reject_reason(MINUTE)).orderBy("seq").collect()
    assert [x.r for x in got] == [None, "invalid_close_time", "misaligned_open_time", "invalid_ohlc", "invalid_ohlc", "negative_volume", "negative_trade_count", "negative_taker_buy_volume"]


def test_first_of_a_key_stands_and_a_different_one_conflicts(spark):
    rows = [candle("A", 0, 100.5, seq=0), candle("A", 0, 100.5, seq=1), candle("A", 0, 101.5, seq=2), candle("A", 2, 100.0, seq=3), candle("A", 3, 100.0, h=1.0, seq=4)]
    got = quality.clean(frame(spark, rows), MINUTE)
    assert [(r.open_time_ms - START, r.close) for r in got.accepted.orderBy("open_time_ms").collect()] == [(0, 100.5), (2 * MINUTE, 100.0)]
    assert [(r.close, r.reason) for r in got.conflicts.collect()] == [(101.5, "duplicate_conflict")]
    assert [r.reason for r in got.rejected.collect()] == ["invalid_ohlc"]
    assert [(r.missing_open_time_ms - START, r.next_open_time_ms - START) for r in got.gaps.collect()] == [(MINUTE, 2 * MINUTE)]
    assert got.counters().first().asDict() == {"raw": 5, "accepted": 2, "rejected": 1, "conflicts": 1}


def test_contiguous_mark(spark):
    rows = frame(spark, [candle("A", m, 100.0) for m in (0, 1, 3, 4, 6, 7)] + [candle("B", m, 9.0) for m in range(9)])
    mark = lambda **kw: (quality.contiguous_mark(rows, MINUTE, **kw).first()[0] - START) // MINUTE
    assert (mark(), mark(strict=True)) == (4, 1)
    assert quality.contiguous_mark(rows.limit(0), MINUTE).first()[0] is None


def test_two_hours_of_two_symbols(spark):
    rows = series("BTCUSDT", [100] * 59 + [120] + [120] * 59 + [132]) + series("ETHUSDT", [100] * 59 + [110] + [110] * 59 + [121])
    got = {(r.symbol, r.ts_ms): r for r in features.feature_frame(frame(spark, rows)).collect()}
    later = START + 60 * MINUTE
    assert got["BTCUSDT", later].ret_1h == pytest.approx(0.1)
    assert got["ETHUSDT", later].ret_1h == pytest.approx(0.1)
    assert [got[s, later].liquidity_rank for s in ("BTCUSDT", "ETHUSDT")] == [1.0, 2.0]
    assert got["BTCUSDT", START].feature_available_time_ms == later
    with pytest.raises(ValueError):
        features.feature_frame(frame(spark, rows), "1h", "90m")


def test_an_incomplete_hour_is_not_tradable(spark):
    row = features.feature_frame(frame(spark, series("A", [100] * 59))).first()
    assert (row.minute_count, row.is_tradable, row.score) == (59, False, None)


def test_the_past_does_not_know_the_future(spark):
    rng = random.Random(7)
    closes = [100 + rng.random() * 10 for _ in range(180)]
    cut = START + 120 * MINUTE
    before = [features.feature_frame(frame(spark, series("A", c) + series("B", closes[::-1][:120] + c[120:]))).filter(F.col("ts_ms") < cut).orderBy("ts_ms", "symbol").collect() for c in (closes, closes[:120] + [999.0] * 60)]
    assert before[0] == before[1] and len(before[0]) == 4


def test_top_n_keeps_ties_and_weights(spark):
    rows = [(1, 10, s, x, True) for s, x in (("A", 3.0), ("B", 2.0), ("C", 2.0), ("D", 1.0))] + [(1, 20, "A", 1.0, True), (1, 20, "B", 9.0, False), (1, 20, "C", None, True)]
    got = signals.top_n(spark.createDataFrame(rows, "ts_ms long, feature_available_time_ms long, symbol string, score double, is_tradable boolean"), 2)
    assert [(r.feature_available_time_ms, r.symbol, r["rank"], r.target_weight) for r in signals.in_order(got).collect()] == [(10, "A", 1, 0.5), (10, "B", 2, 0.5), (10, "C", 2, 0.5), (20, "A", 1, 0.5)]
    with pytest.raises(ValueError):
        signals.top_n(got, 0)


def _curve(spark, weights, prices, **kw):
    s = spark.createDataFrame(weights, "feature_available_time_ms long, symbol string, target_weight double")
    p = spark.createDataFrame(prices, "ts_ms long, symbol string, close double")
    return backtest.equity_curve(s, p, **kw).orderBy("time_ms").collect()


def test_equity_and_costs(spark):
    prices = [(1000, "A", 10.0), (2000, "A", 10.0), (3000, "A", 11.0), (4000, "A", 11.0), (1000, "B", 5.0), (2000, "B", 5.0), (3000, "B", 5.0), (4000, "B", 5.0)]
    got = _curve(spark, [(2000, "A", 1.0), (3000, "B", 1.0)], prices, fee_rate=0.001, slippage_rate=0.001)
    assert [(r.time_ms, r.gross_return, r.turnover, r.cost) for r in got] == [(2000, 0.0, 0.0, 0.0), (3000, 0.1, 1.0, 0.002), (4000, 0.0, 2.0, 0.004)]
    assert [r.equity for r in got] == pytest.approx([1.0, 1.098, 1.098 * 0.996])


def test_summary_figures(spark):
    rows = [(i, r, t, e) for i, (r, t, e) in enumerate(zip([0, 0.1, -0.2, 0.25], [0, 1, 2, 0.5], [1, 1.1, 0.88, 1.1], strict=True))]
    frame_ = spark.createDataFrame([(i, float(r), float(t), float(e)) for i, r, t, e in rows], "time_ms long, period_return double, turnover double, equity double")
    got = backtest.summary(frame_).first()
    assert (got.periods, got.win_rate, got.avg_turnover) == (4, pytest.approx(2 / 3), 0.875)
    assert got.max_drawdown == pytest.approx(-0.2) and got.total_return == pytest.approx(0.1)
    empty = backtest.summary(frame_.limit(0)).first()
    assert empty.asDict() == dict.fromkeys(empty.asDict()) | {"periods": 0}


def test_strong_weak_and_overheated(spark):
    rows = [candle(s, i, c, o=c - 1.0) for s, closes in (("BTCUSDT", (100, 102, 104)), ("ETHUSDT", (100, 103, 108)), ("SOLUSDT", (100, 101, 102)), ("DOGEUSDT", (100, 120, 160))) for i, c in enumerate(closes)]
    got = {r.symbol: r for r in strength.latest(strength.strength_frame(frame(spark, rows), "1", max_abs_gap_atr=100.0, max_ret=0.25)).collect()}
    assert got["ETHUSDT"].strong_rank == 1 and got["SOLUSDT"].weak_rank == 1
    assert got["DOGEUSDT"].is_overheated and got["DOGEUSDT"].strong_rank is None
    tail = strength.strength_frame(frame(spark, rows), "1", tail_bars=2).select("ts_ms").distinct().collect()
    assert sorted(r.ts_ms for r in tail) == [START + MINUTE, START + 2 * MINUTE]


def test_the_liquid_universe(spark):
    rows = [candle(s, i, 100.0, quote=q) for s, q in (("BTCUSDT", 1), ("HIGHUSDT", 1e6), ("LOWUSDT", 1)) for i in range(3)]
    kept = strength.liquid_universe(bars.resample(frame(spark, rows), MINUTE), "BTCUSDT", 1, 2).select("symbol").distinct().collect()
    assert sorted(r.symbol for r in kept) == ["BTCUSDT", "HIGHUSDT"]
    with pytest.raises(ValueError):
        strength.liquid_universe(frame(spark, rows), "BTCUSDT", 0)


def test_ema_is_the_recurrence(spark):
    rng = random.Random(3)
    closes = [100 + rng.random() * 50 for _ in range(700)]
    got = strength.symbol_factors(bars.resample(frame(spark, series("A", closes)), MINUTE)).orderBy("ts_ms").collect()
    e = closes[0]
    for r, c in zip(got, closes, strict=True):
        e = e + (c - e) * 2 / 21 if r.ts_ms > START else c
        assert math.isclose(r.ema20, e, rel_tol=1e-13)


def test_share_of_the_board(spark):
    rows = [(1, f"S{i:03}", 0.1, 0.1, i + 1 if i < 10 else None, None, False) for i in range(100)] + [(1, "HOT", 1.0, 1.0, 1, None, True), (0, "OLD", 1.0, 1.0, 1, None, False)]
    board = spark.createDataFrame(rows, "ts_ms long, symbol string, rs_ret double, rs_gap double, strong_rank long, weak_rank long, is_overheated boolean")
    assert [r.symbol for r in strength.shown(board, rank_pct=0.2).collect()] == [f"S{i:03}" for i in range(10)]
    assert len(strength.shown(board, rank_pct=0.05).collect()) == 5
    assert strength.shown(board, "weak").collect() == []


def test_orders_of_features_and_boards(spark):
    rows = [(1, "B", 0.5), (1, "A", 0.5), (1, "C", None), (0, "Z", 0.1), (1, "D", 0.9)]
    got = features.in_order(spark.createDataFrame(rows, "ts_ms long, symbol string, score double")).collect()
    assert [r.symbol for r in got] == ["Z", "D", "A", "B", "C"]
    rows = [(1, "A", None, 1), (1, "B", 2, 2), (1, "C", 1, 3), (0, "D", 9, 9), (1, "E", 2, 1), (1, "F", None, None)]
    got = strength.in_order(spark.createDataFrame(rows, "ts_ms long, symbol string, strong_rank long, weak_rank long")).collect()
    assert [r.symbol for r in got] == ["D", "C", "E", "B", "A", "F"]


def test_turnover_is_that_of_the_grid(spark):
    rng = random.Random(12)
    rows = [(t, s, rng.choice([0.25, 0.5, 1.0])) for t in range(0, 50, 5) for s in "ABCDE" if rng.random() < 0.5 and t != 20]
    held = spark.createDataFrame(rows, f"{backtest.AT} long, symbol string, target_weight double")
    returns = held.select(backtest.AT).distinct().withColumns({"return_time_ms": F.col(backtest.AT) + 5, "next_return": F.lit(0.0)})
    grid = backtest.dense_weights(held).groupBy(backtest.AT).agg(F.sum(F.abs(F.col("target_weight") - F.col("previous_weight"))).alias("x")).collect()
    got = {r.time_ms: r.turnover for r in backtest.turnover(held, returns).collect()}
    assert got.keys() == {r[0] + 5 for r in grid} and all(abs(got[r[0] + 5] - r.x) < 1e-9 for r in grid)
