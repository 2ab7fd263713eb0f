"""Thin commands over the library: ``python -m barforge.cli COMMAND --help``.

Commands that fetch take functions as ``module:function``: ``--transport`` for pages, ``--archives``
for daily archives, ``--connect`` for streams (see sources.transport). None is built in.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.timeframes import interval_ms, source_interval, timeframe_ms
from barforge.operators import backtest, features, signals, strength
from barforge.sources import ingest, lake, presets
from barforge.sources.sync import Fetching, Tables, read_state, sync_missing, sync_recent


def session() -> SparkSession:
    return (
        SparkSession.builder.appName("barforge")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def _hot(spark: SparkSession, path: str | None, interval: str) -> DataFrame | None:
    """Streamed candles that wait for their way into the lake (see streaming.buffered)."""
    from barforge.streaming.pipelines import hot_rows

    return hot_rows(spark, path).filter(F.col("interval") == interval) if path and lake.exists(spark, path) else None


def _source(spark: SparkSession, a: argparse.Namespace, interval: str) -> DataFrame:
    rows = lake.overlay(lake.scan(spark, a.silver, interval, a.symbol), _hot(spark, a.hot, interval))
    return rows.filter(F.col("symbol").isin(a.symbol)) if a.symbol else rows


def refresh_symbols(spark, a):
    universe = ingest.contracts(spark, a.exchange_info)
    ingest.append_snapshot(universe, a.history, a.current, datetime.now(tz=UTC))
    ingest.active(universe).show(20)


def _tables(a: argparse.Namespace) -> Tables:
    return Tables(a.raw, a.silver, a.quarantine, a.gaps, a.state, a.spans)


def _fetching(a: argparse.Namespace) -> Fetching:
    return Fetching(a.transport, a.archives, a.archive_cache, a.limit, a.concurrency, a.max_weight_per_minute, a.archive_threshold_days, a.archive_concurrency)


def _universe(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    universe = spark.read.schema("symbol string").json(a.current)
    return universe.filter(F.col("symbol").isin(a.symbol)) if a.symbol else universe


def sync(spark, a):
    """Fetch what each symbol lacks and clean it; ``--dry-run`` shows the plan alone."""
    universe = _universe(spark, a)
    if a.dry_run:
        state = read_state(spark, a.state, a.legacy_state, a.interval)
        plan = ingest.sync_plan(universe, state, a.interval, a.bootstrap_days, a.limit, datetime.now(tz=UTC), a.archives is not None, a.archive_threshold_days)
        plan.agg(F.count("*").alias("symbols"), F.sum(F.col("archive_days") + F.col("rest_batches")).alias("batches")).show()
    elif a.recent:
        sync_recent(spark, universe, a.interval, _tables(a), _fetching(a), progress=print)
    else:
        sync_missing(spark, universe, a.interval, _tables(a), _fetching(a), a.bootstrap_days, whole_universe=not a.symbol, legacy=a.legacy_state, progress=print)


def normalize(spark, a):
    day = lambda x: date.fromisoformat(x) if x else None
    print(lake.renormalize(spark, a.raw, a.silver, a.quarantine, a.gaps, a.interval, interval_ms(a.interval), a.symbol, day(a.start_date), day(a.end_date), a.overwrite, print))


def build_features(spark, a):
    rows = _source(spark, a, a.base_interval)
    if rows.isEmpty():
        print("no candles")
        return
    lake.write_features(features.feature_frame(rows, a.base_interval, a.feature_interval), a.features, a.feature_interval)


def _features(spark, a) -> DataFrame:
    return spark.read.parquet(a.features).filter(F.col("interval") == a.feature_interval)


def build_signals(spark, a):
    print(lake.write_table(signals.top_n(_features(spark, a), a.top_n), a.signals))


def backtest_signals(spark, a):
    print(lake.write_table(backtest.equity_curve(spark.read.parquet(a.signals), _features(spark, a), a.fee_rate, a.slippage_rate), a.equity))


def show_signals(spark, a):
    rows = spark.read.parquet(a.signals)
    signals.in_order(strength.latest(rows, "feature_available_time_ms") if not a.all else rows).show(a.limit, truncate=False)


def backtest_report(spark, a):
    backtest.summary(spark.read.parquet(a.equity), a.periods_per_year).show(truncate=False)


def _board(spark, a, p: presets.Preset | None, tf: str) -> None:
    interval = source_interval(tf)
    rows = _source(spark, a, interval)
    tail, warmup = (p.tail_bars, p.warmup_bars) if p else (a.tail_bars, a.warmup_bars)
    if tail:
        rows = strength.source_tail(rows, tf, interval, tail, warmup)
    top, lookback = (p.liquidity_top_n, p.liquidity_lookback_bars) if p else (a.liquidity_top_n, a.liquidity_lookback_bars)
    gap, most = (p.max_abs_gap_atr, p.max_ret) if p else (a.max_abs_gap_atr, a.max_ret)
    at = lake.scratch(spark)
    strength.resample(rows, timeframe_ms(tf), takers=False, counted="bar_count").write.parquet(at)
    print(tf, lake.write_table(strength.board(spark.read.parquet(at), tf, a.benchmark, gap, most, interval, tail, top, lookback), f"{a.boards}/tf={tf}"))
    lake.remove(spark, at)


def build_strength(spark, a):
    _board(spark, a, presets.timeframe(a.tf, a.config) if a.use_preset else None, a.tf)


def build_presets(spark, a):
    for p in presets.group(a.preset, a.config):
        if a.dry_run:
            print(p)
        else:
            _board(spark, a, p, p.tf)


def show_strength(spark, a):
    strength.shown(spark.read.parquet(f"{a.boards}/tf={a.tf}"), a.side, a.top_n, a.rank_pct, a.include_overheated, not a.all, a.limit).show(truncate=False)


def stream(spark, a):
    """Store a stream of candles; what may lack is filled beside it, at the start and after each disconnection."""
    from barforge.streaming.live import Live
    from barforge.streaming.pipelines import Marks, buffered, candle_sink, flush
    from barforge.streaming.receivers import Receiving

    universe = _universe(spark, a)
    marks = Marks(a.state, interval_ms(a.interval), a.state_interval_seconds) if a.state else None
    sink = candle_sink(a.silver, interval_ms(a.interval), a.raw, a.quarantine, a.gaps, a.open_candles, marks)
    to = buffered(sink, a.hot, a.flush_size) if a.hot else sink
    symbols = [r.symbol for r in universe.orderBy("symbol").collect()]
    how = Receiving(a.connect, symbols, a.interval, a.streams_per_connection, a.hot_flush_size, a.hot_flush_interval_seconds, reconnect=a.reconnect_delay_seconds, once=a.once)

    def fill(own: list[str]) -> None:
        sync_missing(spark, universe.filter(F.col("symbol").isin(own)), a.interval, _tables(a), _fetching(a), a.bootstrap_days, progress=lambda c: print({"kind": "fill_progress"} | c))

    live = Live(spark, how, to, a.spool, a.checkpoint, fill if a.transport else None, not a.no_startup_gap_fill, progress=print)
    try:
        live.wait()
    finally:
        live.stop()
        if a.hot:
            flush(spark, sink, a.hot)
        if marks:
            marks.save(spark)


ROOT = "data"
#: Options by name: default, and how the argument is read.
OPTIONS: dict[str, dict] = {
    "silver": {"default": f"{ROOT}/silver"}, "raw": {"default": f"{ROOT}/raw"}, "quarantine": {"default": f"{ROOT}/quarantine"}, "gaps": {"default": f"{ROOT}/gaps"},
    "features": {"default": f"{ROOT}/features"}, "signals": {"default": f"{ROOT}/signals"}, "equity": {"default": f"{ROOT}/equity"}, "boards": {"default": f"{ROOT}/boards"},
    "state": {"default": f"{ROOT}/state"}, "history": {"default": f"{ROOT}/symbols/history"}, "current": {"default": f"{ROOT}/symbols/current"}, "checkpoint": {"default": f"{ROOT}/checkpoint"},
    "open-candles": {"default": None}, "hot": {"default": None}, "config": {"default": None}, "exchange-info": {"required": True}, "transport": {"default": None}, "archives": {"default": None},
    "archive-cache": {"default": None}, "legacy-state": {"default": None}, "concurrency": {"type": int, "default": 8}, "max-weight-per-minute": {"type": int, "default": 900}, "recent": {"action": "store_true"},
    "spans": {"default": f"{ROOT}/spans"}, "spool": {"default": f"{ROOT}/spool"}, "archive-concurrency": {"type": int, "default": 4}, "state-interval-seconds": {"type": float, "default": 30.0},
    "connect": {"default": None}, "streams-per-connection": {"type": int, "default": 200}, "flush-size": {"type": int, "default": 1000}, "hot-flush-size": {"type": int, "default": 100},
    "hot-flush-interval-seconds": {"type": float, "default": 0.5}, "reconnect-delay-seconds": {"type": float, "default": 5.0}, "once": {"action": "store_true"}, "no-startup-gap-fill": {"action": "store_true"},
    "symbol": {"action": "append"}, "interval": {"default": "1m"}, "base-interval": {"default": "1m"}, "feature-interval": {"default": "1h"}, "start-date": {"default": None}, "end-date": {"default": None},
    "overwrite": {"action": "store_true"}, "dry-run": {"action": "store_true"}, "all": {"action": "store_true"}, "use-preset": {"action": "store_true"}, "include-overheated": {"action": "store_true"},
    "bootstrap-days": {"type": int, "default": 30}, "limit": {"type": int, "default": 499}, "archive-threshold-days": {"type": int, "default": 2}, "top-n": {"type": int, "default": 10},
    "fee-rate": {"type": float, "default": 0.0}, "slippage-rate": {"type": float, "default": 0.0}, "periods-per-year": {"type": int, "default": 8760}, "tf": {"default": "15"}, "benchmark": {"default": "BTCUSDT"},
    "max-abs-gap-atr": {"type": float, "default": 2.5}, "max-ret": {"type": float, "default": None}, "tail-bars": {"type": int, "default": None}, "warmup-bars": {"type": int, "default": 50},
    "liquidity-top-n": {"type": int, "default": None}, "liquidity-lookback-bars": {"type": int, "default": 20}, "preset": {"default": "intraday"}, "side": {"default": "strong"}, "rank-pct": {"type": float, "default": 0.2},
}
BOARD = "silver hot symbol boards benchmark config"
FETCH = "current raw silver quarantine gaps state spans interval symbol bootstrap-days limit archives archive-cache archive-threshold-days transport concurrency archive-concurrency max-weight-per-minute"
SYNC = f"{FETCH} legacy-state recent dry-run"
COMMANDS: dict[str, tuple[Callable, str]] = {
    "refresh-symbols": (refresh_symbols, "exchange-info history current"),
    "sync-klines": (sync, SYNC),
    "sync-all": (sync, SYNC),
    "normalize-klines": (normalize, "raw silver quarantine gaps interval symbol start-date end-date overwrite"),
    "build-features": (build_features, "silver hot symbol features base-interval feature-interval"),
    "build-signals": (build_signals, "features feature-interval signals top-n"),
    "backtest-signals": (backtest_signals, "features feature-interval signals equity fee-rate slippage-rate"),
    "show-signals": (show_signals, "signals limit all"),
    "backtest-report": (backtest_report, "equity periods-per-year"),
    "build-relative-strength": (build_strength, f"{BOARD} tf use-preset max-abs-gap-atr max-ret tail-bars warmup-bars liquidity-top-n liquidity-lookback-bars"),
    "build-relative-strength-presets": (build_presets, f"{BOARD} preset dry-run"),
    "show-relative-strength": (show_strength, "boards tf side top-n rank-pct include-overheated all limit"),
    "stream-klines": (stream, f"{FETCH} open-candles hot connect spool state-interval-seconds checkpoint streams-per-connection flush-size hot-flush-size hot-flush-interval-seconds reconnect-delay-seconds once no-startup-gap-fill"),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="barforge")
    commands = out.add_subparsers(dest="command", required=True)
    for name, (run, options) in COMMANDS.items():
        one = commands.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for option in options.split():
            one.add_argument(f"--{option}", **OPTIONS[option])
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    COMMANDS[a.command][0](spark or session(), a)


if __name__ == "__main__":
    main()
