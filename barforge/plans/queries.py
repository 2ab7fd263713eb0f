"""Queries over the driver's tables, one for each group of operators.

Figures are rounded to 8 digits at the very end, as their SQL does.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.operators import backtest, bars, features, quality, signals, spans, strength
from barforge.plans.markets import DAY, HOUR, WEEK, events_market, lineitem_market
from barforge.sources import ingest, lake

BENCHMARK, TF, GAP = "S0", "10080", 0.35
NOW = datetime(2024, 2, 1, 12, 34, 56, tzinfo=UTC)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    names = columns or tuple(df.columns)
    return df.select(*(F.round(c, 8).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else F.col(c) for c in names))


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once and read by all that follows, as the commands do between each other."""
    path = lake.scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hours(spark, sf_dir):
    return events_market(spark, sf_dir)


def days(spark, sf_dir):
    return lineitem_market(spark, sf_dir)


def table(spark, sf_dir):
    return features.feature_frame(hours(spark, sf_dir), "1h", "4h")


def picks(spark, sf_dir):
    return signals.top_n(table(spark, sf_dir), 2)


def curve(spark, sf_dir):
    """Equity on damped prices: the events' values are noise, on which equity would run off."""
    own = kept(table(spark, sf_dir))
    calm = own.withColumn("close", 100 + F.col("close") / 100)
    return backtest.equity_curve(kept(signals.top_n(own, 2)), calm, 0.0004, 0.0002)


def day_picks(spark, sf_dir):
    """The flagship: top signals of daily bars, which even the smallest tables have enough of."""
    return rounded(signals.top_n(features.feature_frame(days(spark, sf_dir), "1d", "1d"), 3))


def weeks(spark, sf_dir):
    return bars.resample(days(spark, sf_dir), WEEK, takers=False, counted="bar_count")


def factors(spark, sf_dir):
    return strength.symbol_factors(weeks(spark, sf_dir))


def flagged(spark, sf_dir):
    return strength.relative(strength.against_benchmark(factors(spark, sf_dir), BENCHMARK), GAP, 1.0)


def board(spark, sf_dir):
    return strength.strength_frame(days(spark, sf_dir), TF, BENCHMARK, GAP, 1.0, "1d")


def corrupted(spark, sf_dir):
    """Hourly candles, some broken in each way that validation knows."""
    k = F.expr(f"(open_time_ms div {HOUR} + length(symbol)) % 13")
    put = lambda n, c, v: F.when(k == n, v).otherwise(F.col(c))
    h = hours(spark, sf_dir)
    return h.withColumns(
        {
            "close_time_ms": F.when(k == 0, F.col("close_time_ms") + 1).when(k == 1, F.col("close_time_ms") + 1000).otherwise(F.col("close_time_ms")),
            "open_time_ms": put(1, "open_time_ms", F.col("open_time_ms") + 1000),
            "high": put(2, "high", F.col("low") - 1),
            "volume": put(3, "volume", F.lit(-1.0)),
            "trade_count": put(4, "trade_count", F.lit(-1).cast("long")),
            "taker_buy_quote_volume": put(5, "taker_buy_quote_volume", F.lit(-1.0)),
            "open": put(6, "open", F.lit(None)),
            "quote_volume": put(7, "quote_volume", F.lit(None)),
        }
    )


def repeated(spark, sf_dir):
    """Corrupted candles, then again every fifth hour's as it was and every seventh's changed."""
    h = corrupted(spark, sf_dir)
    n = F.expr(f"open_time_ms div {HOUR}")
    again = h.filter(n % 5 == 0).withColumn("seq", F.lit(2))
    changed = h.filter(n % 7 == 0).withColumns({"close": F.col("close") + 1, "high": F.greatest("high", F.col("close") + 1), "seq": F.lit(3)})
    return h.withColumn("seq", F.lit(1)).unionByName(again).unionByName(changed)


def cleaned(spark, sf_dir):
    return quality.clean(repeated(spark, sf_dir), HOUR)


def hot(spark, sf_dir):
    """Candles of the last days, streamed anew with another close."""
    h = hours(spark, sf_dir)
    return h.filter(F.expr(f"open_time_ms div {HOUR} % 3") == 0).withColumns({"close": F.col("close") + 1, "high": F.greatest("high", F.col("close") + 1)})


CANDLE = ("symbol", "interval", "open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hours(spark, sf_dir), *CANDLE)


def bars_weekly(spark, sf_dir):
    return rounded(bars.resample(days(spark, sf_dir), WEEK).drop("ts"))


def bars_rs(spark, sf_dir):
    return rounded(weeks(spark, sf_dir).drop("ts"))


def validate_reject_reasons(spark, sf_dir):
    return corrupted(spark, sf_dir).select("symbol", "open_time_ms", F.coalesce(quality.reject_reason(HOUR), F.lit("valid")).alias("reason"))


def dedupe_conflicts(spark, sf_dir):
    return cleaned(spark, sf_dir).conflicts.select("symbol", "open_time_ms", "seq", F.round("close", 8).alias("close"), "reason")


def accepted_rows(spark, sf_dir):
    return rounded(cleaned(spark, sf_dir).accepted, *CANDLE, "seq")


def clean_counters(spark, sf_dir):
    return cleaned(spark, sf_dir).counters()


def gap_report(spark, sf_dir):
    return cleaned(spark, sf_dir).gaps


def contiguous_mark(spark, sf_dir):
    return quality.contiguous_mark(cleaned(spark, sf_dir).accepted, HOUR)


def contiguous_mark_strict(spark, sf_dir):
    return quality.contiguous_mark(cleaned(spark, sf_dir).accepted, HOUR, strict=True)


def hot_overlay(spark, sf_dir):
    h = hours(spark, sf_dir)
    return rounded(lake.overlay(h, hot(spark, sf_dir)), *CANDLE)


def upsert_keep_last(spark, sf_dir):
    """Two batches merged into a stored table, which is read back."""
    root = lake.scratch(spark)
    h = ingest.stored(hours(spark, sf_dir))
    lake.upsert(h, root)
    lake.upsert(ingest.stored(hot(spark, sf_dir)), root)
    return rounded(spark.read.schema(h.schema).parquet(root), *CANDLE, "date")


def returns_multi_lag(spark, sf_dir):
    return rounded(table(spark, sf_dir), "symbol", "ts_ms", "ret_1h", "ret_4h", "ret_24h", "ret_7d", "high_low_range")


def rolling_windows(spark, sf_dir):
    return rounded(table(spark, sf_dir), "symbol", "ts_ms", "quote_volume_24h", "volatility_24h", "high_low_range_24h", "atr_24h")


def cross_section_ranks(spark, sf_dir):
    return table(spark, sf_dir).select("symbol", "ts_ms", "is_tradable", "momentum_rank", "liquidity_rank", "low_vol_rank")


def feature_table(spark, sf_dir):
    return rounded(table(spark, sf_dir).drop("ts", "feature_available_time"))


def top_n_signals(spark, sf_dir):
    return rounded(picks(spark, sf_dir))


def latest_signals(spark, sf_dir):
    return rounded(strength.latest(picks(spark, sf_dir), "feature_available_time_ms"))


def next_bar_returns(spark, sf_dir):
    return rounded(backtest.next_returns(table(spark, sf_dir)))


def dense_weights(spark, sf_dir):
    return rounded(backtest.dense_weights(picks(spark, sf_dir)))


def turnover(spark, sf_dir):
    own = kept(table(spark, sf_dir))
    return rounded(backtest.turnover(kept(signals.top_n(own, 2)), backtest.next_returns(own)))


def equity_curve(spark, sf_dir):
    return rounded(curve(spark, sf_dir))


def equity_summary(spark, sf_dir):
    return rounded(backtest.summary(curve(spark, sf_dir), 365 * 6))


def ema20(spark, sf_dir):
    return rounded(factors(spark, sf_dir), "symbol", "ts_ms", "close", "ema20")


def true_range_atr(spark, sf_dir):
    own = factors(spark, sf_dir).withColumn("atr_share", F.col("atr14_lag1") / F.col("close"))
    return rounded(own, "symbol", "ts_ms", "prev_close", "true_range", "atr_share")


def symbol_factors(spark, sf_dir):
    return rounded(factors(spark, sf_dir), "symbol", "ts_ms", "ret", "gap_atr", "slope_atr")


def benchmark_join(spark, sf_dir):
    return rounded(strength.against_benchmark(factors(spark, sf_dir), BENCHMARK), "symbol", "ts_ms", "ret", "btc_ret", "btc_gap_atr", "btc_slope_atr")


def overheat_flag(spark, sf_dir):
    return rounded(flagged(spark, sf_dir), "symbol", "ts_ms", "rs_ret", "rs_gap", "rs_slope", "overheat", "is_overheated")


def strength_scores(spark, sf_dir):
    return rounded(board(spark, sf_dir), "symbol", "ts_ms", "strong_score", "weak_score", "strong_rank", "weak_rank")


def strength_board(spark, sf_dir):
    shown = "symbol", "ts_ms", "tf", "source_interval", "close", "bar_count", "rs_ret", "rs_gap", "rs_slope", "is_overheated", "strong_rank", "weak_rank"
    return rounded(strength.board(kept(weeks(spark, sf_dir)), TF, BENCHMARK, GAP, 1.0, "1d", tail_bars=30, liquidity_top=8), *shown)


def liquidity_universe(spark, sf_dir):
    return rounded(strength.liquid_universe(kept(weeks(spark, sf_dir)), BENCHMARK, 5, 20).drop("ts"))


def source_tail(spark, sf_dir):
    return rounded(strength.source_tail(days(spark, sf_dir), TF, "1d", 10, 5), "symbol", "open_time_ms", "close")


def target_tail(spark, sf_dir):
    return rounded(strength.target_tail(weeks(spark, sf_dir), 12).drop("ts"))


def show_strong(spark, sf_dir):
    return rounded(strength.shown(board(spark, sf_dir), "strong", 10, 0.2, only_latest=False))


def show_weak(spark, sf_dir):
    return rounded(strength.shown(board(spark, sf_dir), "weak", 10, 0.5, only_latest=False))


def active_universe(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.when(F.col("c_custkey") % 3 == 0, "BREAK").otherwise("TRADING").alias("status"),
        F.when(F.col("c_custkey") % 5 == 0, "CURRENT_QUARTER").otherwise("PERPETUAL").alias("contractType"),
        F.when(F.col("c_custkey") % 7 == 0, "BUSD").otherwise("USDT").alias("quoteAsset"),
    )
    return ingest.active(rows)


def messages(spark, sf_dir):
    """Hourly candles as the exchange streams them; every fourth is still open."""
    h = hours(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    k = F.struct(
        F.col("open_time_ms").alias("t"), F.col("close_time_ms").alias("T"), F.col("symbol").alias("s"), F.col("interval").alias("i"), s("open").alias("o"), s("close").alias("c"),
        s("high").alias("h"), s("low").alias("l"), s("volume").alias("v"), F.col("trade_count").alias("n"), (F.expr(f"open_time_ms div {HOUR} % 4") != 3).alias("x"),
        s("quote_volume").alias("q"), s("taker_buy_base_volume").alias("V"), s("taker_buy_quote_volume").alias("Q"),
    )
    kind = F.when(F.expr(f"open_time_ms div {HOUR} % 11") == 0, "trade").otherwise("kline")
    outer = F.when(F.expr(f"open_time_ms div {HOUR} % 2") == 0, "").otherwise(F.col("symbol"))
    return h.select(F.to_json(F.struct(F.lit("x").alias("stream"), F.struct(kind.alias("e"), outer.alias("s"), k.alias("k")).alias("data"))).alias("value"))


def parse_stream_message(spark, sf_dir):
    return rounded(ingest.parse_messages(messages(spark, sf_dir)), *CANDLE, "is_closed")


def parse_rest_rows(spark, sf_dir):
    names = [n for n, _ in ingest.POSITIONS]
    payload = F.to_json(F.array(*(F.col(n).cast("string") for n in names), F.lit("0")))
    return rounded(ingest.parse_rows(hours(spark, sf_dir).select("symbol", "interval", payload.alias("payload"))), *CANDLE, "date")


def universe_and_state(spark, sf_dir):
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"))
    mark = F.lit(1_706_000_000_000 // 60_000 * 60_000) + F.col("c_custkey") * 3_600_000 * 7
    state = keys.filter("c_custkey % 4 <> 0").select("symbol", F.when(F.col("c_custkey") % 9 == 0, "5m").otherwise("1m").alias("interval"), F.when(F.col("c_custkey") % 11 != 0, mark).alias("last_open_time_ms"), F.lit("active").alias("status"))
    return keys.select("symbol"), state, keys


def sync_plan(spark, sf_dir):
    universe, state, _ = universe_and_state(spark, sf_dir)
    return ingest.sync_plan(universe, state, "1m", 30, 499, NOW)


def inactive_checkpoints(spark, sf_dir):
    _, state, keys = universe_and_state(spark, sf_dir)
    return ingest.mark_inactive(state, keys.filter("c_custkey % 3 <> 0"), "1m")


def checkpoint_merge(spark, sf_dir):
    _, state, _ = universe_and_state(spark, sf_dir)
    moved = F.col("last_open_time_ms") + F.when(F.length("symbol") % 2 == 0, 60_000).otherwise(-60_000)
    return ingest.merge_state(state, state.filter("interval = '1m'").withColumn("last_open_time_ms", moved))


def checkpoint_advance(spark, sf_dir):
    """How far each series' mark may move, from a due candle that some have and others lack."""
    ok = cleaned(spark, sf_dir).accepted
    due = ok.groupBy("symbol", "interval").agg((F.min("open_time_ms") + HOUR * (F.length("symbol") % 3) + F.length("symbol") % 2).alias("start_ms")).filter("symbol > 'C'")
    return quality.contiguous_from(ok, due, HOUR)


def wide_spans(spark, sf_dir):
    """Spans of one to three hours from each accepted candle on: many overlap or touch."""
    ok = cleaned(spark, sf_dir).accepted
    return ok.select("symbol", "interval", F.col("open_time_ms").alias("start_ms"), (F.col("open_time_ms") + HOUR * F.expr(f"open_time_ms div {HOUR} % 3")).alias("end_ms"))


def asked_spans(spark, sf_dir):
    """Four days of each week of each series."""
    h = hours(spark, sf_dir).select("symbol", "interval", F.expr(f"open_time_ms div {WEEK} * {WEEK}").alias("start_ms")).distinct()
    return h.withColumn("end_ms", F.col("start_ms") + 4 * DAY - HOUR)


def covered_runs(spark, sf_dir):
    return spans.runs(cleaned(spark, sf_dir).accepted, HOUR)


def covered_spans(spark, sf_dir):
    return spans.merged(wide_spans(spark, sf_dir), HOUR)


def lacking_spans(spark, sf_dir):
    return spans.lacking(wide_spans(spark, sf_dir), asked_spans(spark, sf_dir), HOUR)


def marks_by_spans(spark, sf_dir):
    """How far marks reach from what is due when every other lacking span counts as a hole that stays."""
    holes = lacking_spans(spark, sf_dir).filter(F.expr(f"start_ms div {HOUR} % 2") == 0)
    settled = wide_spans(spark, sf_dir).union(holes.select("symbol", "interval", "start_ms", "end_ms"))
    due = hours(spark, sf_dir).groupBy("symbol", "interval").agg((F.min("open_time_ms") + 5 * DAY).alias("start_ms"))
    return spans.reached(settled, due, HOUR)


def stream_bars_hourly(spark, sf_dir):
    """Bars of a file stream, merged window by window; equal to the batch."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    ticks = rows.select(F.upper("event_type").alias("symbol"), F.expr("timestamp_micros(unix_micros(cast(convert_timezone('UTC', current_timezone(), ts) as timestamp)))").alias("at"), F.col("value").alias("price"), F.lit(1.0).alias("size"), F.col("event_id").alias("tie"))
    from barforge.streaming.pipelines import store_bars, windowed_bars

    out = lake.scratch(spark)
    bars_ = windowed_bars(ticks, "1 hour", "40 days")
    store_bars(bars_, out, lake.scratch(spark)).awaitTermination()
    return rounded(spark.read.schema(bars_.schema).parquet(out), *bars_.columns)


def stream_upsert(spark, sf_dir):
    """Messages from files, each stored twice, through the sink into the lake."""
    from barforge.streaming.pipelines import candle_sink, ingest as start

    inbox, silver = lake.scratch(spark), lake.scratch(spark)
    text = messages(spark, sf_dir)
    text.union(text).repartition(3).write.text(inbox)
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(inbox)
    start(stream, candle_sink(silver, HOUR), lake.scratch(spark), {"availableNow": True}).awaitTermination()
    return rounded(lake.scan(spark, silver), *CANDLE)


def lake_gap_delete(spark, sf_dir):
    """Gaps without those of the first symbols' even days."""
    gaps = cleaned(spark, sf_dir).gaps
    day = F.date_format(F.timestamp_millis("missing_open_time_ms"), "yyyy-MM-dd")
    chosen = gaps.select("symbol", "interval", day.alias("date")).filter("symbol < 'L' and cast(right(date, 1) as int) % 2 = 0").distinct()
    return lake.without_days(gaps, chosen)


QUERIES = {
    f.__name__: f
    for f in (
        bars_hourly, bars_weekly, bars_rs, validate_reject_reasons, dedupe_conflicts, accepted_rows, clean_counters, gap_report, contiguous_mark, contiguous_mark_strict, hot_overlay, upsert_keep_last,
        returns_multi_lag, rolling_windows, cross_section_ranks, feature_table, top_n_signals, latest_signals, next_bar_returns, dense_weights, turnover, equity_curve, equity_summary, ema20,
        true_range_atr, symbol_factors, benchmark_join, overheat_flag, strength_scores, strength_board, liquidity_universe, source_tail, target_tail, show_strong, show_weak, active_universe,
        parse_stream_message, parse_rest_rows, sync_plan, inactive_checkpoints, checkpoint_merge, checkpoint_advance, stream_bars_hourly, stream_upsert, lake_gap_delete,
        covered_runs, covered_spans, lacking_spans, marks_by_spans,
    )
}
