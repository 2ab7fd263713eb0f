"""Relative strength against a benchmark instrument."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.exprs import average_rank, ratio, rows_back, with_ema
from barforge.functions.timeframes import day_of, interval_ms, source_interval, timeframe_ms
from barforge.operators.bars import resample

SPAN, ATR, SLOPE = 20, 14, 3
#: A broadcast of a table with a row for each time or kept symbol is asked for up to here.
MOST_BROADCAST = 1_000_000


def symbol_factors(bars: DataFrame) -> DataFrame:
    """prev_close, ema20, true_range, atr14_lag1, ret, gap_atr and slope_atr of each bar.

    All windows share one partitioning and order. The mean true range of the 14 bars before
    a bar is one frame, so no window is nested in another.
    """
    w = Window.partitionBy("symbol").orderBy("ts_ms")
    out = with_ema(bars, "close", SPAN, "symbol", "ts_ms", "ema20")
    out = out.withColumn("prev_close", F.lag("close").over(w))
    high, low, close, before = (F.col(c) for c in ("high", "low", "close", "prev_close"))
    out = out.withColumn("true_range", F.greatest(high - low, F.abs(high - before), F.abs(low - before)))
    out = out.withColumns({"atr14_lag1": F.avg("true_range").over(rows_back(w, ATR, -1)), "ret": F.round(ratio(close, before) - 1, 12), "_ema_before": F.lag("ema20", SLOPE).over(w)})
    atr, ema = F.col("atr14_lag1"), F.col("ema20")
    return out.withColumns({"gap_atr": F.round(ratio(close - ema, atr), 12), "slope_atr": F.round(ratio(ema - F.col("_ema_before"), atr), 12)}).drop("_ema_before")


def against_benchmark(factors: DataFrame, benchmark: str) -> DataFrame:
    """Rows of other symbols beside the benchmark's row at the same time; others vanish.

    The benchmark's values come from a window over the time, whose partitioning the ranks
    after it need as well, so neither side is joined or broadcast.
    """
    w = Window.partitionBy("ts_ms")
    mine = F.col("symbol") == benchmark
    held = factors.withColumn("_b", F.max(F.when(mine, F.struct("ret", "gap_atr", "slope_atr"))).over(w)).filter(F.col("_b").isNotNull() & ~mine)
    return held.select("*", F.col("_b.ret").alias("btc_ret"), F.col("_b.gap_atr").alias("btc_gap_atr"), F.col("_b.slope_atr").alias("btc_slope_atr")).drop("_b")


def relative(joined: DataFrame, max_abs_gap_atr: float = 2.5, max_ret: float | None = None) -> DataFrame:
    """Differences to the benchmark and the overheat flag, null where it cannot be told."""
    minus = lambda a, b: F.round(F.col(a) - F.col(b), 12)
    out = joined.withColumns({"rs_ret": minus("ret", "btc_ret"), "rs_gap": minus("gap_atr", "btc_gap_atr"), "rs_slope": minus("slope_atr", "btc_slope_atr"), "overheat": F.abs("gap_atr")})
    hot = F.col("overheat") > max_abs_gap_atr
    return out.withColumn("is_overheated", hot if max_ret is None else hot | (F.abs("ret") > max_ret))


def scored(rows: DataFrame) -> DataFrame:
    """Strong and weak scores and ranks; ranks of factors count all rows at a time."""
    slope = F.coalesce("rs_slope", F.lit(0.0))
    hot = average_rank(F.col("overheat"), "ts_ms", True)

    def score(sign: int):
        parts = (0.45, F.col("rs_ret")), (0.30, F.col("rs_gap")), (0.15, slope)
        ranked = [weight * average_rank(sign * x, "ts_ms", True) for weight, x in parts]
        return ranked[0] + ranked[1] + ranked[2] - 0.10 * hot

    calm = ~F.col("is_overheated")
    out = rows.withColumns({"strong_score": score(1), "weak_score": score(-1)})
    out = out.withColumns(
        {
            "strong_score": F.when(calm & (F.col("rs_ret") > 0) & (F.col("rs_gap") > 0), F.col("strong_score")),
            "weak_score": F.when(calm & (F.col("rs_ret") < 0) & (F.col("rs_gap") < 0), F.col("weak_score")),
        }
    )
    return out.withColumns({"strong_rank": average_rank(F.col("strong_score"), "ts_ms").cast("long"), "weak_rank": average_rank(F.col("weak_score"), "ts_ms").cast("long")})


def recent_from(times: DataFrame, n: int) -> DataFrame:
    """One row: the earliest (_from) of the last ``n`` distinct values of ts_ms."""
    return times.groupBy("ts_ms").agg(F.lit(1)).orderBy(F.desc("ts_ms")).limit(n).agg(F.min("ts_ms").alias("_from"))


def since(frame: DataFrame, start: DataFrame) -> DataFrame:
    """Rows from the time in the one row of ``start`` on."""
    return frame.join(F.broadcast(start), F.col("ts_ms") >= F.col("_from"), "left_semi")


def _few(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MOST_BROADCAST else table


def target_tail(frame: DataFrame, tail_bars: int, times: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``tail_bars`` times of all symbols together.

    times: a table that has the same times in ts_ms and costs less to evaluate.
    """
    return since(frame, recent_from(frame if times is None else times, tail_bars))


def source_tail(candles: DataFrame, tf: str, interval: str, tail_bars: int, warmup_bars: int = 50) -> DataFrame:
    """Each symbol's last candles, enough for ``tail_bars`` and ``warmup_bars`` bars of ``tf``.

    The latest open times are found first, by aggregates that are combined before their
    shuffle; the earliest start of all then bounds the scan, and the starts, one for each
    symbol, are broadcast if they are few. Candles are neither shuffled nor sorted.
    """
    if tail_bars < 1:
        raise ValueError("tail_bars must be positive")
    if warmup_bars < 0:
        raise ValueError("warmup_bars must not be negative")
    step = interval_ms(interval)
    back = ((tail_bars + warmup_bars) * max(1, timeframe_ms(tf) // step) - 1) * step
    starts = candles.groupBy(F.col("symbol").alias("_symbol")).agg((F.max("open_time_ms") - back).alias("_start"))
    n, earliest = starts.agg(F.count("*"), F.min("_start")).first()
    if earliest is None:
        return candles.limit(0)
    rows = candles.filter(F.col("open_time_ms") >= earliest)
    if "date" in candles.columns:
        rows = rows.filter(F.col("date") >= day_of(earliest).isoformat())
    return rows.join(_few(starts, n), (F.col("symbol") == F.col("_symbol")) & (F.col("open_time_ms") >= F.col("_start"))).drop("_symbol", "_start")


def liquid_universe(bars: DataFrame, benchmark: str, top: int, lookback_bars: int = 20) -> DataFrame:
    """Bars of the ``top`` symbols by quote volume over the last times, and the benchmark's."""
    if top < 1:
        raise ValueError("top must be positive")
    if lookback_bars < 1:
        raise ValueError("lookback_bars must be positive")
    recent = since(bars, recent_from(bars, lookback_bars)).filter(F.col("symbol") != benchmark)
    volume = recent.groupBy("symbol").agg(F.sum("quote_volume").alias("v")).orderBy(F.desc("v"), "symbol").limit(top).select("symbol")
    kept = _few(volume.withColumnRenamed("symbol", "_kept"), top)
    own = bars.join(kept, F.col("symbol") == F.col("_kept"), "left")
    return own.filter((F.col("symbol") == benchmark) | F.col("_kept").isNotNull()).drop("_kept")


def strength_frame(
    candles: DataFrame, tf: str, benchmark: str = "BTCUSDT", max_abs_gap_atr: float = 2.5, max_ret: float | None = None, source: str | None = None,
    tail_bars: int | None = None, liquidity_top: int | None = None, liquidity_lookback_bars: int = 20,
) -> DataFrame:
    """The board of one timeframe, from its candles (see board)."""
    bars = resample(candles, timeframe_ms(tf), takers=False, counted="bar_count")
    return board(bars, tf, benchmark, max_abs_gap_atr, max_ret, source, tail_bars, liquidity_top, liquidity_lookback_bars)


def board(
    bars: DataFrame, tf: str, benchmark: str = "BTCUSDT", max_abs_gap_atr: float = 2.5, max_ret: float | None = None, source: str | None = None,
    tail_bars: int | None = None, liquidity_top: int | None = None, liquidity_lookback_bars: int = 20,
) -> DataFrame:
    """The board of one timeframe: the universe is cut before factors, the tail after ranks.

    With a universe or a tail ``bars`` are read several times: a caller with many candles
    stores them first.
    """
    if liquidity_top is not None:
        bars = liquid_universe(bars, benchmark, liquidity_top, liquidity_lookback_bars)
    joined = against_benchmark(symbol_factors(bars), benchmark).withColumns({"tf": F.lit(tf), "source_interval": F.lit(source or source_interval(tf))})
    out = scored(relative(joined, max_abs_gap_atr, max_ret))
    if tail_bars is None:
        return out
    # the board's times are those at which the benchmark and another symbol have a bar
    is_benchmark = F.col("symbol") == benchmark
    times = bars.groupBy("ts_ms").agg(F.bool_or(is_benchmark).alias("_b"), F.bool_or(~is_benchmark).alias("_o")).filter("_b and _o").select("ts_ms")
    return target_tail(out, tail_bars, times)


def in_order(board: DataFrame) -> DataFrame:
    return board.orderBy("ts_ms", F.col("strong_rank").asc_nulls_last(), F.col("weak_rank").asc_nulls_last(), "symbol")


def latest(frame: DataFrame, at: str = "ts_ms") -> DataFrame:
    """Rows of the greatest time."""
    last = frame.agg(F.max(at).alias("_last"))
    return frame.join(F.broadcast(last), F.col(at) == F.col("_last"), "left_semi")


def shown(board: DataFrame, side: str = "strong", top: int = 10, rank_pct: float = 0.2, include_overheated: bool = False, only_latest: bool = True, limit: int = 20) -> DataFrame:
    """What the board shows: the best ``rank_pct`` of a side, at most ``top`` and ``limit`` rows.

    The share is taken of all rows left after the overheat filter, ranked or not.
    """
    rank = "strong_rank" if side == "strong" else "weak_rank"
    rows = latest(board) if only_latest else board
    if not include_overheated:
        rows = rows.filter(~F.col("is_overheated"))
    ranked = rows.withColumn("_rank", average_rank(F.col(rank), "ts_ms").cast("long"))
    count = rows.agg(F.count("*").alias("_n"))
    cut = F.greatest(F.lit(1), F.floor(F.col("_n") * rank_pct)) if rank_pct < 1 else F.col("_n")
    best = ranked.crossJoin(F.broadcast(count)).filter(F.col("_rank").isNotNull() & (F.col("_rank") <= cut))
    return best.orderBy("_rank", "ts_ms", "symbol").limit(min(limit, top)).select("ts_ms", "symbol", "rs_ret", "rs_gap", rank, "is_overheated")
