"""Cleaning: validation, duplicates, conflicts, gaps and the contiguous mark."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.schema import KEY, VALUES


def reject_reason(step_ms: int) -> Column:
    """The first rule that a candle breaks, or null.

    A candle that lacks a key or a value breaks the first, missing_value: no rule after it
    compares with null. NaN prices are rejected as invalid_ohlc.
    """
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    prices = F.isnan(o) | F.isnan(h) | F.isnan(lo) | F.isnan(c)
    missing = reduce(or_, (F.col(x).isNull() for x in (*KEY, *VALUES)))
    return (
        F.when(missing, "missing_value")
        .when(F.col("close_time_ms") != F.col("open_time_ms") + (step_ms - 1), "invalid_close_time")
        .when(F.pmod("open_time_ms", F.lit(step_ms)) != 0, "misaligned_open_time")
        .when(prices | (h < F.greatest(o, c, lo)) | (lo > F.least(o, c, h)), "invalid_ohlc")
        .when((F.col("volume") < 0) | (F.col("quote_volume") < 0), "negative_volume")
        .when(F.col("trade_count") < 0, "negative_trade_count")
        .when((F.col("taker_buy_base_volume") < 0) | (F.col("taker_buy_quote_volume") < 0), "negative_taker_buy_volume")
    )


@dataclass
class Cleaned:
    """Lazy results of one batch; ``judged`` holds each row with its ``verdict``."""

    judged: DataFrame
    step_ms: int

    def _of(self, *verdicts: str) -> DataFrame:
        return self.judged.filter(F.col("verdict").isin(*verdicts))

    @property
    def accepted(self) -> DataFrame:
        return self._of("accepted").drop("verdict", "reason")

    @property
    def rejected(self) -> DataFrame:
        return self._of("rejected").drop("verdict")

    @property
    def conflicts(self) -> DataFrame:
        return self._of("conflict").drop("verdict")

    @property
    def gaps(self) -> DataFrame:
        return find_gaps(self.accepted, self.step_ms)

    def counters(self) -> DataFrame:
        """One row of counts over the batch, gaps apart."""
        is_ = lambda v: F.count_if(F.col("verdict") == v)
        return self.judged.agg(F.count("*").alias("raw"), is_("accepted").alias("accepted"), is_("rejected").alias("rejected"), is_("conflict").alias("conflicts"))


def clean(candles: DataFrame, step_ms: int, sequence: str = "seq") -> Cleaned:
    """Judge each row of a batch; ``sequence`` gives the order in which rows arrived.

    Rows that break a rule are rejected. Of valid rows with one key the first is accepted,
    later ones are dropped if they are the same and conflicts if they differ.
    """
    row = F.struct(*VALUES)
    keyed = candles.withColumn("reason", reject_reason(step_ms))
    # rejected rows take no part in their key: they are ranked by themselves
    w = Window.partitionBy(*KEY, F.col("reason").isNull()).orderBy(sequence)
    first = F.first(row).over(w)
    verdict = (
        F.when(F.col("reason").isNotNull(), "rejected")
        .when(F.row_number().over(w) == 1, "accepted")
        .when(row.eqNullSafe(first), "repeat")
        .otherwise("conflict")
    )
    judged = keyed.withColumn("verdict", verdict)
    return Cleaned(judged.withColumn("reason", F.when(F.col("verdict") == "conflict", "duplicate_conflict").otherwise(F.col("reason"))), step_ms)


def find_gaps(accepted: DataFrame, step_ms: int) -> DataFrame:
    """Each open time that is missing between two consecutive candles of a series."""
    w = Window.partitionBy("symbol", "interval").orderBy("open_time_ms")
    step = F.lit(step_ms).cast("long")
    pairs = accepted.select("symbol", "interval", F.col("open_time_ms").alias("previous_open_time_ms"), F.lead("open_time_ms").over(w).alias("next_open_time_ms"))
    pairs = pairs.filter(F.col("next_open_time_ms") > F.col("previous_open_time_ms") + step)
    # the last slot is one millisecond short of the next candle, which may be off the grid
    missing = F.explode(F.sequence(F.col("previous_open_time_ms") + step, F.col("next_open_time_ms") - 1, step))
    return pairs.select("symbol", "interval", missing.alias("missing_open_time_ms"), "previous_open_time_ms", "next_open_time_ms")


def contiguous_from(accepted: DataFrame, starts: DataFrame, step_ms: int) -> DataFrame:
    """(symbol, interval, last_open_time_ms): how far candles reach without a gap from where they should begin.

    starts: symbol, interval, start_ms, one row each; a null or missing start is the series'
    first candle. A series whose first candle at or after its start is not the one expected
    there, at the start moved up to the grid, has no row: its mark may not move. One exchange
    by series; what comes before the start is dropped ahead of the sort.
    """
    step = F.lit(step_ms).cast("long")
    w = Window.partitionBy("symbol", "interval").orderBy("open_time_ms")
    own = accepted.select("symbol", "interval", "open_time_ms").join(starts.select("symbol", "interval", "start_ms"), ["symbol", "interval"], "left")
    own = own.filter("start_ms is null or open_time_ms >= start_ms").distinct()
    aligned = F.coalesce(F.col("start_ms") + F.pmod(-F.col("start_ms"), step), F.first("open_time_ms").over(w))
    run = own.withColumn("_due", aligned + (F.row_number().over(w) - 1) * step).filter("open_time_ms = _due")
    return run.groupBy("symbol", "interval").agg(F.max("open_time_ms").alias("last_open_time_ms"))


def contiguous_mark(accepted: DataFrame, step_ms: int, strict: bool = False) -> DataFrame:
    """One row: the least over series of how far each reaches without a gap; null if empty.

    As the reference has it, a series with gaps counts up to its last gap; ``strict`` takes
    the first gap, which is what contiguity means.
    """
    w = Window.partitionBy("symbol", "interval").orderBy("open_time_ms")
    step = F.lit(step_ms).cast("long")
    # of a stretch of missing slots the first is previous + step, the last the greatest before next
    nxt, own = F.lead("open_time_ms").over(w), F.col("open_time_ms")
    ahead = accepted.select("symbol", "interval", own, nxt.alias("n"))
    gap = F.col("n") > own + step
    first_missing = F.when(gap, own + step)
    last_missing = F.when(gap, own + step * F.expr(f"(n - 1 - open_time_ms) div {step_ms}"))
    missing = F.min(first_missing) if strict else F.max(last_missing)
    series = ahead.groupBy("symbol", "interval").agg(F.max("open_time_ms").alias("last"), missing.alias("missing"))
    return series.agg(F.min(F.coalesce(F.col("missing") - step, F.col("last"))).alias("contiguous_last_open_time_ms"))
