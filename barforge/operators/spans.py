"""Progress as spans of open times: what is covered, what lacks, and what is known to stay a hole.

A span is (symbol, interval, start_ms, end_ms), both ends open times that it includes. All of it
is DataFrames with windows by series; spans are far fewer than candles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES = ["symbol", "interval"]
SPAN = "symbol string, interval string, start_ms long, end_ms long"
#: Of a stored span: how often it was asked for in vain; null where candles cover it.
SPANS = f"{SPAN}, tries int"


def runs(candles: DataFrame, step_ms: int) -> DataFrame:
    """Spans of consecutive candles; repeated ones count once."""
    w = Window.partitionBy(*SERIES).orderBy("open_time_ms")
    rows = candles.select(*SERIES, "open_time_ms").distinct()
    island = F.col("open_time_ms") - F.row_number().over(w) * F.lit(step_ms)
    return rows.withColumn("_island", island).groupBy(*SERIES, "_island").agg(F.min("open_time_ms").alias("start_ms"), F.max("open_time_ms").alias("end_ms")).drop("_island")


def merged(spans: DataFrame, step_ms: int) -> DataFrame:
    """Spans that overlap or follow each other within a step, as one."""
    w = Window.partitionBy(*SERIES).orderBy("start_ms", "end_ms")
    before = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start_ms") <= before + step_ms, 0).otherwise(1)
    rows = spans.select(*SERIES, "start_ms", "end_ms").withColumn("_opens", opens).withColumn("_n", F.sum("_opens").over(w))
    return rows.groupBy(*SERIES, "_n").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("_n")


def lacking(covered: DataFrame, asked: DataFrame, step_ms: int) -> DataFrame:
    """The parts of ``asked`` that ``covered`` leaves open. Spans of ``asked`` do not overlap.

    Points at which something begins or ends are laid out in one order by series, so nothing
    is joined: between two of them that follow each other, a stretch is open if it is asked
    for and not covered. Stretches that touch become one span.
    """
    # +1 and -1 stand where a span begins and a step behind its end
    edge = lambda spans, name, by: spans.select(*SERIES, F.explode(F.array(F.struct(F.col("start_ms").alias("at"), F.lit(by).alias("by")), F.struct((F.col("end_ms") + step_ms).alias("at"), F.lit(-by).alias("by")))).alias("e")).select(
        *SERIES, F.col("e.at").alias("at"), *((F.col("e.by") if n == name else F.lit(0)).alias(n) for n in ("has", "wants"))
    )
    edges = edge(covered, "has", 1).union(edge(asked, "wants", 1)).groupBy(*SERIES, "at").agg(F.sum("has").alias("has"), F.sum("wants").alias("wants"))
    w = Window.partitionBy(*SERIES).orderBy("at")
    stretches = edges.select(*SERIES, F.col("at").alias("start_ms"), (F.lead("at").over(w) - step_ms).alias("end_ms"), F.sum("has").over(w).alias("has"), F.sum("wants").over(w).alias("wants"))
    return merged(stretches.filter("wants > 0 and has = 0"), step_ms)


def reached(settled: DataFrame, due: DataFrame, step_ms: int) -> DataFrame:
    """(symbol, interval, last_open_time_ms): the end of the settled span that holds what is due.

    due: symbol, interval, start_ms, one row each. A series of which that is not settled has no row.
    """
    spans = merged(settled, step_ms).join(due.select(*SERIES, F.col("start_ms").alias("_due")), SERIES)
    return spans.filter("start_ms <= _due and _due <= end_ms").select(*SERIES, F.col("end_ms").alias("last_open_time_ms"))


def tried(holes: DataFrame, before: DataFrame, more: int = 1) -> DataFrame:
    """SPANS of ``holes``, with ``more`` tries than the stored hole that they overlap had.

    Holes shrink, so there is hardly more than one; of the last that begins no later and the
    first that begins later, the greater number counts. One order by series finds both.
    """
    both = holes.select(*SERIES, "start_ms", "end_ms", F.lit(None).cast("int").alias("tries"), F.lit(1).alias("_new")).union(before.select(*SERIES, "start_ms", "end_ms", "tries", F.lit(0)))
    old = lambda c: F.when(F.col("_new") == 0, F.col(c))
    up = Window.partitionBy(*SERIES).orderBy("start_ms", "_new")
    down = Window.partitionBy(*SERIES).orderBy(F.desc("start_ms"), F.desc("_new"))
    last = lambda c, w: F.last(old(c), ignorenulls=True).over(w)
    met = both.select("*", last("end_ms", up).alias("_b"), last("tries", up).alias("_t"), last("start_ms", down).alias("_a"), last("tries", down).alias("_u")).filter("_new = 1")
    known = F.greatest(F.when(F.col("_b") >= F.col("start_ms"), F.col("_t")), F.when(F.col("_a") <= F.col("end_ms"), F.col("_u")), F.lit(0))
    return met.select(*SERIES, "start_ms", "end_ms", (known + more).cast("int").alias("tries"))
