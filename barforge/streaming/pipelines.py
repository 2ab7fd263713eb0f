"""Structured Streaming: candles from messages into the lake, and bars from ticks.

Both sinks merge by key inside foreachBatch, so a replayed batch changes nothing; progress
is Spark's own checkpoint and never runs ahead of what is stored.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barforge.operators.quality import clean, contiguous_from, find_gaps
from barforge.schema import GAP_KEY, KEY, STATE
from barforge.sources.ingest import merge_state, parse_messages
from barforge.sources.lake import GAP_PARTS, WRITING, delete_keys, exists, keep_last, merge_gaps, remove, replace, scan, upsert

Sink = Callable[[DataFrame, int], None]


class Marks:
    """How far each series reaches without a gap, kept by the driver and saved now and then.

    There is one mark for each series that trades. A mark moves to the last candle that
    follows, without a gap, the one after it. They are saved at most every ``seconds``, and by
    ``save``; others may save to the same table, as fills do: the greater mark stands, and is
    taken over. Marks that were not saved cost candles that are fetched again, nothing else.
    """

    def __init__(self, path: str, step_ms: int, seconds: float = 0.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.path, self.step_ms, self.seconds, self.clock = path, step_ms, seconds, clock
        self.known: dict[tuple[str, str], int] | None = None
        self.moved: dict[tuple[str, str], int] = {}
        self.saved: float | None = None

    def _read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(STATE).parquet(self.path) if exists(spark, self.path) else spark.createDataFrame([], STATE)

    def _take(self, state: DataFrame) -> None:
        self.known = {(r.symbol, r.interval): r.last_open_time_ms for r in state.collect() if r.last_open_time_ms is not None}

    def move(self, accepted: DataFrame) -> None:
        spark = accepted.sparkSession
        if self.known is None:
            self._take(self._read(spark))
        due = [(*series, mark + self.step_ms) for series, mark in self.known.items()]
        starts = spark.createDataFrame(due, "symbol string, interval string, start_ms long")
        for r in contiguous_from(accepted, starts, self.step_ms).collect():
            self.known[r.symbol, r.interval] = self.moved[r.symbol, r.interval] = r.last_open_time_ms
        if self.saved is None or self.clock() - self.saved >= self.seconds:
            self.save(spark)

    def save(self, spark: SparkSession) -> None:
        """Save what has moved, and take over what others have saved."""
        with WRITING:
            if self.moved:
                new = spark.createDataFrame([(*series, mark, "active") for series, mark in self.moved.items()], STATE)
                replace(merge_state(self._read(spark), new), self.path)
            self._take(self._read(spark))
        self.moved, self.saved = {}, self.clock()


def arrival(rows: DataFrame) -> DataFrame:
    """``rows`` with ``seq``, their order: the event's own time, where it has one, and then as read."""
    at = F.coalesce("event_time_ms", F.lit(0)) if "event_time_ms" in rows.columns else F.lit(0)
    order = F.shiftleft(at.cast("long"), 20) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    return rows.withColumn("seq", order).drop("event_time_ms")


class Ends:
    """The last stored candle of each series, kept by the driver, so that gaps between batches are seen.

    A series that is met for the first time is looked up in the table, in its own folders.
    There is one entry for each series that trades.
    """

    def __init__(self, silver: str) -> None:
        self.silver, self.known = silver, {}

    def before(self, accepted: DataFrame) -> dict[tuple[str, str], tuple[int, int, int | None]]:
        """(symbol, interval) -> (first, last open time of the batch, last one stored before it)."""
        spark = accepted.sparkSession
        met = {(r.symbol, r.interval): (r.a, r.b) for r in accepted.groupBy("symbol", "interval").agg(F.min("open_time_ms").alias("a"), F.max("open_time_ms").alias("b")).collect()}
        new = [s for s in met if s not in self.known]
        for interval in {i for _, i in new}:
            stored = scan(spark, self.silver, interval, sorted(s for s, i in new if i == interval))
            self.known |= {(r.symbol, interval): r.last for r in stored.groupBy("symbol").agg(F.max("open_time_ms").alias("last")).collect()}
        return {s: (a, b, self.known.get(s)) for s, (a, b) in met.items()}

    def stored(self, met: dict) -> None:
        for series, (_, last, before) in met.items():
            self.known[series] = last if before is None else max(last, before)

    @staticmethod
    def joined(accepted: DataFrame, met: dict) -> DataFrame:
        """The batch's open times behind the last candle before it, with that one ahead of them.

        Late ones are left out: the gap that they lie in was reported already.
        """
        spark = accepted.sparkSession
        ends = spark.createDataFrame([(*series, before, last) for series, (_, last, before) in met.items()], "symbol string, interval string, _before long, _last long")
        rows = accepted.select("symbol", "interval", "open_time_ms").join(F.broadcast(ends), ["symbol", "interval"]).filter("_before is null or open_time_ms > _before")  # a row for each series of the batch
        return rows.select("symbol", "interval", "open_time_ms").union(ends.filter("_before < _last").select("symbol", "interval", "_before"))


def candle_sink(
    silver: str, step_ms: int, raw: str | None = None, quarantine: str | None = None, gap_report: str | None = None, open_candles: str | None = None, state: str | Marks | None = None,
) -> Sink:
    """What each batch of parsed messages does: closed candles are cleaned and merged, gaps are
    reported, those between this batch and the ones before it too, and struck out when late candles fill them, the
    newest open one of each symbol is kept apart, and marks of progress move forward, each to
    the last candle that follows without a gap the one after the mark: after each batch, or as
    the given ``Marks`` say."""
    marks = Marks(state, step_ms) if isinstance(state, str) else state
    ends = Ends(silver)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = arrival(batch).persist()
        try:
            got = clean(rows.filter("is_closed").drop("is_closed"), step_ms)
            met = ends.before(got.accepted) if gap_report else {}
            if raw:
                upsert(got.judged.drop("verdict", "reason"), raw, "seq")
            upsert(got.accepted, silver, "seq")
            if quarantine:
                upsert(got.judged.filter("verdict in ('rejected', 'conflict')").drop("verdict", "reason"), quarantine, "seq")
            if gap_report:
                gaps = find_gaps(Ends.joined(got.accepted, met), step_ms)
                if not gaps.isEmpty():
                    merge_gaps(gaps, gap_report)
                late = [series for series, (first, _, before) in met.items() if before is not None and first < before]
                if late and exists(spark, gap_report):  # candles that were reported missing and have come
                    came = got.accepted.filter(F.struct("symbol", "interval").isin([F.struct(F.lit(s), F.lit(i)) for s, i in late]))
                    delete_keys(gap_report, came.select("symbol", "interval", F.col("open_time_ms").alias("missing_open_time_ms")), GAP_KEY, GAP_PARTS)
                ends.stored(met)
            if open_candles:
                now = rows.filter("not is_closed").drop("is_closed").withColumn("_v", F.lit(1))
                if exists(spark, open_candles):
                    now = now.unionByName(spark.read.schema(now.drop("_v").schema).parquet(open_candles).withColumn("_v", F.lit(0)))
                # a row for each series
                replace(keep_last(now, ["symbol", "interval"], ["open_time_ms", "_v", "seq"]).drop("_v"), open_candles)
            if marks:
                marks.move(got.accepted)
        finally:
            rows.unpersist()

    return sink


def hot_rows(spark: SparkSession, hot: str) -> DataFrame:
    """The candles that wait in the hot log, the last of each key."""
    rows = spark.read.option("basePath", hot).parquet(hot)
    return keep_last(rows, KEY, ["batch", "seq"]).drop("batch")


def buffered(sink: Sink, hot: str, most: int = 1000) -> Sink:
    """Closed candles go to a hot log first, and through ``sink`` once it holds ``most`` of them.

    The log has a folder for each batch, with that batch's rows and nothing else, so what a
    batch writes does not grow with what waits; readers lay ``hot_rows`` over the lake
    (lake.overlay). It is emptied only after the sink has stored its rows; a run that ends in
    between stores them again, which changes nothing. What another run has left goes through
    the sink first. Open candles pass at once.
    """
    begun = False

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal begun
        spark = batch.sparkSession
        if not begun:
            flush(spark, sink, hot, batch_id)
            begun = True
        rows = arrival(batch).persist()
        try:
            rows.filter("is_closed").coalesce(1).write.mode("overwrite").parquet(f"{hot}/batch={batch_id}")
            opened = rows.filter("not is_closed").drop("seq")
            if not opened.isEmpty():
                sink(opened, batch_id)
        finally:
            rows.unpersist()
        if hot_rows(spark, hot).count() >= most:
            flush(spark, sink, hot, batch_id)

    return write


def flush(spark: SparkSession, sink: Sink, hot: str, batch_id: int = 0) -> None:
    """Move what the hot log holds through ``sink``, as at the end of a stream."""
    if exists(spark, hot):
        sink(hot_rows(spark, hot).withColumnRenamed("seq", "event_time_ms").withColumn("event_time_ms", F.shiftright("event_time_ms", 20)), batch_id)
        remove(spark, hot)


def ingest(messages: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start storing a stream of text messages (column value)."""
    return parse_messages(messages).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "500 milliseconds"})).start()


def windowed_bars(ticks: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    """Bars of event-time windows of (symbol, at, price, size, tie) ticks, late ones within ``late``."""
    order = F.struct("at", "tie")
    return (
        ticks.withWatermark("at", late)
        .groupBy("symbol", F.window("at", width).alias("w"))
        .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("size").alias("volume"), F.count("*").alias("trade_count"))
        .select("symbol", F.unix_millis("w.start").alias("open_time_ms"), "open", "high", "low", "close", "volume", "trade_count")
    )


def store_bars(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge updated windows into a table partitioned by day, until the stream's present end.

    Only days that a batch touches are read and rewritten.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("date", F.date_format(F.timestamp_millis("open_time_ms"), "yyyy-MM-dd"))
        upsert(dated, path, key=["symbol", "open_time_ms"], parts=["date"])

    return bars.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
