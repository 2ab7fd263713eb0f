"""Parsing of exchange payloads, archives, universe and progress state."""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.timeframes import DAY, aligned_up, day_of, day_start, interval_ms, last_closed_open
from barforge.schema import CONTRACT
from barforge.sources.transport import archive_rows

#: Places of a positional candle row: name and type.
POSITIONS = [
    ("open_time_ms", "long"), ("open", "double"), ("high", "double"), ("low", "double"), ("close", "double"), ("volume", "double"), ("close_time_ms", "long"),
    ("quote_volume", "double"), ("trade_count", "long"), ("taker_buy_base_volume", "double"), ("taker_buy_quote_volume", "double"),
]
#: Fields of a streamed candle.
STREAMED = {
    "open_time_ms": ("t", "long"), "close_time_ms": ("T", "long"), "open": ("o", "double"), "close": ("c", "double"), "high": ("h", "double"), "low": ("l", "double"),
    "volume": ("v", "double"), "trade_count": ("n", "long"), "quote_volume": ("q", "double"), "taker_buy_base_volume": ("V", "double"), "taker_buy_quote_volume": ("Q", "double"),
}


def stored(rows: DataFrame) -> DataFrame:
    """Candles with the columns that follow from their open time."""
    at = F.timestamp_millis("open_time_ms")
    return rows.withColumns({"open_time": at, "date": F.date_format(at, "yyyy-MM-dd")})


def parse_rows(payload: DataFrame, column: str = "payload") -> DataFrame:
    """Positional JSON rows ``[open_time, "open", ...]`` beside symbol and interval.

    What is missing or no number becomes null, which validation rejects.
    """
    values = F.from_json(column, "array<string>")
    return stored(payload.select("symbol", "interval", *(F.get(values, i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(POSITIONS))))


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Streamed candle messages; others vanish. ``is_closed`` tells final candles.

    Fields differ by case alone, so objects are read as maps, each of them once. A field that
    is missing or no number becomes null, which validation rejects.
    """
    opened = lambda c: F.from_json(c, "map<string,string>")
    data = messages.select(opened(opened(column)["data"]).alias("d")).filter("d['e'] = 'kline'").withColumn("k", opened(F.col("d")["k"]))
    symbol = F.coalesce(F.nullif(F.col("d")["s"], F.lit("")), F.col("k")["s"])
    rows = data.select(
        symbol.alias("symbol"), F.col("k")["i"].alias("interval"), *(F.col("k")[field].try_cast(kind).alias(name) for name, (field, kind) in STREAMED.items()),
        F.coalesce(F.col("k")["x"].try_cast("boolean"), F.lit(False)).alias("is_closed"), F.col("d")["E"].try_cast("long").alias("event_time_ms"),
    )
    return stored(rows)


def contracts(spark: SparkSession, path: str) -> DataFrame:
    """Contracts of an exchange description in JSON."""
    return spark.read.schema(f"symbols array<struct<{CONTRACT.replace(' ', ':').replace(',:', ',')}>>").option("multiLine", True).json(path).select(F.explode("symbols").alias("s")).select("s.*")


def active(universe: DataFrame) -> DataFrame:
    """Symbols that trade as perpetual contracts in USDT, in order."""
    return universe.filter("status = 'TRADING' and contractType = 'PERPETUAL' and quoteAsset = 'USDT'").select("symbol").orderBy("symbol")


def append_snapshot(universe: DataFrame, history: str, current: str, at: datetime) -> None:
    """One more dated snapshot to the history; the active contracts become the current ones."""
    snapshot = universe.agg(F.collect_list(F.struct(*universe.columns)).alias("symbols")).withColumn("snapshot_time", F.lit(at.isoformat()))
    snapshot.write.mode("append").json(history)
    universe.join(active(universe), "symbol", "left_semi").write.mode("overwrite").json(current)


def closed_only(rows: DataFrame, now_ms: int) -> DataFrame:
    return rows.filter(F.col("close_time_ms") < now_ms)


def between(rows: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    return rows.filter(F.col("open_time_ms").between(start_ms, end_ms))


def read_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """Daily archives ``SYMBOL-INTERVAL-DATE.zip`` with one CSV each, header or not."""
    names = [n for n, _ in POSITIONS]
    kinds = dict(POSITIONS)

    def opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                symbol, interval = path.rsplit("/", 1)[-1].split("-")[:2]
                rows = [r[: len(names)] for r in archive_rows(content)]
                out = pd.DataFrame(rows, columns=names).astype({n: "int64" if k == "long" else "float64" for n, k in kinds.items()})
                out.insert(0, "interval", interval)
                out.insert(0, "symbol", symbol)
                yield out

    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    return stored(files.mapInPandas(opened, "symbol string, interval string, " + ", ".join(f"{n} {k}" for n, k in POSITIONS)))


def sync_plan(universe: DataFrame, state: DataFrame, interval: str, bootstrap_days: int, limit: int, now: datetime, use_archives: bool = True, archive_threshold_days: int = 2) -> DataFrame:
    """(symbol, start_ms, archive_days, rest_batches) of what each symbol still lacks."""
    step = interval_ms(interval)
    end = last_closed_open(now, step)
    bootstrap = int((now - timedelta(days=bootstrap_days)).timestamp() * 1000)
    own = state.filter(F.col("interval") == interval).select("symbol", "last_open_time_ms")
    start = F.coalesce(F.col("last_open_time_ms") + step, F.lit(bootstrap))
    rows = universe.select("symbol").join(own, "symbol", "left").select("symbol", start.alias("start_ms")).withColumn("_open", F.col("start_ms") <= end)
    first_day = F.expr(f"start_ms div {DAY}")
    last_day = min(day_start(now.astimezone(UTC).date() - timedelta(days=archive_threshold_days)), end) // DAY
    days = F.when(F.col("_open"), F.greatest(F.lit(0), F.lit(last_day) - first_day + 1)).otherwise(0) if use_archives else F.lit(0)
    rows = rows.withColumn("archive_days", days.cast("long"))
    rest = F.when(F.col("archive_days") > 0, (F.expr(f"start_ms div {DAY}") + F.col("archive_days")) * DAY).otherwise(F.col("start_ms"))
    rows = rows.withColumn("_rest", rest)
    batches = F.when(F.col("_open") & (F.col("_rest") <= end), F.expr(f"(({end} - _rest) div {step} + 1 + {limit - 1}) div {limit}")).otherwise(0)
    return rows.withColumn("rest_batches", batches.cast("long")).select("symbol", "start_ms", "archive_days", "rest_batches")


def mark_inactive(state: DataFrame, universe: DataFrame, interval: str) -> DataFrame:
    """States of the interval's symbols that trade no more become inactive; marks stay."""
    alive = universe.select("symbol").distinct().withColumn("_alive", F.lit(True))
    gone = (F.col("interval") == interval) & F.col("_alive").isNull()
    return state.join(alive, "symbol", "left").withColumn("status", F.when(gone, "inactive").otherwise(F.col("status"))).select(*state.columns)


def legacy_state(spark: SparkSession, path: str, interval: str) -> DataFrame:
    """State kept as one JSON object ``{"SYMBOL|INTERVAL": {"last_open_time_ms": ..., "status": ...}}``.

    Only the interval's entries are taken, as a later store is one for each interval.
    """
    entries = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<last_open_time_ms:long,status:string>>")))
    key = F.split("key", r"\|")
    rows = entries.select(key[0].alias("symbol"), F.get(key, 1).alias("interval"), "value.last_open_time_ms", F.coalesce("value.status", F.lit("active")).alias("status"))
    return rows.filter(F.col("interval") == interval)


def merge_state(state: DataFrame, progress: DataFrame) -> DataFrame:
    """Marks only move forward: the greater of both for each symbol and interval.

    A series of which ``progress`` says nothing keeps its status, inactive ones too.
    """
    new = progress.select("symbol", "interval", F.col("last_open_time_ms").alias("_new"), F.col("status").alias("_status"))
    return state.join(new, ["symbol", "interval"], "full").select(
        "symbol", "interval", F.greatest("last_open_time_ms", "_new").alias("last_open_time_ms"), F.coalesce("_status", "status").alias("status")
    )


def advances(expected_ms: int, batch_first_ms: int | None, mark_ms: int | None, step_ms: int) -> bool:
    """Whether a batch may move the mark: it begins where it should and has a contiguous part."""
    return mark_ms is not None and batch_first_ms == aligned_up(expected_ms, step_ms)


def archive_days(start_ms: int, end_ms: int, cutoff: date) -> int:
    last = min(day_start(cutoff), end_ms // DAY * DAY)
    return max(0, (last - day_start(day_of(start_ms))) // DAY + 1)


def rest_batches(start_ms: int, end_ms: int, step_ms: int, limit: int) -> int:
    return max(0, math.ceil(((end_ms - start_ms) // step_ms + 1) / limit))
