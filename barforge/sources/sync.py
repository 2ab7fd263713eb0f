"""Keeping the lake up to date: what symbols lack is planned, fetched, cleaned and marked."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.timeframes import aligned_up, day_start, interval_ms, last_closed_open
from barforge.operators import spans
from barforge.operators.quality import contiguous_from
from barforge.schema import STATE
from barforge.sources import ingest, lake
from barforge.sources.transport import MissingCandles


@dataclass
class Tables:
    """Where a market's tables are. Without ``spans`` a mark stops at the first gap for good."""

    raw: str | None
    silver: str
    quarantine: str
    gaps: str
    state: str
    spans: str | None = None


@dataclass
class Fetching:
    """How candles are fetched; see MissingCandles.

    tasks and archive_tasks: requests for pages and for archives that run at once. wave:
    symbols that are fetched, stored and marked before the next ones. tries: how often a
    hole is asked for before it counts as one that stays, if it is ``hole_age`` old.
    """

    fetch: str
    archive: str | None = None
    cache: str | None = None
    limit: int = 499
    tasks: int = 8
    weight: int = 900
    archive_threshold_days: int = 2
    archive_tasks: int = 4
    wave: int = 200
    tries: int = 3
    hole_age: timedelta = timedelta(days=1)


class SyncFailed(Exception):
    """What could not be fetched, by symbol; all else is stored and marked."""

    def __init__(self, errors: dict[str, str], counts: dict[str, int]) -> None:
        super().__init__("; ".join(f"{s}: {e}" for s, e in sorted(errors.items())[:20]))
        self.errors, self.counts = errors, counts


Range = tuple[str, int, int]


def read_state(spark: SparkSession, path: str, legacy: str | None = None, interval: str | None = None) -> DataFrame:
    """Progress of each series; where there is none yet, that of a ``legacy`` file."""
    if lake.exists(spark, path):
        return spark.read.schema(STATE).parquet(path)
    if legacy and interval and lake.exists(spark, legacy):
        return ingest.legacy_state(spark, legacy, interval)
    return spark.createDataFrame([], STATE)


def read_spans(spark: SparkSession, path: str | None) -> DataFrame:
    """Spans beyond the marks: covered ones, and holes with their tries."""
    return spark.read.schema(spans.SPANS).parquet(path) if path and lake.exists(spark, path) else spark.createDataFrame([], spans.SPANS)


def _read(spark: SparkSession, kind: str, plan: list[Range], interval: str, how: Fetching, tasks: int, cutoff: str) -> tuple[DataFrame, dict, str]:
    """(rows with payloads, notes by (symbol, start), where they are stored)."""
    spark.dataSource.register(MissingCandles)
    options = {"fetch": how.fetch, "archive": how.archive, "cache": how.cache, "limit": how.limit, "weight": how.weight, "step_ms": interval_ms(interval)}
    read = spark.read.format("missing_candles").options(kind=kind, plan=json.dumps(plan), interval=interval, tasks=tasks, cutoff=cutoff, **{k: str(v) for k, v in options.items() if v is not None})
    staged = lake.scratch(spark)
    read.load().write.parquet(staged)
    rows = spark.read.schema("symbol string, interval string, payload string, start_ms long, reached_ms long, error string").parquet(staged)
    notes = {(r.symbol, r.start_ms): (r.reached_ms, r.error) for r in rows.filter("payload is null").collect()}  # one for each range
    return rows.filter("payload is not null"), notes, staged


def fetch(spark: SparkSession, ranges: list[Range], interval: str, how: Fetching, now: datetime) -> tuple[DataFrame, dict[tuple[str, int], str], list[str]]:
    """(closed candles of ``ranges``, errors by (symbol, start), stored tables that they are read from).

    Archives first, ``archive_tasks`` at once; from where they end on, pages, ``tasks`` at once.
    """
    cutoff = now.astimezone(UTC).date() - timedelta(days=how.archive_threshold_days)
    from_archives = [r for r in ranges if how.archive and day_start(cutoff) >= r[1] // 86_400_000 * 86_400_000]
    rows, staged, begun = [], [], {}
    if from_archives:
        got, notes, path = _read(spark, "archives", from_archives, interval, how, how.archive_tasks, cutoff.isoformat())
        rows.append(got)
        staged.append(path)
        begun = {k: reached for k, (reached, _) in notes.items()}
    rest = [(s, begun.get((s, a), a), b) for s, a, b in ranges]
    first = {(s, begun.get((s, a), a)): (s, a) for s, a, _ in ranges}
    rest = [r for r in rest if r[1] <= r[2]]
    errors = {}
    if rest:
        got, notes, path = _read(spark, "pages", rest, interval, how, how.tasks, cutoff.isoformat())
        rows.append(got)
        staged.append(path)
        errors = {first[k]: e for k, (_, e) in notes.items() if e}
    payloads = rows[0] if len(rows) == 1 else rows[0].union(rows[1]) if rows else spark.createDataFrame([], "symbol string, interval string, payload string")
    closed = ingest.closed_only(ingest.parse_rows(payloads), int(now.timestamp() * 1000))
    return closed.withColumn("seq", F.monotonically_increasing_id()), errors, staged


def fetched(spark: SparkSession, starts: list[tuple[str, int]], interval: str, how: Fetching, now: datetime) -> DataFrame:
    """Closed candles that the symbols lack from their starts on."""
    end = last_closed_open(now, interval_ms(interval))
    return fetch(spark, [(s, a, end) for s, a in starts if a <= end], interval, how, now)[0]


def _ranges(spark: SparkSession, starts: list[tuple[str, int]], interval: str, step: int, end: int, tables: Tables, how: Fetching) -> list[Range]:
    """What is to be asked for: from the starts on, without what is covered or known to be a hole."""
    if tables.spans is None:
        return [(s, a, end) for s, a in starts]
    due = spark.createDataFrame([(s, interval, aligned_up(a, step), end) for s, a in starts], spans.SPAN).filter("start_ms <= end_ms")
    settled = read_spans(spark, tables.spans).filter(F.col("tries").isNull() | (F.col("tries") >= how.tries))
    return [(r.symbol, r.start_ms, r.end_ms) for r in spans.lacking(settled, due, step).orderBy("symbol", "start_ms").collect()]


def _settle(spark: SparkSession, accepted: DataFrame, ranges: list[Range], failed: set[tuple[str, int]], starts: list[tuple[str, int]], interval: str, step: int, tables: Tables, how: Fetching, now: datetime) -> DataFrame:
    """Marks of ``starts`` after a wave; the spans beyond them are stored."""
    own, kept_at = sorted({s for s, _ in starts}), []

    def kept(rows: DataFrame) -> DataFrame:
        """``rows``, few, written once for all that reads them."""
        kept_at.append(lake.scratch(spark))
        rows.coalesce(1).write.parquet(kept_at[-1])
        return spark.read.schema(rows.schema).parquet(kept_at[-1])

    stored = read_spans(spark, tables.spans)
    mine = F.col("symbol").isin(own) & (F.col("interval") == interval)
    before, others = stored.filter(mine), stored.filter(~mine)
    span = "symbol", "interval", "start_ms", "end_ms"
    covered = kept(spans.merged(before.filter("tries is null").select(*span).union(spans.runs(accepted, step)), step))
    old_holes = before.filter("tries is not null")
    # a hole counts as asked for if its range went through, and if it is old enough not to come yet
    oldest = int((now - how.hole_age).timestamp() * 1000)
    through = [(s, interval, a, min(b, oldest)) for s, a, b in ranges if (s, a) not in failed and a <= oldest]
    asked = spark.createDataFrame(through, spans.SPAN)
    holes = spans.tried(spans.lacking(covered, asked, step), old_holes)
    if not old_holes.isEmpty():  # those of ranges that were not asked for now stay as they were
        holes = holes.union(spans.tried(spans.lacking(covered.union(asked), old_holes.select(*span), step), old_holes, 0))
    holes = kept(holes)
    settled = covered.union(holes.filter(F.col("tries") >= how.tries).select(*span))
    due = spark.createDataFrame([(s, interval, aligned_up(a, step)) for s, a in starts], "symbol string, interval string, start_ms long")
    marks = kept(spans.reached(settled, due, step))
    all_spans = covered.withColumn("tries", F.lit(None).cast("int")).union(holes)
    ahead = all_spans.join(marks, ["symbol", "interval"], "left").filter("last_open_time_ms is null or end_ms > last_open_time_ms").drop("last_open_time_ms")
    lake.replace(others.union(ahead).coalesce(1), tables.spans)
    marks = spark.createDataFrame(marks.collect(), marks.schema)  # one for each symbol of the wave
    for path in kept_at:
        lake.remove(spark, path)
    return marks


def sync_missing(
    spark: SparkSession, universe: DataFrame, interval: str, tables: Tables, how: Fetching, bootstrap_days: int = 30, now: datetime | None = None,
    whole_universe: bool = False, legacy: str | None = None, progress: Callable[[dict[str, int]], None] | None = None,
) -> dict[str, int]:
    """Fetch what each symbol (column symbol) lacks, clean it into the lake and move the marks.

    Symbols go in waves; a wave's candles are stored and its marks saved before the next is
    fetched. A range that cannot be fetched keeps what it had and holds up no other: SyncFailed
    tells of it at the end. A mark moves to the last candle that follows, without a gap, the
    one that was due; where that one did not come, it stays. With ``tables.spans`` covered spans
    beyond a gap are remembered and not fetched again, and a hole that was asked for
    ``how.tries`` times in vain is passed. With ``whole_universe`` series of symbols that are gone
    become inactive, and stay so. Returns counters; ``progress`` gets them after each wave and
    at the end.
    """
    now = now or datetime.now(tz=UTC)
    step = interval_ms(interval)
    end = last_closed_open(now, step)
    with lake.WRITING:
        before = read_state(spark, tables.state, legacy, interval)
        if whole_universe:
            lake.replace(ingest.mark_inactive(before, universe, interval), tables.state)
            before = read_state(spark, tables.state)
    plan = ingest.sync_plan(universe, before, interval, bootstrap_days, how.limit, now, how.archive is not None, how.archive_threshold_days)
    # a row for each symbol that trades: what the plan of a fetch is anyway
    starts = [(r.symbol, r.start_ms) for r in plan.filter(f"start_ms <= {end}").select("symbol", "start_ms").distinct().orderBy("symbol").collect()]
    counts = {"symbols": universe.select("symbol").distinct().count(), "raw": 0, "accepted": 0, "rejected": 0, "conflicts": 0, "gaps": 0}
    errors: dict[str, str] = {}
    for k in range(0, len(starts), how.wave):
        wave = starts[k : k + how.wave]
        ranges = _ranges(spark, wave, interval, step, end, tables, how)
        rows, failed, staged = fetch(spark, ranges, interval, how, now)
        errors |= {s: e for (s, _), e in failed.items()}
        with lake.WRITING:
            got = lake.write_cleaned(rows, step, tables.raw, tables.silver, tables.quarantine, tables.gaps)
            accepted = lake.clean(rows, step).accepted
            if tables.spans is None:
                due = spark.createDataFrame(wave, "symbol string, start_ms long").withColumn("interval", F.lit(interval))
                marks = contiguous_from(accepted, due, step)
            else:
                marks = _settle(spark, accepted, ranges, set(failed), wave, interval, step, tables, how, now)
            # read anew: a stream may have saved marks meanwhile
            lake.replace(ingest.merge_state(read_state(spark, tables.state, legacy, interval), marks.withColumn("status", F.lit("active"))), tables.state)
        counts |= {c: counts[c] + n for c, n in got.items()}
        for path in staged:
            lake.remove(spark, path)
        if progress and k + how.wave < len(starts):
            progress(counts | {"done": k + len(wave)})
    if progress:
        progress(counts)
    if errors:
        raise SyncFailed(errors, counts)
    return counts


def sync_recent(spark: SparkSession, universe: DataFrame, interval: str, tables: Tables, how: Fetching, now: datetime | None = None, progress: Callable[[dict[str, int]], None] | None = None) -> dict[str, int]:
    """Fetch only each symbol's last page of closed candles; marks are not touched."""
    now = now or datetime.now(tz=UTC)
    step = interval_ms(interval)
    end = last_closed_open(now, step)
    symbols = [r.symbol for r in universe.select("symbol").distinct().orderBy("symbol").collect()]
    page = Fetching(how.fetch, None, None, how.limit, how.tasks, how.weight)
    rows, failed, staged = fetch(spark, [(s, end - (how.limit - 1) * step, end) for s in symbols], interval, page, now)
    counts = {"symbols": len(symbols)} | lake.write_cleaned(rows, step, tables.raw, tables.silver, tables.quarantine, tables.gaps)
    for path in staged:
        lake.remove(spark, path)
    if progress:
        progress(counts)
    if failed:
        raise SyncFailed({s: e for (s, _), e in failed.items()}, counts)
    return counts
