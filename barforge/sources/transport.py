"""Thin transport: request weights, limiter, retries, paging, archives, and the data source over them.

Nothing here opens a connection by itself: what fetches is handed in.
"""

from __future__ import annotations

import csv
import io
import json
import math
import os
import time
import uuid
import zipfile
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from importlib import import_module

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from barforge.functions.timeframes import day_of, day_start

WINDOW = 60.0


# A page of fewer candles than the first number costs the second, any other TOP_WEIGHT.
WEIGHTS = ((100, 1), (500, 2), (1001, 5))
TOP_WEIGHT = 10


def request_weight(limit: int) -> int:
    """What a page of so many candles costs."""
    return next((w for below, w in WEIGHTS if limit < below), TOP_WEIGHT)


class WeightLimiter:
    """At most ``most`` units of weight within any 60 seconds.

    What is spent is kept as running sums by time. The sum that a request has to see expire
    first names the one moment from which on it fits, which is waited for at once.
    """

    def __init__(self, most: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        if most <= 0:
            raise ValueError("most must be positive")
        self.most, self.clock, self.sleep = most, clock, sleep
        self.times: list[float] = []
        self.sums: list[int] = []

    def fits_from(self, weight: int) -> float:
        """The earliest time at which ``weight`` more are within bounds; a request above all bounds waits for none other."""
        over = (self.sums[-1] if self.sums else 0) + weight - self.most
        last = bisect_left(self.sums, over) if over > 0 else -1
        return self.times[min(last, len(self.times) - 1)] + WINDOW if last >= 0 and self.times else -math.inf

    def acquire(self, weight: int) -> None:
        if not 0 < weight:
            raise ValueError("weight must be positive")
        now, free = self.clock(), self.fits_from(weight)
        if free > now:
            self.sleep(free - now)
            now = free
        self.times.append(now)
        self.sums.append((self.sums[-1] if self.sums else 0) + weight)
        gone = bisect_left(self.times, now - WINDOW)
        if gone > 1000:  # sums only grow, so what is before the window may go
            self.times, self.sums = self.times[gone:], [x - self.sums[gone - 1] for x in self.sums[gone:]]


class Transient(Exception):
    """A failure that may pass; ``after`` are the seconds that the server asks to wait."""

    def __init__(self, message: str, after: float | None = None) -> None:
        super().__init__(message)
        self.after = after


def retried(call: Callable, attempts: int = 5, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep):
    """Call until it succeeds, waiting as asked or twice as long each time."""
    for k in range(attempts):
        try:
            return call()
        except Transient as e:
            if k == attempts - 1:
                raise
            sleep(e.after if e.after is not None else min(longest, 2.0**k))


def paged(fetch: Callable[[int, int, int], list[list]], start_ms: int, end_ms: int, step_ms: int, limit: int) -> Iterator[list[list]]:
    """Pages from ``start_ms`` to ``end_ms``: until one is empty, short or does not move on."""
    cursor = start_ms
    while cursor <= end_ms:
        rows = fetch(cursor, end_ms, limit)
        if rows:
            yield [r for r in rows if start_ms <= int(r[0]) <= end_ms]
        after = int(rows[-1][0]) + step_ms if rows else cursor
        if len(rows) < limit or after <= cursor:
            return
        cursor = after


class ArchiveMissing(Exception):
    """The exchange has no archive of that day (yet)."""


def cached(fetch: Callable[[str, str, str], bytes], folder: str) -> Callable[[str, str, str], bytes]:
    """``fetch`` of (symbol, interval, day) that keeps what it got as files below ``folder``.

    A file is written beside its place and moved there, so a task that dies leaves no half one.
    What is missing is not remembered: it may come.
    """

    def get(symbol: str, interval: str, day: str) -> bytes:
        path = os.path.join(folder, symbol, interval, f"{symbol}-{interval}-{day}.zip")
        if os.path.exists(path):
            with open(path, "rb") as f:
                return f.read()
        content = fetch(symbol, interval, day)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        beside = f"{path}.{uuid.uuid4().hex}"
        with open(beside, "wb") as f:
            f.write(content)
        os.replace(beside, path)
        return content

    return get


def archive_rows(content: bytes) -> list[list[str]]:
    """The candles of a daily archive: one CSV, with a header line or without."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        text = "".join(z.read(n).decode() for n in z.namelist() if n.endswith(".csv"))
    return [r for r in csv.reader(io.StringIO(text)) if r and r[0].strip().isdigit()]


def archived(symbol: str, interval: str, start_ms: int, end_ms: int, archive: Callable, cutoff: date) -> Iterator[tuple[list[list], int]]:
    """(candles of a day, where the next begins) from ``start_ms`` on, for whole days up to ``cutoff``.

    Ends at the first day that has no archive, or whose archive fails.
    """
    day = day_of(start_ms)
    while day <= cutoff and day_start(day) <= end_ms:
        try:
            rows = archive_rows(archive(symbol, interval, day.isoformat()))
        except (ArchiveMissing, Transient, OSError):
            return
        day += timedelta(days=1)
        yield [r for r in rows if start_ms <= int(r[0]) <= end_ms], day_start(day)


def named(path: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, name = path.partition(":")
    return getattr(import_module(module), name)


class _Ranges(InputPartition):
    def __init__(self, plan: list[tuple[str, int, int]]) -> None:
        self.plan = plan


class MissingCandles(DataSource):
    """Positional rows that series lack, from daily archives or by pages.

    Options: kind (archives or pages), plan (JSON list of [symbol, start_ms, end_ms]), interval,
    step_ms, limit, fetch ("module:function" of (symbol, interval, start, end, limit) -> rows),
    archive (the same of (symbol, interval, day) -> zip content, raising ArchiveMissing), cutoff
    (last day that archives may have), cache (folder of archives), tasks, weight (a minute's
    units), attempts.

    Ranges are dealt out to ``tasks`` partitions, each of which asks for one after the other,
    for pages within its share of the weight: no more requests run at once than there are
    partitions, and all together stay within the weight, on however many machines they run.

    Behind its candles each range has a row without payload: reached_ms, where what was
    fetched ends, and error, what it ended with before it was through. A range that fails
    keeps what it had and leaves the others alone.
    """

    @classmethod
    def name(cls) -> str:
        return "missing_candles"

    def schema(self) -> str:
        return "symbol string, interval string, payload string, start_ms long, reached_ms long, error string"

    def reader(self, schema) -> DataSourceReader:
        return _MissingReader(self.options)


class _MissingReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.o = dict(options)
        self.tasks = max(1, int(self.o.get("tasks", 8)))

    def partitions(self) -> list[InputPartition]:
        plan = [(s, int(a), int(b)) for s, a, b in json.loads(self.o["plan"])]
        return [_Ranges(plan[k :: self.tasks]) for k in range(self.tasks) if plan[k :: self.tasks]]

    def _archives(self) -> Callable:
        archive, cutoff = named(self.o["archive"]), date.fromisoformat(self.o["cutoff"])
        if self.o.get("cache"):
            archive = cached(archive, self.o["cache"])
        return lambda symbol, start, end: archived(symbol, self.o["interval"], start, end, archive, cutoff)

    def _pages(self) -> Callable:
        interval, step, limit = self.o["interval"], int(self.o["step_ms"]), int(self.o.get("limit", 499))
        fetch, weight = named(self.o["fetch"]), request_weight(limit)
        limiter = WeightLimiter(max(weight, int(self.o.get("weight", 900)) // self.tasks))

        def page(symbol: str, start: int, end: int, most: int) -> list[list]:
            limiter.acquire(weight)
            return fetch(symbol, interval, start, end, most)

        def pages(symbol: str, start: int, end: int) -> Iterator[tuple[list[list], int]]:
            tried = lambda a, b, n: retried(lambda: page(symbol, a, b, n), int(self.o.get("attempts", 5)))
            for rows in paged(tried, start, end, step, limit):
                yield rows, max((int(r[0]) + step for r in rows), default=start)

        return pages

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        interval = self.o["interval"]
        source = self._archives() if self.o.get("kind") == "archives" else self._pages()
        for symbol, start, end in partition.plan:
            reached, error = start, None
            try:
                for rows, reached in source(symbol, start, end):  # noqa: B007
                    for row in rows:
                        yield symbol, interval, json.dumps([str(x) for x in row]), start, None, None
            except Exception as e:  # noqa: BLE001  of this range: the sync tells of it when the others are stored
                error = f"{type(e).__name__}: {e}"
            yield symbol, interval, None, start, reached, error


class ExchangeCandles(DataSource):
    """Candles by pages, as a table: symbol, interval, open_time_ms, payload (the positional row).

    Options: symbols (JSON list), interval, step_ms, start_ms, end_ms, limit, fetch, tasks, weight,
    attempts, as for MissingCandles. With ``spark.sql.python.filterPushdown.enabled``, filters on
    symbol and open_time_ms narrow down what is asked for: a read of three days of one symbol
    asks for these. A range that cannot be fetched fails the read.
    """

    @classmethod
    def name(cls) -> str:
        return "exchange_candles"

    def schema(self) -> str:
        return "symbol string, interval string, open_time_ms long, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _CandleReader(self.options)


class _CandleReader(_MissingReader):
    def __init__(self, options) -> None:
        super().__init__(options)
        self.symbols = json.loads(self.o["symbols"])
        self.first, self.last = int(self.o["start_ms"]), int(self.o["end_ms"])

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Take what narrows symbols and open times; Spark applies the others, which are handed back."""
        for f in filters:
            at = getattr(f, "attribute", None)
            if at == ("symbol",) and isinstance(f, EqualTo | In):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.symbols = [s for s in self.symbols if s in wanted]
            elif at == ("open_time_ms",) and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.first = max(self.first, f.value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.last = min(self.last, f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        plan = [(s, self.first, self.last) for s in self.symbols] if self.first <= self.last else []
        return [_Ranges(plan[k :: self.tasks]) for k in range(min(self.tasks, len(plan)))] or [_Ranges([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        source = self._pages()
        for symbol, start, end in partition.plan:
            for rows, _ in source(symbol, start, end):
                for row in rows:
                    yield symbol, self.o["interval"], int(row[0]), json.dumps([str(x) for x in row])


def stream_names(symbols: list[str], interval: str, per_connection: int = 200) -> list[str]:
    """Subscription paths, one for each connection."""
    if per_connection < 1:
        raise ValueError("per_connection must be at least 1")
    names = [f"{s.lower()}@kline_{interval}" for s in symbols]
    return ["/".join(names[i : i + per_connection]) for i in range(0, len(names), per_connection)]
