"""A live stream: receivers, the query over their log, and fills beside both."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barforge.sources.ingest import parse_messages
from barforge.streaming.pipelines import Sink
from barforge.streaming.receivers import Receivers, Receiving, log_stream


class Fills:
    """Fills of the shards that may lack candles, one at a time, beside the stream.

    A shard that is asked for while a fill runs is filled after it; all that wait then are
    filled together. A fill that fails is told of by ``said``, kept in ``failures``, and its
    shards wait for the next one.
    """

    def __init__(self, fill: Callable[[list[str]], object], shards: list[list[str]], said: Callable[..., None]) -> None:
        self.fill, self.shards, self.said = fill, shards, said
        self.waiting: set[int] = set()
        self.left: set[int] = set()
        self.failures: list[Exception] = []
        self.changed, self.busy, self.closed = threading.Condition(), False, False
        self.thread = InheritableThread(target=self._run, daemon=True)
        self.thread.start()

    def ask(self, shards: set[int]) -> None:
        with self.changed:
            self.waiting |= shards
            self.changed.notify_all()

    def _run(self) -> None:
        while True:
            with self.changed:
                self.changed.wait_for(lambda: self.waiting or self.closed)
                if self.closed:
                    return
                now, self.waiting, self.left, self.busy = self.waiting | self.left, set(), set(), True
            symbols = [s for k in sorted(now) for s in self.shards[k]]
            try:
                self.said("fill", symbols=len(symbols), shards=sorted(now))
                self.fill(symbols)
            except Exception as e:  # noqa: BLE001  the stream goes on; what lacks is asked for again
                self.failures.append(e)
                self.said("fill_failed", shards=sorted(now), error=str(e))
                self.left |= now
            with self.changed:
                self.busy = False
                self.changed.notify_all()

    def drain(self, seconds: float | None = None) -> bool:
        """Wait until nothing waits or runs."""
        with self.changed:
            return self.changed.wait_for(lambda: not self.waiting and not self.busy, seconds)

    def close(self) -> None:
        with self.changed:
            self.closed = True
            self.changed.notify_all()


class Live:
    """Receive, store and fill until stopped.

    Each shard's ``open`` asks for a fill of its symbols, and so does each ``end`` and
    ``failed``: what closes while a connection is away is fetched while the others go on, and
    what closed before it stood as well, as the fill begins after it. ``fill_at_start``: whether the
    very first opening of a shard asks too. The query begins anew after a failure, up to
    ``most_restarts`` times; what was received meanwhile waits in the log. ``progress`` gets a
    dict for each event: kind and figures.
    """

    def __init__(
        self, spark: SparkSession, how: Receiving, sink: Sink, spool: str, checkpoint: str, fill: Callable[[list[str]], object] | None = None, fill_at_start: bool = True,
        trigger: dict | None = None, progress: Callable[[dict], None] | None = None, restart: float = 5.0, most_restarts: int = 10,
    ) -> None:
        self.spark, self.how, self.sink, self.spool, self.checkpoint = spark, how, sink, spool, checkpoint
        self.fill_at_start, self.trigger = fill_at_start, trigger or {"processingTime": f"{how.seconds} seconds"}
        self.progress, self.restart, self.most_restarts = progress, restart, most_restarts
        self.counts = {"messages": 0, "batches": 0, "open": 0, "end": 0, "failed": 0, "fill": 0, "fill_failed": 0, "restarts": 0}
        self.stopping = threading.Event()
        self.fills = Fills(fill, how.shards(), self._said) if fill else None
        self.receivers = Receivers(spark, spool, how)
        self.query = self._start()

    def _said(self, kind: str, **figures) -> None:
        self.counts[kind] = self.counts.get(kind, 0) + 1
        if self.progress:
            self.progress({"kind": kind, **figures})

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        events = batch.filter("event <> 'message'").select("shard", "generation", "event", "again", "value").orderBy("generation", "place").collect()  # a few for each connection
        self.sink(parse_messages(batch.filter("event = 'message'")), batch_id)
        # told of once the batch is stored: a batch that is computed again tells of them then
        for e in events:
            self._said(e.event, shard=e.shard, generation=e.generation, again=e.again, error=e.value)
        if self.fills:
            self.fills.ask({e.shard for e in events if e.event != "open" or e.again or self.fill_at_start})
        seen = batch.filter("event = 'message'").agg(F.count("*")).first()[0]
        self.counts["messages"] += seen
        self._said("batches", batch=batch_id, messages=seen)

    def _start(self) -> StreamingQuery:
        return log_stream(self.spark, self.spool).writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint).trigger(**self.trigger).start()

    def wait(self, seconds: float | None = None) -> dict[str, int]:
        """Go on until stopped, until ``seconds`` are over, or, with ``once``, until all connections have ended.

        Returns the counts so far; when all have ended, everything that they said is stored
        and filled. An interrupt stops the stream, and no fill follows it.
        """
        until = None if seconds is None else time.monotonic() + seconds
        try:
            while not self.stopping.is_set() and (until is None or time.monotonic() < until):
                try:
                    if self.query.awaitTermination(1) and self.stopping.is_set():
                        break
                    if not self.receivers.alive():
                        self.query.processAllAvailable()
                        if self.fills:
                            self.fills.drain()
                        self.stop()
                        if self.receivers.failure:
                            raise self.receivers.failure
                except StreamingQueryException as e:
                    if self.stopping.is_set():
                        break
                    if self.counts["restarts"] >= self.most_restarts:
                        self.stop()
                        raise
                    self._said("restarts", error=str(e)[:500])
                    self.stopping.wait(self.restart)
                    self.query = self._start()
        except KeyboardInterrupt:
            self.stop()
            raise
        return dict(self.counts)

    def stop(self) -> None:
        """End receivers, the query and fills; what is in the log stays there for the next start."""
        if not self.stopping.is_set():
            self.stopping.set()
            self._said("shutdown", status="requested", **{k: v for k, v in self.counts.items() if k != "shutdown"})
            self.receivers.stop()
            self.query.stop()
            if self.fills:
                self.fills.close()
            self._said("shutdown", status="complete", **{k: v for k, v in self.counts.items() if k != "shutdown"})
