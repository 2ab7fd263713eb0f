"""Receivers: what connections say is written to a log of messages before any batch reads it.

Symbols are dealt out to connections, and each connection has a task of its own, which runs
as long as the stream does. A thread listens; the task takes from its queue what has come by
a deadline and appends it to the log in the shared folder, as a file that appears whole. The
stream proper reads the log as files, so a batch that is computed twice has the same rows.

The log tells of the connections too: each opening is a generation of its shard, with an
``open`` ahead of its messages and an ``end`` or ``failed`` behind them, where the task lives to
write it. From these rows the stream knows which symbols may lack candles.
"""

from __future__ import annotations

import json
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import InheritableThread, TaskContext
from pyspark.sql import DataFrame, SparkSession

from barforge.sources.transport import named, stream_names

#: A row of the log. place counts within a generation; event is open, message, end or failed;
#: again tells of an ``open`` whether its shard had been open before.
LOG = "shard int, generation long, place long, event string, again boolean, value string"
STOP, MESSAGES, BESIDE = "_stop", "messages", "_beside"


@dataclass
class Receiving:
    """Which messages are received, and how.

    connect: "module:function" of a subscription path -> iterator of messages, each a text, an
    object, or None (nothing yet, but the connection stands). messages and seconds: a file of
    the log ends at whichever comes first. waiting: messages that a connection may be ahead of
    its task; then it is not read on. settle: seconds after which a connection that says
    nothing counts as open. once: connections that end stay so.
    """

    connect: str
    symbols: list[str]
    interval: str
    per_connection: int = 200
    messages: int = 100
    seconds: float = 0.5
    waiting: int = 10_000
    settle: float = 5.0
    reconnect: float = 5.0
    once: bool = False

    def shards(self) -> list[list[str]]:
        """The symbols of each connection."""
        return [self.symbols[i : i + self.per_connection] for i in range(0, len(self.symbols), self.per_connection)]


class _Log:
    """One generation's part of the log, written file by file."""

    def __init__(self, spool: str, shard: int, generation: int) -> None:
        self.files, self.root = fs.FileSystem.from_uri(spool)
        self.shard, self.generation, self.place, self.part = shard, generation, 0, 0
        self.rows: list[str] = []

    def add(self, event: str, value: str | None = None, again: bool | None = None) -> None:
        row = {"shard": self.shard, "generation": self.generation, "place": self.place, "event": event, "again": again, "value": value}
        self.rows.append(json.dumps(row))
        self.place += 1

    def flush(self) -> None:
        if self.rows:
            name = f"{self.shard}-{self.generation}-{self.part}.json"
            beside = f"{self.root}/{BESIDE}/{uuid.uuid4().hex}"
            with self.files.open_output_stream(beside) as out:
                out.write(("\n".join(self.rows) + "\n").encode())
            self.files.move(beside, f"{self.root}/{MESSAGES}/{name}")
            self.rows, self.part = [], self.part + 1


def _listen(connect: Callable, path: str, heard: queue.Queue) -> None:
    try:
        for message in connect(path):
            heard.put(("message", message if message is None or isinstance(message, str) else json.dumps(message)))
        heard.put(("end", None))
    except Exception as e:  # noqa: BLE001  whatever a connection fails with is an event of the stream
        heard.put(("failed", f"{type(e).__name__}: {e}"))


def _generation(log: _Log, path: str, how: Receiving, again: bool, stopped: Callable[[], bool]) -> bool:
    """Log one connection from its opening on. Whether it ended by itself, and not by a stop."""
    heard: queue.Queue = queue.Queue(how.waiting)
    threading.Thread(target=_listen, args=(named(how.connect), path, heard), daemon=True).start()
    began, opened = time.monotonic(), False
    deadline = began + how.seconds
    while True:
        try:
            event, value = heard.get(timeout=max(0.0, deadline - time.monotonic()))
        except queue.Empty:
            event, value = None, None
        now = time.monotonic()
        if not opened and (event == "message" or now - began >= how.settle):
            log.add("open", again=again)
            opened = True
        if event in ("end", "failed") or value is not None:
            log.add(event, value)
        if event in ("end", "failed"):
            log.flush()
            return True
        if len(log.rows) >= how.messages or now >= deadline:
            log.flush()
            deadline = now + how.seconds
            if stopped():
                return False


def receive(spool: str, how: Receiving, attempt: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work of a receiver's task: its one row is its shard's number. It has no rows to give."""
    paths = stream_names(how.symbols, how.interval, how.per_connection)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(spool)
        stopped = lambda: files.get_file_info(f"{root}/{STOP}").type != fs.FileType.NotFound
        before = attempt + TaskContext.get().attemptNumber()
        for batch in batches:
            for shard in batch["id"].to_pylist():
                again = before > 0
                while _generation(_Log(spool, shard, time.time_ns()), paths[shard], how, again, stopped) and not how.once:
                    again, until = True, time.monotonic() + how.reconnect
                    while time.monotonic() < until:
                        time.sleep(min(0.2, how.reconnect))
                        if stopped():
                            return
        yield from ()

    return run


class Receivers:
    """A job with a task for each connection, begun anew whenever it fails, until it is stopped."""

    def __init__(self, spark: SparkSession, spool: str, how: Receiving, most_failures: int = 10) -> None:
        self.spark, self.spool, self.how, self.most_failures = spark, spool.rstrip("/"), how, most_failures
        self.group, self.failure, self.stopping = f"receivers-{uuid.uuid4().hex}", None, False
        self.files, self.root = fs.FileSystem.from_uri(self.spool)
        for folder in (MESSAGES, BESIDE):
            self.files.create_dir(f"{self.root}/{folder}")
        if self.files.get_file_info(f"{self.root}/{STOP}").type != fs.FileType.NotFound:
            self.files.delete_file(f"{self.root}/{STOP}")
        self.thread = InheritableThread(target=self._run, daemon=True)
        self.thread.start()

    def _run(self) -> None:
        self.spark.sparkContext.setJobGroup(self.group, "receivers", interruptOnCancel=True)
        n = len(self.how.shards())
        for attempt in range(self.most_failures):
            try:
                self.spark.range(0, n, 1, n).mapInArrow(receive(self.spool, self.how, attempt), "id long").write.format("noop").mode("overwrite").save()
                self.failure = None
                return
            except Exception as e:  # noqa: BLE001  a lost executor, most likely: its connections are opened anew
                self.failure = e
                if self.stopping:
                    return

    def alive(self) -> bool:
        return self.thread.is_alive()

    def stop(self, grace: float = 10.0) -> None:
        """Ask the tasks to end, and end those that do not."""
        self.stopping = True
        self.files.open_output_stream(f"{self.root}/{STOP}").close()
        self.thread.join(grace)
        if self.alive():
            self.spark.sparkContext.cancelJobGroup(self.group)
            self.thread.join(grace)


def log_stream(spark: SparkSession, spool: str, most_files: int | None = None) -> DataFrame:
    """The log as a stream of LOG rows. Files that a finished batch has read are deleted later on."""
    rows = spark.readStream.schema(LOG).option("cleanSource", "delete")
    if most_files:
        rows = rows.option("maxFilesPerTrigger", most_files)
    return rows.json(f"{spool.rstrip('/')}/{MESSAGES}")
