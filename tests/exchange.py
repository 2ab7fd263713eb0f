"""A made-up exchange for tests, as functions that workers import by name."""

import io
import json
import os
import tempfile
import time
import zipfile

from barforge.sources.transport import ArchiveMissing, Transient

MINUTE, DAY = 60_000, 86_400_000
#: Workers are other processes: they write their calls where the test can read them.
CALLS = os.path.join(tempfile.gettempdir(), f"barforge-exchange-{os.getuid()}")
#: What a silent connection waits for.
GO = CALLS + "-go"
START = 1_719_792_000_000  # 2024-07-01


def row(at):
    return [at, "100", "101", "99", "100.5", "1", at + MINUTE - 1, "100.5", 7, "0.5", "50.25", "0"]


def note(kind, *what):
    with open(CALLS, "a") as f:
        f.write(json.dumps([kind, *what]) + "\n")


def page(symbol, interval, start, end, limit):
    note("page", symbol, start, end)
    at = -(-start // MINUTE) * MINUTE
    if symbol.endswith("FAIL") and not (symbol.startswith("LATE") and start < START + 4 * MINUTE):
        raise OSError("refused")
    if symbol == "LISTED":  # there only from minute 1400 on
        at = max(at, START + 1400 * MINUTE)
    if symbol == "SKIP":  # leaves out the candle that is due
        at += MINUTE
    rows = [row(x) for x in range(at, end + 1, MINUTE)][:limit]
    if symbol == "HOLE":  # lacks one in the middle
        rows = [r for r in rows if r[0] != START + 5 * MINUTE]
    if symbol == "YOUNG":
        rows = [r for r in rows if r[0] != START + 1495 * MINUTE]
    if symbol == "BAD":  # sends a candle whose high is below its low
        rows = [r if r[0] != START + 3 * MINUTE else [*r[:2], "1", *r[3:]] for r in rows]
    return rows


def archive(symbol, interval, day):
    note("archive", symbol, day)
    if symbol == "LOST" and day == "2024-07-01":
        raise ArchiveMissing(day)
    if symbol == "DOWN":
        raise Transient("no connection")
    first = START + DAY * (int(day[-2:]) - 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("x.csv", "open_time,open\n" + "\n".join(",".join(map(str, row(first + k * MINUTE))) for k in range(1440)))
    return out.getvalue()


def slow_page(symbol, interval, start, end, limit):
    began = time.time()
    time.sleep(0.4)
    rows = page(symbol, interval, start, end, limit)
    note("slow_page", symbol, began, time.time())
    return rows


def slow_archive(symbol, interval, day):
    began = time.time()
    time.sleep(0.4)
    content = archive(symbol, interval, day)
    note("slow_archive", symbol, began, time.time())
    return content


def messages(path):
    """Two closed candles for each symbol of the path, then the connection ends."""
    note("connect", path)
    for k in range(2):
        for name in path.split("/"):
            at = START + k * MINUTE
            fields = {"t": at, "T": at + MINUTE - 1, "i": "1m", "o": "1", "c": "1", "h": "1", "l": "1", "v": "1", "n": 1, "x": True, "q": "1", "V": "1", "Q": "1"}
            yield {"data": {"e": "kline", "E": at + MINUTE, "s": name.split("@")[0].upper(), "k": fields}}


def closed(symbol, k):
    at = START + k * MINUTE
    fields = {"t": at, "T": at + MINUTE - 1, "i": "1m", "o": "1", "c": "1", "h": "1", "l": "1", "v": "1", "n": 1, "x": True, "q": "1", "V": "1", "Q": "1"}
    return {"data": {"e": "kline", "E": at + MINUTE, "s": symbol, "k": fields}}


def mixed(path):
    """By the first symbol: A gives three candles and ends, B is silent until GO is there, F fails
    after one candle, L gives a candle every tenth of a second; others end at once."""
    note("connect", path)
    symbol = path.split("@")[0].upper()
    if symbol == "A":
        yield from (closed("A", k) for k in range(3))
    if symbol == "B":
        until = time.monotonic() + 60
        while not os.path.exists(GO) and time.monotonic() < until:
            time.sleep(0.1)
        yield closed("B", 0)
    if symbol == "F":
        yield closed("F", 0)
        raise OSError("gone")
    if symbol == "L":
        for k in range(1000):
            yield closed("L", k)
            time.sleep(0.1)
