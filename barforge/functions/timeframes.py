"""Time algebra on interval names, timeframes and epoch milliseconds."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
# Milliseconds of each unit of an interval's name.
UNITS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}
DAY = UNITS["d"]


def interval_ms(name: str) -> int:
    """Milliseconds of an interval such as 1m, 4h, 1d or 1w."""
    number, unit = name[:-1], name[-1:]
    if unit not in UNITS or not number.isdigit():
        raise ValueError(f"unsupported interval: {name}")
    return int(number) * UNITS[unit]


def timeframe_ms(tf: str) -> int:
    """Milliseconds of a timeframe: a number of minutes, or D for a day."""
    return DAY if tf.upper() == "D" else int(tf) * UNITS["m"]


def source_interval(tf: str) -> str:
    """The stored interval that a timeframe is built from."""
    return "15m" if tf.upper() == "D" or (int(tf) >= 15 and int(tf) % 15 == 0) else "1m"


def last_closed_open(now: datetime, step_ms: int) -> int:
    """Open time of the latest candle that has closed: one step before the running one's."""
    micros = (now - EPOCH) // timedelta(microseconds=1)
    running = micros // (1000 * step_ms)
    return (running - 1) * step_ms


def aligned_up(at_ms: int, step_ms: int) -> int:
    return -(-at_ms // step_ms) * step_ms


def day_start(day: date) -> int:
    """Epoch milliseconds at which a UTC day begins."""
    return (day.toordinal() - EPOCH.toordinal()) * DAY


def day_of(at_ms: int) -> date:
    """The UTC day of epoch milliseconds."""
    return date.fromordinal(EPOCH.toordinal() + at_ms // DAY)
