"""Presets of the strength board for each timeframe, and their TOML overrides."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Preset:
    tf: str
    tail_bars: int
    warmup_bars: int
    liquidity_top_n: int
    liquidity_lookback_bars: int
    max_abs_gap_atr: float
    max_ret: float


# The presets of each timeframe, and the groups of timeframes.
DEFAULTS = [
    Preset("1", 240, 80, 100, 240, 1.2, 0.03),
    Preset("2", 220, 80, 100, 200, 1.3, 0.04),
    Preset("3", 200, 80, 100, 160, 1.4, 0.05),
    Preset("4", 180, 80, 100, 140, 1.5, 0.055),
    Preset("5", 160, 80, 100, 120, 1.5, 0.06),
    Preset("8", 140, 80, 100, 110, 1.6, 0.07),
    Preset("10", 130, 80, 100, 100, 1.7, 0.075),
    Preset("15", 120, 80, 100, 96, 1.8, 0.08),
    Preset("20", 110, 70, 100, 72, 1.9, 0.10),
    Preset("30", 100, 60, 100, 48, 2.0, 0.12),
    Preset("45", 100, 60, 100, 48, 2.1, 0.15),
    Preset("60", 100, 60, 100, 48, 2.2, 0.18),
    Preset("90", 100, 60, 100, 40, 2.4, 0.22),
    Preset("120", 100, 60, 100, 36, 2.5, 0.25),
    Preset("180", 100, 60, 100, 32, 2.8, 0.30),
    Preset("240", 100, 60, 100, 30, 3.0, 0.35),
    Preset("360", 100, 50, 100, 20, 3.0, 0.40),
    Preset("480", 100, 50, 100, 18, 3.2, 0.50),
    Preset("720", 100, 50, 100, 14, 3.5, 0.60),
    Preset("D", 120, 80, 100, 30, 4.0, 1.00),
]
GROUPS = {
    "scalp": ["1", "3", "5", "15"],
    "intraday": ["15", "30", "60", "120", "240", "360"],
    "swing": ["240", "360", "720", "D"],
    "all": ["1", "2", "3", "4", "5", "8", "10", "15", "20", "30", "45", "60", "90", "120", "180", "240", "360", "480", "720", "D"],
}


def _preset(tf: str, values: dict) -> Preset:
    kinds = {f.name: float if "float" in str(f.type) else int for f in fields(Preset)[1:]}
    if missing := sorted(kinds.keys() - values.keys()):
        raise ValueError(f'timeframes."{tf}" lacks: {", ".join(missing)}')
    return Preset(tf, **{name: kind(values[name]) for name, kind in kinds.items()})


def load(path: str | None = None) -> tuple[dict[str, list[str]], dict[str, Preset]]:
    """Groups (names in lower case) and presets (timeframes in upper case), a file's first."""
    groups, presets = dict(GROUPS), {p.tf: p for p in DEFAULTS}
    if path is not None:
        with open(path, "rb") as f:
            config = tomllib.load(f)
        groups |= {k.lower(): [str(tf).upper() for tf in v] for k, v in config.get("groups", {}).items()}
        presets |= {str(tf).upper(): _preset(str(tf).upper(), v) for tf, v in config.get("timeframes", {}).items()}
    return groups, presets


def group(name: str, path: str | None = None) -> list[Preset]:
    """The presets of a group; ValueError for an unknown group, KeyError for a timeframe in it."""
    groups, presets = load(path)
    if name.lower() not in groups:
        raise ValueError(f"unknown preset group: {name}; available: {', '.join(groups)}")
    return [presets[tf] for tf in groups[name.lower()]]


def timeframe(tf: str, path: str | None = None) -> Preset:
    _, presets = load(path)
    if tf.upper() not in presets:
        raise ValueError(f"unknown timeframe: {tf}; available: {', '.join(presets)}")
    return presets[tf.upper()]
