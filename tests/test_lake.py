"""Tables on temporary folders, parsers, state, transport, presets, streams and commands."""

import io
import json
import zipfile
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from barforge import cli
from barforge.functions import timeframes as tf
from barforge.sources import ingest, lake, presets, transport
from barforge.streaming.pipelines import candle_sink, ingest as start

from test_operators import MINUTE, START, candle, frame, series


def stored(spark, rows):
    return ingest.stored(frame(spark, rows))


def test_upsert_overlay_and_delete(spark, tmp_path):
    root = f"{tmp_path}/silver"
    lake.upsert(stored(spark, [candle("A", 0, 100.0), candle("B", 0, 5.0)]), root, "seq")
    lake.upsert(stored(spark, [candle("A", 0, 100.5, seq=1), candle("A", 0, 101.0, seq=2), candle("A", 1, 7.0)]), root, "seq")
    got = lambda: sorted((r.symbol, (r.open_time_ms - START) // MINUTE, r.close) for r in lake.scan(spark, root).collect())
    assert got() == [("A", 0, 101.0), ("A", 1, 7.0), ("B", 0, 5.0)]
    assert lake.scan(spark, root, "1m", ["B"], date(2024, 7, 1), date(2024, 7, 1)).count() == 1
    assert lake.scan(spark, root, "15m").count() == 0 and lake.scan(spark, f"{tmp_path}/none").count() == 0
    hot = stored(spark, [candle("A", 1, 8.0), candle("A", 2, 9.0)])
    over = lake.overlay(lake.scan(spark, root), hot.select(*lake.scan(spark, root).columns))
    assert sorted((r.symbol, r.close) for r in over.collect()) == [("A", 8.0), ("A", 9.0), ("A", 101.0), ("B", 5.0)]
    lake.delete_keys(root, spark.createDataFrame([("B", "1m", START), ("A", "1m", START)], "symbol string, interval string, open_time_ms long"))
    assert got() == [("A", 1, 7.0)]


def test_cleaning_into_the_lake_and_again(spark, tmp_path):
    raw, silver, quarantine, gaps = (f"{tmp_path}/{x}" for x in ("raw", "silver", "quarantine", "gaps"))
    rows = [candle("A", 0, 100.0, seq=0), candle("A", 2, 100.0, seq=1), candle("A", 3, 100.0, h=1.0, seq=2), candle("B", 0, 1.5, seq=3)]
    counts = lake.write_cleaned(stored(spark, rows), MINUTE, raw, silver, quarantine, gaps)
    assert counts == {"raw": 4, "accepted": 3, "rejected": 1, "conflicts": 0, "gaps": 1}
    assert [r.missing_open_time_ms for r in spark.read.parquet(gaps).collect()] == [START + MINUTE]
    again = lake.renormalize(spark, raw, silver, quarantine, gaps, "1m", MINUTE, ["A"], overwrite=True)
    assert again == {"raw": 3, "accepted": 2, "rejected": 1, "conflicts": 0, "files": 1, "gaps": 1}
    assert lake.scan(spark, silver).count() == 3 and lake.scan(spark, quarantine).count() == 1 and spark.read.parquet(gaps).count() == 1
    assert lake.renormalize(spark, raw, silver, quarantine, gaps, "1m", MINUTE, overwrite=True)["accepted"] == 3


def test_nothing_is_written_without_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert lake.write_table(spark.range(3), path) == 3 and lake.write_table(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 3


def test_payloads(spark, tmp_path):
    row = [START, "1", "2", "0.5", "1.5", "10", START + MINUTE - 1, "15", 5, "4", "6", "0"]
    got = ingest.parse_rows(spark.createDataFrame([("A", "1m", json.dumps([str(x) for x in row]))], "symbol string, interval string, payload string")).first()
    assert (got.open, got.trade_count, got.date, got.close_time_ms) == (1.0, 5, "2024-07-01", START + MINUTE - 1)
    k = {"t": START, "T": START + MINUTE - 1, "s": "A", "i": "1m", "o": "1", "c": "1.5", "h": "2", "l": "0.5", "v": "10", "n": 5, "x": True, "q": "15", "V": "4", "Q": "6"}
    said = [{"data": {"e": "kline", "s": "", "k": k}}, {"data": {"e": "trade", "s": "A", "k": k}}, {"data": {"e": "kline", "s": "B", "k": k | {"x": False}}}]
    got = ingest.parse_messages(spark.createDataFrame([(json.dumps(m),) for m in said], "value string")).orderBy("symbol").collect()
    assert [(r.symbol, r.is_closed, r.volume, r.taker_buy_base_volume) for r in got] == [("A", True, 10.0, 4.0), ("B", False, 10.0, 4.0)]
    with zipfile.ZipFile(f"{tmp_path}/A-1m-2024-07-01.zip", "w") as z:
        z.writestr("A-1m-2024-07-01.csv", "open_time,open\n" + ",".join(map(str, row)) + "\n\n")
    got = ingest.read_archives(spark, f"{tmp_path}/*.zip").first()
    assert (got.symbol, got.interval, got.close, got.taker_buy_quote_volume) == ("A", "1m", 1.5, 6.0)
    info = {"symbols": [{"symbol": s, "status": st, "contractType": c, "quoteAsset": q} for s, st, c, q in (("B", "TRADING", "PERPETUAL", "USDT"), ("A", "TRADING", "PERPETUAL", "USDT"), ("C", "BREAK", "PERPETUAL", "USDT"), ("D", "TRADING", "PERPETUAL", "BUSD"))]}
    (tmp_path / "info.json").write_text(json.dumps(info))
    universe = ingest.contracts(spark, f"{tmp_path}/info.json")
    assert [r.symbol for r in ingest.active(universe).collect()] == ["A", "B"]
    ingest.append_snapshot(universe, f"{tmp_path}/history", f"{tmp_path}/current", datetime(2024, 7, 1, tzinfo=UTC))
    assert spark.read.json(f"{tmp_path}/current").count() == 2 and spark.read.json(f"{tmp_path}/history").count() == 1


def test_plan_and_state(spark):
    now = datetime(2024, 7, 10, 0, 0, 30, tzinfo=UTC)
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    at = lambda *x: int(datetime(*x, tzinfo=UTC).timestamp() * 1000)
    state = spark.createDataFrame([("A", "1m", at(2024, 7, 9, 23, 58), "active"), ("B", "1m", at(2024, 7, 7, 12), "active"), ("Z", "1m", 5, "active"), ("Z", "5m", 5, "active")], "symbol string, interval string, last_open_time_ms long, status string")
    got = {r.symbol: (r.archive_days, r.rest_batches) for r in ingest.sync_plan(universe, state, "1m", 30, 500, now).collect()}
    assert got == {"A": (0, 1), "B": (2, 3), "C": (29, 3)}
    assert ingest.rest_batches(0, 1439 * MINUTE, MINUTE, 500) == 3 and ingest.archive_days(at(2024, 7, 7, 12), at(2024, 7, 9, 23, 59), date(2024, 7, 8)) == 2
    gone = {(r.symbol, r.interval): (r.last_open_time_ms, r.status) for r in ingest.mark_inactive(state, universe, "1m").collect()}
    assert gone["Z", "1m"] == (5, "inactive") and gone["Z", "5m"] == (5, "active") and gone["A", "1m"][1] == "active"
    merged = ingest.merge_state(state, spark.createDataFrame([("Z", "1m", 3, "active"), ("Y", "1m", 9, "active")], state.schema))
    assert {(r.symbol, r.interval): r.last_open_time_ms for r in merged.collect()}["Z", "1m"] == 5 and merged.count() == 5
    assert ingest.advances(START + 5, START + MINUTE, START, MINUTE) and not ingest.advances(START, START + MINUTE, START, MINUTE) and not ingest.advances(START, START, None, MINUTE)


def test_time_algebra():
    assert [tf.interval_ms(x) for x in ("1m", "4h", "1d", "1w")] == [60_000, 14_400_000, 86_400_000, 604_800_000]
    for bad in ("1x", "m", ""):
        with pytest.raises(ValueError):
            tf.interval_ms(bad)
    assert [tf.source_interval(x) for x in ("1", "8", "15", "20", "45", "D", "d")] == ["1m", "1m", "15m", "1m", "15m", "15m", "15m"]
    assert tf.aligned_up(START + 1, MINUTE) == START + MINUTE and tf.last_closed_open(datetime.fromtimestamp(START / 1000 + 61, tz=UTC), MINUTE) == START


def test_transport():
    clock, slept = [0.0], []
    limiter = transport.WeightLimiter(3, lambda: clock[0], lambda s: (slept.append(s), clock.__setitem__(0, clock[0] + s)))
    for w in (2, 1, 2):
        limiter.acquire(w)
    assert slept == [60.0]
    assert [transport.request_weight(n) for n in (99, 100, 499, 500, 1000, 1001)] == [1, 2, 2, 5, 5, 10]
    with pytest.raises(ValueError):
        limiter.acquire(0)
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise transport.Transient("x", 7.0 if len(calls) == 1 else None)
        return "ok"

    assert transport.retried(flaky, sleep=waits.append) == "ok" and waits == [7.0, 2.0]
    data = [[i * 10, "x"] for i in range(7)]
    fetch = lambda a, b, n: [r for r in data if a <= r[0] <= b][:n]
    assert [[r[0] for r in page] for page in transport.paged(fetch, 10, 55, 10, 2)] == [[10, 20], [30, 40], [50]]
    assert list(transport.paged(lambda a, b, n: [[0, "x"]] * n, 0, 50, 0, 2)) == [[[0, "x"]] * 2]
    assert transport.stream_names(["AB", "C"], "1m", 1) == ["ab@kline_1m", "c@kline_1m"]


def test_presets(tmp_path):
    assert [p.tf for p in presets.group("Swing")] == ["240", "360", "720", "D"] and len(presets.group("all")) == 20
    assert presets.timeframe("d") == presets.Preset("D", 120, 80, 100, 30, 4.0, 1.0)
    path = tmp_path / "p.toml"
    path.write_text('[groups]\nMine = ["d", "7"]\n[timeframes."d"]\ntail_bars=1\nwarmup_bars=2\nliquidity_top_n=3\nliquidity_lookback_bars=4\nmax_abs_gap_atr=5\nmax_ret=6\n')
    assert presets.timeframe("D", str(path)).tail_bars == 1
    with pytest.raises(KeyError):
        presets.group("mine", str(path))
    with pytest.raises(ValueError):
        presets.group("other")
    path.write_text('[timeframes."5"]\ntail_bars=1\n')
    with pytest.raises(ValueError, match="max_ret"):
        presets.load(str(path))


def test_a_stream_that_is_replayed(spark, tmp_path):
    k = lambda m, c, x: {"data": {"e": "kline", "s": "A", "k": {"t": START + m * MINUTE, "T": START + m * MINUTE + MINUTE - 1, "i": "1m", "o": c, "c": c, "h": c, "l": c, "v": "1", "n": 1, "x": x, "q": "1", "V": "1", "Q": "1"}}}
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.txt").write_text("\n".join(json.dumps(m) for m in (k(0, "5", True), k(1, "6", False))))
    run = lambda: start(spark.readStream.text(str(inbox)), candle_sink(f"{tmp_path}/s", MINUTE, open_candles=f"{tmp_path}/o", state=f"{tmp_path}/m"), f"{tmp_path}/c", {"availableNow": True}).awaitTermination()
    run()
    (inbox / "2.txt").write_text("\n".join(json.dumps(m) for m in (k(0, "5", True), k(1, "7", True), k(2, "8", False))))
    run()
    assert sorted(r.close for r in lake.scan(spark, f"{tmp_path}/s").collect()) == [5.0, 7.0]
    assert [r.close for r in spark.read.parquet(f"{tmp_path}/o").collect()] == [8.0]
    assert spark.read.parquet(f"{tmp_path}/m").first().last_open_time_ms == START + MINUTE


def test_commands(spark, tmp_path, capsys):
    silver = f"{tmp_path}/silver"
    rows = series("BTCUSDT", [100 + i % 7 for i in range(240)]) + series("ETHUSDT", [50 + i % 5 for i in range(240)])
    lake.upsert(stored(spark, rows), silver)
    run = lambda *argv: cli.main([*argv], spark)
    places = [f"--{x}={tmp_path}/{x}" for x in ("features", "signals", "equity", "boards")]
    run("build-features", f"--silver={silver}", places[0])
    run("build-signals", *places[:2], "--top-n=1")
    run("backtest-signals", *places[:3])
    run("show-signals", places[1])
    run("backtest-report", places[2])
    run("build-relative-strength", f"--silver={silver}", places[3], "--tf=5", "--use-preset")
    run("show-relative-strength", places[3], "--tf=5")
    run("build-relative-strength-presets", f"--silver={silver}", places[3], "--preset=scalp", "--dry-run")
    said = capsys.readouterr().out
    assert "final_equity" in said and "Preset(tf='15'" in said and "is_overheated" in said
    assert spark.read.parquet(f"{tmp_path}/features").count() == 8
